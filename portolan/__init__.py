"""Star-schema ETL and data quality as plain PySpark DataFrame operators.

Packages, from the bottom up:

* ``functions``  column expressions (``Column -> Column``)
* ``sources``    readers: Parquet, CSV, label text, file inventory
* ``sinks``      writers: Parquet (plain and partitioned), CSV, staging
* ``operators``  DataFrame -> DataFrame building blocks
* ``plans``      cleaning recipes, dimensions, fact and the whole job
"""
