from portolan.sinks.release import Release, path_exists
from portolan.sinks.staging import Staging
from portolan.sinks.writers import write_csv, write_parquet, write_text

__all__ = ["Release", "Staging", "path_exists", "write_csv", "write_parquet", "write_text"]
