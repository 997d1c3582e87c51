from portolan.sources.labels import parse_label_lines, read_label_catalog
from portolan.sources.readers import (
    file_inventory,
    load_table,
    read_csv,
    read_csv_with_rejects,
    read_indexed_csv,
)

__all__ = [
    "file_inventory",
    "load_table",
    "parse_label_lines",
    "read_csv",
    "read_csv_with_rejects",
    "read_indexed_csv",
    "read_label_catalog",
]
