from portolan.functions.expressions import (
    SAS_EPOCH,
    calendar_parts,
    column,
    format_count,
    format_float,
    is_missing,
    is_present,
    sas_date,
    sas_date_string,
    title_case,
    truncate_to_int,
)

__all__ = [
    "SAS_EPOCH",
    "calendar_parts",
    "column",
    "format_count",
    "format_float",
    "is_missing",
    "is_present",
    "sas_date",
    "sas_date_string",
    "title_case",
    "truncate_to_int",
]
