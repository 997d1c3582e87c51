"""Row filters."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import DataFrame

from portolan.functions import is_present


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Keep the rows in which every column of ``subset`` has a value.

    Same rows as ``dropna(subset=...)`` (NaN counts as missing), but written as
    a conjunction that reaches the scan as pushed filters.
    """
    types = {f.name: f.dataType for f in df.schema}
    return df.where(functools.reduce(operator.and_, [is_present(c, types[c]) for c in subset]))
