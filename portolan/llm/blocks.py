"""A query set that meets all rows of a vector table, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.llm.tables import ROW, pieces

SHARD, CHUNK = "__shard", "__chunk"

# Rows, and queries, of a block: 64 components of 8 bytes make 4 and 16 MB.
ROWS_A_BLOCK, QUERIES_A_BLOCK = 8192, 32768
# Queries that are worked on at once within a block.
AT_ONCE = 256
# Stands for a null id where ids are compared, so that it comes last.
NO_ID = np.iinfo(np.int64).max


def finite(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers; an empty one counts as such."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & whole, F.lit(False))


def meet(
    rows: DataFrame,
    queries: DataFrame,
    work: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
    rows_a_block: int = ROWS_A_BLOCK,
    queries_a_block: int = QUERIES_A_BLOCK,
) -> DataFrame:
    """``work(rows, queries)`` for every block of rows and block of queries.

    Both sides are stored tables with ``__row``, by whose hash they are dealt
    into blocks: no key, id or group of copies can fill one. A block is a
    group of its own; each side is sent once per block of the other.
    """
    shards = pieces(rows.count(), rows_a_block)
    chunks = pieces(queries.count(), queries_a_block)
    number = F.xxhash64(ROW)

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = rows.withColumn(SHARD, F.pmod(number, F.lit(shards)).cast("int")).withColumn(CHUNK, every(chunks))
    right = queries.withColumn(CHUNK, F.pmod(number, F.lit(chunks)).cast("int")).withColumn(SHARD, every(shards))
    return left.groupBy(SHARD, CHUNK).cogroup(right.groupBy(SHARD, CHUNK)).applyInArrow(work, schema)


def matrix(column: pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Vectors as the rows of a matrix of doubles; shorter ones end in zeros."""
    lists = column.combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = max(width or 0, int(sizes.max(initial=0)))
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy().astype(np.int64)


def nullable(values: np.ndarray, null: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=null)


def first_of_each(owner: np.ndarray, k: int) -> np.ndarray:
    """Marks the first ``k`` entries of every run of equal owners; ``owner`` is sorted."""
    start = np.searchsorted(owner, owner, "left")
    return np.arange(len(owner)) - start < k
