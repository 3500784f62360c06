"""What the operators of this subpackage share: names, words and batches.

Words are runs of characters other than space and \\x09-\\x0D. Lower-casing touches A-Z only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, scratch_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\f\r"
SLICE_BYTES = 4 << 20
BATCH_ROWS = 2000


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores in front until no column of df is called so."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def remainder(id_col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo `mod`; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % mod


FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def free_shuffles(spark: SparkSession) -> None:
    """From now on Spark removes the shuffles of a query when it ends, not when the driver next collects garbage.

    An action that is run again on the same DataFrame makes them anew.
    """
    spark.conf.set(FILE_CLEANUP, True)


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write the rows to the shared scratch folder and read them back: lineage ends here, and the shuffles of the write go."""
    spark = df.sparkSession
    free_shuffles(spark)
    path = scratch_dir(spark, name)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def done_with(*tables: DataFrame) -> None:
    """Remove what `stored` wrote for these tables; nothing that is still to run may read them."""
    for table in tables:
        discard(table.sparkSession, table.stored_at)


def small_batches(df: DataFrame) -> None:
    """Hand rows to Python at most `BATCH_ROWS` at a time, on both sides of which a batch must fit into memory."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(setting)) <= BATCH_ROWS:
        conf.set(setting, BATCH_ROWS)


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    return pc.fill_null(batch.column(column), "")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in order, cut so that the texts of a slice take about `limit` bytes; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def words(texts: pa.Array, lower: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the words of all texts in order as indices into them, and the number of words of each text."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat = split.flatten()
    counts = np.diff(split.offsets.to_numpy()).astype(np.int64)
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    if not full.all():  # blanks at the ends of a text leave empty pieces
        owner = np.repeat(np.arange(len(counts)), counts)
        counts = np.bincount(owner[full], minlength=len(counts)).astype(np.int64)
        flat = flat.filter(pa.array(full))
    coded = flat.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (multiply and shift)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(values: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(v) for v in values.cast(pa.binary()).to_pylist()), np.uint64, len(values))


def give_back(cycles: bool = True) -> None:
    """Return freed memory of this process to the system; arrays of a few MB otherwise stay with its allocators.

    With `cycles` also what earlier tasks of this process left in cycles, such as their broadcasts.
    """
    import ctypes
    import gc

    if cycles:
        gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def giving_back(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same work on batches, after which the process keeps no freed memory for later tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return run


def per_process(name: str, key: str, make: Callable):
    """What `make` gives, kept for later tasks of the same worker process; one value for each name, the last."""
    import sys
    import types

    # functions travel by value, so their module's globals are new in each task; sys.modules is not
    kept = sys.modules.setdefault("_shelfgrain_kept", types.ModuleType("_shelfgrain_kept")).__dict__
    if kept.get(name, ("", None))[0] != key:
        kept[name] = (key, make())
    return kept[name][1]


def id_borders(rows: DataFrame, id: str, parts: int) -> list[int]:
    """At most parts - 1 ids that cut the rows into ranges of about equal counts, from approximate quantiles of the ids alone."""
    if parts <= 1:
        return []
    found = rows.approxQuantile(id, [i / parts for i in range(1, parts)], 0.25 / parts)
    return sorted(set(map(int, found)))


def range_of(id: Column, borders: list[int]) -> Column:
    """The number of borders up to an id; a null id is behind all."""
    if not borders:
        return F.lit(0)
    if len(borders) <= 64:
        inside = F.array_size(F.filter(F.array(*[F.lit(b) for b in borders]), lambda b: b <= id))
        return F.coalesce(inside, F.lit(len(borders)))

    @F.pandas_udf("int")
    def found(ids: pd.Series) -> pd.Series:
        at = np.searchsorted(np.asarray(borders), ids.fillna(borders[-1]).to_numpy(), side="right")
        return pd.Series(at.astype(np.int32))

    return found(id)
