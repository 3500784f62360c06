"""Newly landed files as a stream without repeated reviews."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordering import top_per_key
from ..session import discard, scratch_dir

BATCH = "batch_id"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class LandedFiles:
    """A folder in which files arrive, and the columns that name a row."""

    path: str
    schema: T.StructType
    keys: list[str]
    fmt: str = "parquet"
    files_per_trigger: int = 1000

    def _options(self, reader):
        if self.fmt == "csv":
            reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
        return reader.format(self.fmt).schema(self.schema)

    def _with_keys(self, rows: DataFrame) -> DataFrame:
        for key in self.keys:
            rows = rows.filter(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
        return rows

    def stream(self, spark: SparkSession) -> DataFrame:
        """Rows of new files as they come; rows without a key are dropped."""
        return self._with_keys(self._options(spark.readStream).option("maxFilesPerTrigger", self.files_per_trigger).load(self.path))

    def read(self, spark: SparkSession, files: list[str]) -> DataFrame:
        """The same rows of some files."""
        return self._with_keys(self._options(spark.read).load(files))


def first_seen(stream: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """(keys, file) of the keys that no earlier batch had, in each batch; file holds the key's first row by `order`.

    A stateful aggregate keeps, for each key, the batch that first had it and its first
    place there. A batch looks up its own keys only, so its work does not grow with what
    came before; a batch that runs again finds the state of the batch before it.
    """
    own = [F.col(c) if isinstance(c, str) else c for c in order]
    place = F.struct(F.current_timestamp().alias("seen"), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(own)]).alias("order"), F.col("_metadata.file_path").alias("file"))
    kept = stream.select(*keys, place.alias("place")).groupBy(*keys).agg(F.min("place").alias("first"))
    # the time of a batch is fixed when it is planned and comes back with it when it is run again
    return kept.filter(F.col("first.seen") == F.current_timestamp()).select(*keys, F.col("first.file").alias("file"))


def drain(spark: SparkSession, landed: LandedFiles, out: str, checkpoint: str, order: list[Column | str]) -> list[dict]:
    """Process everything that has landed, then stop; a key that was picked up before is left out.

    A file counts as new by its keys and not by its dates: an old file that arrives late
    loses nothing. Of rows that share a key within a batch the first by `order` stays, which
    must be total among them. The state of the keys is in RocksDB below `checkpoint`; a
    row's other columns are not part of it: the files of a batch that hold new keys are
    read once more. A batch that runs again replaces its own rows. Returns what Spark
    reports of each batch.
    """

    def pick_up(new: DataFrame, number: int) -> None:
        session = new.sparkSession
        # the state moves on with one run of the batch, so its outcome is kept for the two uses below
        place = scratch_dir(session, "new-keys")
        new.write.parquet(place)
        new = session.read.schema(new.schema).parquet(place)
        # no more files than a trigger takes
        files = [r["file"] for r in new.select("file").distinct().collect()]
        if files:
            rows = landed.read(session, files).withColumn("file", F.col("_metadata.file_path"))
            same = rows.join(new, [*landed.keys, "file"], "left_semi").select(*landed.schema.names)
            first = top_per_key(same, landed.keys, [F.col(c) if isinstance(c, str) else c for c in order], 1)
            placed = first.withColumn(BATCH, F.lit(number).cast("long"))
            placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(out)
        discard(session, place)

    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, ROCKSDB)
    try:
        new = first_seen(landed.stream(spark), landed.keys, order)
        query = new.writeStream.outputMode("update").foreachBatch(pick_up).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return [p if isinstance(p, dict) else p.jsonValue for p in query.recentProgress]
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)
