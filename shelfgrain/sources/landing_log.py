"""What has landed, as a log beside the files: asking needs no listing of folders.

Each landing appends the entries of its files to the current generation of the log, a small
Parquet table. When a generation has become many files it is written anew as the next one,
and readers turn to it once it is whole. Listing the whole tree is left to `repair`, which
adds files that have no entry and drops entries whose file is gone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import discard
from . import landing

ENTRY = (
    T.StructType().add("file_path", "string").add("length", "long").add("modificationTime", "timestamp").add("source", "string").add("kind", "string")
    .add("category", "string").add("landed_on", "date").add("product_id", "string").add("file_stamp", "string")
)
COMPACT_FILES = 64
# days of one landing, which come to the driver
MAX_DAYS = 10_000


@dataclass(frozen=True)
class LandingLog:
    """The log of a landing tree; both lie below `root`."""

    root: str

    @property
    def _place(self) -> str:
        return f"{self.root.rstrip('/')}/_landing_log"

    def _generations(self, spark: SparkSession) -> list[tuple[int, int]]:
        """(number, files) of the generations that are whole, ascending."""
        path = spark._jvm.org.apache.hadoop.fs.Path(self._place)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        found = []
        if fs.exists(path):
            for status in fs.listStatus(path):
                names = [f.getPath().getName() for f in fs.listStatus(status.getPath())]
                if "_SUCCESS" in names:
                    found.append((int(status.getPath().getName().removeprefix("gen-")), sum(n.endswith(".parquet") for n in names)))
        return sorted(found)

    def _folder(self, number: int) -> str:
        return f"{self._place}/gen-{number:08d}"

    def entries(self, spark: SparkSession) -> DataFrame:
        """One row for each landed file. Reads the log alone."""
        known = self._generations(spark)
        if not known:
            return spark.createDataFrame([], ENTRY)
        return spark.read.schema(ENTRY).parquet(self._folder(known[-1][0])).dropDuplicates(["file_path"])

    def land(self, df: DataFrame, source: str, kind: str, category: Column, day: Column, fmt: str = "csv", bom: bool = False) -> int:
        """Write rows in the landing layout and log the files; returns how many there are.

        Only the folders of the days that these rows go to are looked at. A landing that dies
        between files and log leaves files without entries, which `repair` finds.
        """
        spark = df.sparkSession
        placed = landing.with_landing_cols(df, source, kind, category, day)
        days = placed.select("yyyy", "mm", "dd").distinct().limit(MAX_DAYS + 1).collect()
        if len(days) > MAX_DAYS:
            raise ValueError(f"one landing goes to more than {MAX_DAYS} days")
        landing.write_landing(placed, self.root, fmt, bom)
        if not days:
            return 0
        folders = [f"{self.root.rstrip('/')}/raw-data/source=*/kind=*/category=*/yyyy={r['yyyy']}/mm={r['mm']}/dd={r['dd']}" for r in days]
        return self._append(spark, self._listed(spark, folders).join(self.entries(spark).select("file_path"), "file_path", "left_anti"))

    def _listed(self, spark: SparkSession, path: str | list[str]) -> DataFrame:
        return landing.manifest(spark, path).select(*ENTRY.names)

    def _append(self, spark: SparkSession, new: DataFrame) -> int:
        known = self._generations(spark)
        number = known[-1][0] if known else 0
        before = self.entries(spark).count() if known else 0
        new.select(*ENTRY.names).hint("rebalance").write.mode("append").parquet(self._folder(number))
        if known and known[-1][1] >= COMPACT_FILES:
            self.compact(spark)
        return self.entries(spark).count() - before

    def compact(self, spark: SparkSession, gone: DataFrame | None = None) -> None:
        """Write the entries anew as the next generation, without those in `gone`; older generations go when it is whole."""
        known = self._generations(spark)
        if not known:
            return
        rows = self.entries(spark)
        if gone is not None:
            rows = rows.join(gone.select("file_path"), "file_path", "left_anti").select(*ENTRY.names)
        rows.hint("rebalance").write.parquet(self._folder(known[-1][0] + 1))
        for number, _ in known:
            discard(spark, self._folder(number))

    def repair(self, spark: SparkSession) -> tuple[int, int]:
        """Compare the log with the whole tree; returns how many entries were added and dropped."""
        listed = self._listed(spark, f"{self.root.rstrip('/')}/raw-data")
        known = self.entries(spark)
        gone = known.join(listed.select("file_path"), "file_path", "left_anti").select("file_path")
        dropped = gone.count()
        added = self._append(spark, listed.join(known.select("file_path"), "file_path", "left_anti").select(*ENTRY.names))
        if dropped:
            self.compact(spark, gone)
        return added, dropped
