"""Landed files: CSV and JSON, the dated folder layout, manifests and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOM = "\ufeff"
NO_VALUE = "\u0000"
NO_CATEGORY = "-"
# a quoted line break keeps a CSV file from being split, so files stay small
ROWS_PER_FILE = 200_000
LAYOUT = ["source", "kind", "category", "yyyy", "mm", "dd"]
_PATH = (
    r"raw-data/(?:source=)?([^/]+)/(?:kind=)?([^/]+)/(?:(category=)?([^/]+)/)?"
    r"(?:yyyy=)?([0-9]{4})/(?:mm=)?([0-9]{2})/(?:dd=)?([0-9]{2})/(?:(?:product_id=)?([^/]+)/)?([^/]+)$"
)


def write_csv(df: DataFrame, path: str, header: bool = True, bom: bool = False, mode: str = "errorifexists", by: list[str] | None = None) -> None:
    """CSV with quotes doubled and blanks kept. The byte-order mark rides on the first column name."""
    if bom and header:
        first = df.columns[0]
        df = df.withColumnRenamed(first, BOM + first)
    writer = (
        df.write.mode(mode)
        .option("header", header)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
    )
    (writer.partitionBy(*by) if by else writer).csv(path)


def csv_reader(spark: SparkSession) -> DataFrameReader:
    """Reader for landed CSV. An empty field is null, a quoted empty one stays an empty text."""
    return (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", NO_VALUE)
    )


def read_landed_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, n: int | None = None) -> DataFrame:
    """Landed CSV with line breaks inside quotes. Header names are trimmed; the first n rows on request."""
    reader = csv_reader(spark)
    df = reader.schema(schema).csv(path) if schema else reader.csv(path)
    df = df.toDF(*[c.strip().lstrip(BOM) for c in df.columns])
    return df if n is None else df.limit(n)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType, lines: bool = True) -> DataFrame:
    """JSON rows; `lines=False` for files that hold one array or object over many lines."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def read_json_documents(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """One VARIANT per file, for documents whose shape is not known.

    A file that does not parse, or is beyond the size of a VARIANT, has a null document and its
    length in `unparsed_chars`, which is null for all others; with `strict` it is an error.
    """
    document = F.parse_json("value") if strict else F.try_parse_json("value")
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file_path"), document.alias("document"), F.char_length("value").alias("_chars")).select(
        "file_path", "document", F.when(F.col("document").isNull(), F.col("_chars")).alias("unparsed_chars")
    )


# -------------------------------------------------------------------- dated layout


def with_landing_cols(df: DataFrame, source: str, kind: str, category: Column, day: Column) -> DataFrame:
    """Add the columns that name the folders of the landing layout. A missing category is the folder `-`."""
    return df.withColumns(
        {
            "source": F.lit(source),
            "kind": F.lit(kind),
            "category": F.coalesce(F.nullif(category, F.lit("")), F.lit(NO_CATEGORY)),
            "yyyy": F.date_format(day, "yyyy"),
            "mm": F.date_format(day, "MM"),
            "dd": F.date_format(day, "dd"),
        }
    )


def write_landing(df: DataFrame, root: str, fmt: str = "csv", bom: bool = False, mode: str = "append") -> None:
    """Write below raw-data/{source}/{kind}/{category}/{yyyy}/{mm}/{dd}.

    Rows are rebalanced by folder: small folders get one file, and a folder with most of
    the rows is split over several tasks instead of filling one.
    """
    placed = df.hint("rebalance", *LAYOUT)
    target = root.rstrip("/") + "/raw-data"
    if fmt == "csv":
        write_csv(placed, target, bom=bom, mode=mode, by=LAYOUT)
    elif fmt in ("json", "parquet"):
        placed.write.mode(mode).partitionBy(*LAYOUT).format(fmt).save(target)
    else:
        raise ValueError(f"unknown landing format {fmt!r}")


def _unquoted(value: Column) -> Column:
    return F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))


def landing_path_cols(path: Column, encoded: bool = True) -> dict[str, Column]:
    """Fields of a landed file's path, with plain folders or with name=value folders.

    Values of name=value folders are escaped on disk. Paths from file metadata are `encoded`
    once more as a whole; those of a file listing are not.
    """

    def part(group: int) -> Column:
        found = F.regexp_extract(path, _PATH, group)
        return _unquoted(found) if encoded else found

    named = F.regexp_extract(path, _PATH, 3) != ""
    value = F.when(named, _unquoted(part(4))).otherwise(part(4))
    category = F.when(~value.isin("", NO_CATEGORY), value)
    stamp = F.regexp_extract(part(9), r"_([0-9]{8}_[0-9]{4,6})\.", 1)
    return {
        "source": part(1),
        "kind": part(2),
        "category": category,
        "landed_on": F.make_date(part(5).try_cast("int"), part(6).try_cast("int"), part(7).try_cast("int")),
        "product_id": F.nullif(F.when(named, _unquoted(part(8))).otherwise(part(8)), F.lit("")),
        "file_stamp": F.nullif(stamp, F.lit("")),
    }


def with_path_fields(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Add path fields to rows read from landed files."""
    fields = landing_path_cols(F.col("_metadata.file_path"))
    return df.withColumns({k: v for k, v in fields.items() if names is None or k in names})


# ------------------------------------------------------------- manifests and audits


def manifest(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Landed files with size, time and path fields. The content column is never read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select(F.col("path").alias("file_path"), "length", "modificationTime")
    return files.withColumns(landing_path_cols(F.col("file_path"), encoded=False))


def not_yet_landed(todo: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """Work items without a landed file; a missing key is a work item like others."""
    known = landed.select(F.col(key).alias("_landed")).distinct()
    return todo.join(known, F.col(key).eqNullSafe(F.col("_landed")), "left_anti")


def load_audit(df: DataFrame, loaded_at: str) -> DataFrame:
    """Per landed file: records, column list and load time."""
    columns = ",".join(df.columns)
    counted = df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("records"))
    return counted.withColumns({"columns": F.lit(columns), "loaded_at": F.lit(loaded_at)})


def append_rows(df: DataFrame, path: str, columns: list[str]) -> None:
    """Append rows with a fixed column order; each file starts with the header once."""
    write_csv(df.select(*columns), path, mode="append")


def write_batches(df: DataFrame, path: str, batch: str = "batch") -> None:
    """Keep partial results per checkpoint batch; a repeated batch replaces itself."""
    placed = df.hint("rebalance", batch)
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(batch).parquet(path)
