"""Readers, writers, manifests, the stream and the scoring job on fresh folders."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfgrain import schemas, session
from shelfgrain.operators import paging, shaping
from shelfgrain.plans.scoring import ScoreConfig, score_reviews
from shelfgrain.sources import landing, landing_log, tables
from shelfgrain.streaming.landing import LandedFiles, drain
from shelfgrain.suite import scans
from shelfgrain.suite.scores import lexicon

REVIEW = T.StructType().add("id", "string").add("content", "string")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def folder(spark):
    return session.scratch_dir(spark, "test")


def test_scratch_folder_is_below_the_shared_one(spark):
    assert session.scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("bom", [False, True])
def test_csv_keeps_line_breaks_quotes_and_blanks(spark, folder, bom):
    data = [("1", 'a "quoted", line\r\nnext'), ("2", " blanks "), ("3", "\\back\\"), ("4", None), ("5", "")]
    df = spark.createDataFrame(data, REVIEW)
    landing.write_csv(df, folder, bom=bom)
    assert landing.read_landed_csv(spark, folder, REVIEW).orderBy("id").collect() == df.orderBy("id").collect()
    assert landing.read_landed_csv(spark, folder).columns == ["id", "content"]
    assert landing.read_landed_csv(spark, folder, n=2).count() == 2


def test_foreign_csv_header_is_trimmed(spark, tmp_path):
    (tmp_path / "a.csv").write_text(" product_id , product_url \n1,/x\n", encoding="utf-8-sig")
    assert landing.read_landed_csv(spark, str(tmp_path)).columns == ["product_id", "product_url"]


def test_json_documents_of_unknown_shape(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"reviews": [1, 2]}, indent=2))
    (tmp_path / "b.json").write_text("{broken")
    docs = landing.read_json_documents(spark, str(tmp_path))
    got = {r["f"]: r["n"] for r in docs.select(F.regexp_extract("file_path", "[^/]+$", 0).alias("f"), F.expr("size(try_variant_get(document, '$.reviews', 'array<variant>'))").alias("n")).collect()}
    assert got == {"a.json": 2, "b.json": None}


def test_json_arrays_over_many_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": "1", "content": "x"}, {"id": "2"}], indent=2))
    assert rows(landing.read_json(spark, str(tmp_path), REVIEW, lines=False)) == [("1", "x"), ("2", None)]


@pytest.mark.parametrize("path, want", [
    ("gs://b/raw-data/shop/products/a%26b/2025/07/02/a%26b_20250702_093000.csv", ("shop", "products", "a&b", dt.date(2025, 7, 2), None, "20250702_093000")),
    ("file:/x/raw-data/shop/reviews/2025/07/02/123/123_20250702_0930.csv", ("shop", "reviews", None, dt.date(2025, 7, 2), "123", "20250702_0930")),
    ("file:/x/raw-data/source=s/kind=k/category=a%252Fb+c/yyyy=2025/mm=07/dd=02/part-0.csv", ("s", "k", "a/b+c", dt.date(2025, 7, 2), None, None)),
])
def test_landing_paths(spark, path, want):
    df = spark.createDataFrame([(path,)], "p string")
    assert tuple(df.select(*[c.alias(k) for k, c in landing.landing_path_cols(F.col("p")).items()]).collect()[0]) == want


def test_landing_manifest_and_audit(spark, folder):
    df = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "b")], "id string, category_name string")
    placed = landing.with_landing_cols(df, "shop", "products", F.col("category_name"), F.lit("2025-07-02").cast("date"))
    for fmt in ("csv", "json"):
        landing.write_landing(placed, f"{folder}/{fmt}", fmt)
        files = landing.manifest(spark, f"{folder}/{fmt}", f"*.{fmt}")
        assert rows(files.select("source", "kind", "category", "landed_on").distinct()) == [
            ("shop", "products", c, dt.date(2025, 7, 2)) for c in "ab"]
        assert files.filter("length > 0").count() == 2
        todo = spark.createDataFrame([("a",), ("c",)], "category string")
        assert rows(landing.not_yet_landed(todo, files, "category")) == [("c",)]
    audit = landing.load_audit(spark.read.option("header", True).csv(f"{folder}/csv/raw-data"), "now")
    assert sorted(r["records"] for r in audit.collect()) == [1, 2]


def test_append_keeps_one_header_per_file_and_the_column_order(spark, folder):
    landing.append_rows(spark.createDataFrame([("x", 1)], "b string, a int"), folder, ["a", "b"])
    landing.append_rows(spark.createDataFrame([(2, "y", 0)], "a int, b string, c int"), folder, ["a", "b"])
    assert rows(landing.read_landed_csv(spark, folder)) == [("1", "x"), ("2", "y")]


def test_partition_overwrite_replaces_only_its_day(spark, folder):
    day = lambda ids, d: shaping.with_run_date(spark.createDataFrame([(i,) for i in ids], "id int"), d)
    tables.write_partitioned(day([1], "2025-07-01"), folder, ["run_date"])
    tables.write_partitioned(day([2], "2025-07-02"), folder, ["run_date"])
    tables.write_partitioned(day([3], "2025-07-02"), folder, ["run_date"], "overwrite")
    tables.write_partitioned(day([4], "2025-07-02"), folder, ["run_date"], "append")
    assert rows(spark.read.parquet(folder).select("id")) == [(1,), (3,), (4,)]


def test_batches_replace_themselves(spark, folder):
    pages = paging.batch_id(spark.range(1, 26).withColumnRenamed("id", "page"))
    landing.write_batches(pages, folder)
    landing.write_batches(pages.filter("batch = 2"), folder)
    assert rows(spark.read.parquet(folder).groupBy("batch").count()) == [(0, 10), (1, 10), (2, 5)]


def test_log_knows_what_landed_without_listing(spark, folder, monkeypatch):
    log = landing_log.LandingLog(folder)
    day = F.lit("2025-07-02").cast("date")
    rows_of = lambda *names: spark.createDataFrame([(n, 1) for n in names], "cat string, n int")
    assert log.entries(spark).collect() == []
    assert log.land(rows_of("a", "b/c & d"), "shop x", "products", F.col("cat"), day) == 2
    assert log.land(rows_of("a", None), "shop x", "products", F.col("cat"), day) == 2
    assert log.land(rows_of("e").limit(0), "shop x", "products", F.col("cat"), day) == 0
    monkeypatch.setattr(landing, "manifest", lambda *a, **k: pytest.fail("a folder was listed"))
    todo = spark.createDataFrame([("a",), ("b/c & d",), ("new",), (None,)], "category string")
    assert rows(landing.not_yet_landed(todo, log.entries(spark), "category")) == [("new",)]


def test_log_is_repaired_and_compacted(spark, folder, monkeypatch):
    monkeypatch.setattr(landing_log, "COMPACT_FILES", 3)
    log = landing_log.LandingLog(folder)
    day = F.lit("2025-07-02").cast("date")
    for k in range(5):
        log.land(spark.createDataFrame([(f"c{k}",)], "cat string"), "shop", "products", F.col("cat"), day)
    assert log._generations(spark)[-1][0] > 0 and len(log._generations(spark)) == 1
    # a lost entry: a landing that wrote files and no log; and a file that has gone
    lost = spark.createDataFrame([("lost",)], "cat string")
    landing.write_landing(landing.with_landing_cols(lost, "shop", "products", F.col("cat"), day), folder)
    gone = log.entries(spark).filter("category = 'c1'").first()["file_path"]
    session.discard(spark, gone)
    assert log.repair(spark) == (1, 1)
    assert sorted(r["category"] for r in log.entries(spark).collect()) == ["c0", "c2", "c3", "c4", "lost"]
    assert log.repair(spark) == (0, 0)


def test_stream_picks_up_new_files_once(spark, folder):
    schema = T.StructType().add("id", "string").add("scraped_at", "timestamp")
    out, state = f"{folder}/out", f"{folder}/state"

    def land(ids, at=dt.datetime(2025, 7, 2)):
        spark.createDataFrame([(i, at) for i in ids], schema).write.mode("append").parquet(f"{folder}/in")
        drain(spark, LandedFiles(f"{folder}/in", schema, ["id"]), out, state, ["scraped_at"])
        return rows(spark.read.parquet(out).select("id"))

    assert land(["a", "b", "a", "", None]) == [("a",), ("b",)]
    assert land(["b", "c"]) == [("a",), ("b",), ("c",)]
    assert land([]) == [("a",), ("b",), ("c",)]
    # months older than what has been seen, but new
    assert land(["old", "a"], dt.datetime(2025, 1, 5)) == [("a",), ("b",), ("c",), ("old",)]


def test_a_batch_that_runs_again_replaces_itself(spark, folder):
    schema = T.StructType().add("id", "string").add("n", "integer")
    out, state = f"{folder}/out", f"{folder}/state"
    spark.createDataFrame([("a", 1), ("a", 0), ("b", 2)], schema).write.parquet(f"{folder}/in")
    for attempt in range(2):  # a fresh checkpoint numbers its batches from 0 again, as a repeated batch does
        drain(spark, LandedFiles(f"{folder}/in", schema, ["id"]), out, f"{state}{attempt}", [F.col("n")])
        assert rows(spark.read.parquet(out).select("id", "n")) == [("a", 0), ("b", 2)]


def test_work_of_a_batch_does_not_grow_with_history(spark, folder):
    """Twenty landings of 60 rows, half of them seen before: each batch reads its own rows and touches its own keys."""
    schema = T.StructType().add("id", "long").add("n", "integer")
    out, state = f"{folder}/out", f"{folder}/state"
    landed = LandedFiles(f"{folder}/in", schema, ["id"])
    read, touched = [], []
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    for k in range(20):
        spark.createDataFrame([(30 * k + i, k) for i in range(60)], schema).coalesce(2).write.mode("append").parquet(f"{folder}/in")
        for batch in drain(spark, landed, out, state, ["n"]):
            if batch["numInputRows"]:
                read.append(batch["numInputRows"])
                touched.append(batch["stateOperators"][0]["numRowsUpdated"])
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert read == [60] * 20 and max(touched) <= 60
    # the batch that first had a key keeps it
    assert rows(spark.read.parquet(out).select("id", "n")) == [(i, max(0, i // 30 - 1)) for i in range(630)]


def test_first_row_of_a_batch_may_be_in_any_of_its_files(spark, folder):
    schema = T.StructType().add("id", "string").add("n", "integer").add("note", "string")
    for n in (5, 2, 9):
        spark.createDataFrame([("a", n, f"from {n}"), (f"own {n}", n, None), ("", n, "no key")], schema).coalesce(1).write.mode("append").csv(f"{folder}/in", header=True)
    landed = LandedFiles(f"{folder}/in", schema, ["id"], fmt="csv")
    drain(spark, landed, f"{folder}/out", f"{folder}/state", ["n"])
    got = rows(spark.read.parquet(f"{folder}/out").select("id", "n", "note"))
    assert got == [("a", 2, "from 2"), ("own 2", 2, None), ("own 5", 5, None), ("own 9", 9, None)]


def fact_table(spark, folder):
    data = [("1", "the the", 5), ("2", "sch", 1), ("3", "the", 1), ("4", "x", 3), ("5", "", 5), ("6", None, 5), ("7", "y", 0), ("8", "z", None)]
    spark.createDataFrame(data, schemas.FACT_REVIEWS).write.parquet(folder)


def test_scoring_job_measures_what_it_writes(spark, folder):
    fact_table(spark, f"{folder}/in")
    cfg = ScoreConfig(input=f"{folder}/in", output=f"{folder}/out", test_limit=0, npartitions=3, write_mode="overwrite", run_date="2025-07-02")
    for _ in range(2):
        metrics = score_reviews(spark, cfg, lexicon)
    assert metrics == {"n_rows": 4, "n_judged": 3, "accuracy": pytest.approx(2 / 3)}
    out = spark.read.parquet(f"{folder}/out")
    assert {f.name for f in out.schema} == set(schemas.PREDICTED_REVIEWS.names)
    assert rows(out.select("review_uid", "true_label", "pred_label", "is_correct")) == [
        ("1", "positive", "positive", True), ("2", "negative", "negative", True), ("3", "negative", "positive", False), ("4", "neutral", "neutral", True)]


def test_scoring_nothing_gives_no_accuracy_and_no_error(spark, folder):
    spark.createDataFrame([("1", "", 5)], schemas.FACT_REVIEWS).write.parquet(f"{folder}/in")
    metrics = score_reviews(spark, ScoreConfig(input=f"{folder}/in", output=f"{folder}/out"), lexicon)
    assert metrics["n_rows"] == 0 and metrics["accuracy"] is None


def test_settings_environment_first_then_options():
    env = {"THRESH_POS": "0.7", "MAX_LEN": "64", "OTHER": "x"}
    cfg = ScoreConfig.from_args(["--thresh_pos", "0.8", "--sample_mode", "balanced", "--write_mode", "overwrite"], env)
    assert (cfg.thresh_pos, cfg.thresh_neg, cfg.max_len, cfg.sample_mode, cfg.write_mode) == (0.8, 0.4, 64, "balanced", "overwrite")
    assert ScoreConfig.from_env(env).thresh_pos == 0.7
    with pytest.raises(SystemExit):
        ScoreConfig.from_args(["--sample_mode", "other"], {})


def test_json_files_that_do_not_parse_are_reported(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"reviews": [1, 2]}')
    (tmp_path / "b.json").write_text("{broken")
    docs = landing.read_json_documents(spark, str(tmp_path))
    assert rows(docs.select(F.regexp_extract("file_path", "[^/]+$", 0), "unparsed_chars")) == [("a.json", None), ("b.json", 7)]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        landing.read_json_documents(spark, str(tmp_path), strict=True).select(F.expr("explode(try_variant_get(document, '$.reviews', 'array<variant>'))")).collect()


def test_documents_of_a_hot_category_stay_small(spark, folder, monkeypatch):
    parts = spark.read.parquet("/root/testdata/sf0.001/part.parquet").limit(1).drop("p_partkey")
    spark.range(12_000).withColumnRenamed("id", "p_partkey").crossJoin(parts).write.parquet(f"{folder}/in/part.parquet")
    monkeypatch.setattr(scans, "scratch_dir", lambda spark, name: f"{folder}/{name}")
    got = scans.whole_json_files(spark, f"{folder}/in").select("product_id").collect()
    assert sorted(int(r["product_id"]) for r in got) == list(range(12_000))
    items = landing.read_json_documents(spark, f"{folder}/documents").select(F.expr("size(try_variant_get(document, '$.items', 'array<variant>'))").alias("n")).collect()
    assert sum(r["n"] for r in items) == 12_000 and max(r["n"] for r in items) <= 5_000


def test_parts_of_the_landing_query_are_several_files(spark, folder, monkeypatch):
    monkeypatch.setattr(scans, "scratch_dir", lambda spark, name: f"{folder}/{name}")
    got = scans.landing_stream(spark, "/root/testdata/sf0.001")
    assert got.count() == got.select("review_uid").distinct().count() > 0
    arrivals = spark.read.parquet(f"{folder}/arrivals").select(F.input_file_name().alias("f"), F.month("scraped_at").alias("part"))
    assert all(r["files"] > 1 for r in arrivals.groupBy("part").agg(F.countDistinct("f").alias("files")).collect())
    assert spark.read.parquet(f"{folder}/picked-up").select("batch_id").distinct().count() == 3
