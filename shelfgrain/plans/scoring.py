"""The scoring job: read, label, sample, score, measure and append in one pass."""

from __future__ import annotations

import argparse
import datetime as dt
import os
from collections.abc import Callable
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..operators import sampling, scoring, shaping
from ..sources import tables



@dataclass(frozen=True)
class ScoreConfig:
    """Settings; the environment sets defaults and command-line options win."""

    input: str = "fact_reviews"
    output: str = "predicted_reviews"
    test_limit: int = 0
    sample_mode: str = "random"
    seed: int = 42
    npartitions: int = 0
    shuffle_partitions: int = 0
    arrow_batch: int = 256
    thresh_pos: float = fv.THRESH_POS
    thresh_neg: float = fv.THRESH_NEG
    max_len: int = fv.MAX_LEN
    write_mode: str = "append"
    run_date: str = ""

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> ScoreConfig:
        env = os.environ if env is None else env
        given = {f.name: _typed(f.default, env[f.name.upper()]) for f in fields(cls) if f.name.upper() in env}
        return cls(**given)

    @classmethod
    def from_args(cls, argv: list[str], env: dict[str, str] | None = None) -> ScoreConfig:
        base = cls.from_env(env)
        parser = argparse.ArgumentParser("score reviews")
        for f in fields(cls):
            choices = {"sample_mode": ["none", "head", "random", "balanced"], "write_mode": ["append", "overwrite"]}
            parser.add_argument(f"--{f.name}", type=type(f.default), default=None, choices=choices.get(f.name))
        given = {k: v for k, v in vars(parser.parse_args(argv)).items() if v is not None}
        return replace(base, **given)

    def apply(self, spark: SparkSession) -> None:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", self.arrow_batch)
        if self.shuffle_partitions > 0:
            spark.conf.set("spark.sql.shuffle.partitions", self.shuffle_partitions)


def _typed(default, value: str):
    return type(default)(value)


Score = Callable[[DataFrame, ScoreConfig], DataFrame]


def score_frame(reviews: DataFrame, cfg: ScoreConfig, score: Score) -> DataFrame:
    """Labelled, sampled and scored rows; `score` adds the column `prob` and is given the settings, such as `max_len`.

    Without a sample the rows may be spread over `npartitions` first; 0 keeps the scan's. Adaptive execution
    splits partitions beyond its advisory size, so that more rows make more tasks, not larger ones.
    """
    labelled = shaping.with_true_label(shaping.valid_for_scoring(reviews))
    rows = sampling.sample(labelled, cfg.test_limit, cfg.sample_mode, cfg.seed)
    if cfg.test_limit <= 0 and cfg.npartitions > 0:
        rows = rows.hint("rebalance", cfg.npartitions)
    predicted = scoring.with_pred_label(score(rows, cfg), "prob", cfg.thresh_pos, cfg.thresh_neg)
    return scoring.with_correct(predicted)


def score_reviews(spark: SparkSession, cfg: ScoreConfig, score: Score) -> dict:
    """Run the job. The texts are scored once: the metrics are observed while writing."""
    cfg.apply(spark)
    scored = score_frame(tables.read_table(spark, cfg.input), cfg, score).drop("prob")
    judged = F.col("true_label") != fv.NEUTRAL
    metrics = Observation("scoring")
    seen = scored.observe(
        metrics,
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(judged).alias("n_judged"),
        F.avg(F.when(judged, F.col("is_correct").cast("int"))).alias("accuracy"),
    )
    day = cfg.run_date or dt.date.today().isoformat()
    tables.write_partitioned(shaping.with_run_date(seen, day), cfg.output, ["run_date"], cfg.write_mode)
    return dict(metrics.get)


def main(argv: list[str] | None = None) -> None:
    import sys

    from ..session import build_session

    cfg = ScoreConfig.from_args(sys.argv[1:] if argv is None else argv)
    spark = build_session("score-reviews")
    positive, negative = fv.OPINION_WORDS[:-1], fv.OPINION_WORDS[-1:]
    result = score_reviews(
        spark, cfg, lambda df, _: df.withColumn("prob", scoring.lexicon_prob(F.col("content"), positive, negative))
    )
    shown = "none" if result["accuracy"] is None else f"{result['accuracy']:.4f}"
    print(f"rows {result['n_rows']}, accuracy without neutral {shown}")


if __name__ == "__main__":
    main()
