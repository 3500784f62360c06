"""Samples, deduplication and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .ordering import top_per_key, top_rows

# ids of a sample up to this many rows go to every executor; larger ones are shuffled
BROADCAST_IDS = 200_000
# samples up to this many rows of a label are ranked, larger ones cut off by digest; below Spark's own limit
# for keeping a row limit before the shuffle, which the session sets
RANKED_ROWS = 500_000


def seeded_order(uid: str, seed: int) -> list[Column]:
    """A random but repeatable order: the digest of seed and id, then the id."""
    return [F.md5(F.concat(F.lit(str(seed)), F.col(uid))), F.col(uid)]


def sample(df: DataFrame, limit: int, mode: str = "random", seed: int = 42, uid: str = "review_uid", label: str = "true_label") -> DataFrame:
    """Draw a sample.

    none: everything (as with a limit of 0 or less). head: the first rows by id.
    balanced: a third per label; positive and neutral both get the rounding extra.
    random: half positive, half negative, an odd remainder from all other rows.
    Rows without an id cannot be told apart and are left out of random and balanced samples.
    """
    if mode == "none" or limit <= 0:
        return df
    if mode == "head":
        return top_rows(df, [F.col(uid)], limit)
    if mode == "balanced":
        return _balanced(df, limit, seed, uid, label)
    if mode == "random":
        if uid not in df.columns:
            raise ValueError(f"random sampling needs the id column {uid!r}")
        return _random(df, limit, seed, uid, label)
    raise ValueError(f"unknown sample mode {mode!r}")


def quotas(limit: int) -> dict[str, int]:
    third = limit // 3
    extra = limit - 3 * third
    return {fv.POSITIVE: third + extra, fv.NEUTRAL: third + extra, fv.NEGATIVE: third}


def _balanced(df: DataFrame, limit: int, seed: int, uid: str, label: str) -> DataFrame:
    quota = quotas(limit)
    known = df.filter(F.col(uid).isNotNull())
    if max(quota.values()) > RANKED_ROWS:
        return first_by_digest(known, quota, label, uid, seed)
    ranked = top_per_key(known, [label], seeded_order(uid, seed), max(quota.values()), rank="_rank")
    return ranked.filter(F.col("_rank") <= _of_label(quota, label)).drop("_rank")


def _of_label(values: dict[str, int], label: str) -> Column:
    out = F.lit(0)
    for name, n in values.items():
        out = F.when(F.col(label) == name, n).otherwise(out)
    return out


def first_by_digest(df: DataFrame, quota: dict[str, int], label: str, uid: str, seed: int) -> DataFrame:
    """The first rows of each label by the digest of their id, for quotas of any size.

    A histogram over the first 16 bits of the digest gives the cut-off of each label. Rows
    below it are taken as they are; only those at it, a 65,536th of the label, are ranked.
    """
    digest, *tie = seeded_order(uid, seed)
    placed = df.filter(F.col(label).isin(list(quota))).withColumn("_bin", F.conv(F.substring(digest, 1, 4), 16, 10).cast("int"))
    upto = F.sum("n").over(Window.partitionBy(label).orderBy("_bin"))
    counts = placed.groupBy(label, "_bin").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", upto)
    crossing = {r[label]: r for r in counts.filter((F.col("upto") >= _of_label(quota, label)) & (F.col("upto") - F.col("n") < _of_label(quota, label))).collect()}
    cut = _of_label({name: crossing[name]["_bin"] if name in crossing else 1 << 16 for name in quota}, label)
    left = _of_label({name: quota[name] - (crossing[name]["upto"] - crossing[name]["n"]) if name in crossing else 0 for name in quota}, label)
    below = placed.filter(F.col("_bin") < cut)
    at = placed.filter(F.col("_bin") == cut).withColumn("_rank", F.row_number().over(Window.partitionBy(label, "_bin").orderBy(digest, *tie)))
    return below.unionByName(at.filter(F.col("_rank") <= left).drop("_rank")).drop("_bin")


def _random(df: DataFrame, limit: int, seed: int, uid: str, label: str) -> DataFrame:
    half, rest = limit // 2, limit % 2
    known = df.filter(F.col(uid).isNotNull())
    order = seeded_order(uid, seed)
    ends = [fv.POSITIVE, fv.NEGATIVE]
    if half > RANKED_ROWS:
        chosen = first_by_digest(known, dict.fromkeys(ends, half), label, uid, seed)
        return chosen.unionByName(top_rows(exclude(known, chosen, uid), order, rest)) if rest else chosen
    # one row more than its half of each end, and one of all others: the remainder is the first of these
    kept = known.withColumn("_end", F.when(F.col(label).isin(ends), F.col(label)).otherwise(""))
    ranked = top_per_key(kept if rest else kept.filter(F.col("_end") != ""), ["_end"], order, half + rest, rank="_rank")
    chosen = (F.col("_end") != "") & (F.col("_rank") <= half)
    if not rest:
        return ranked.filter(chosen).drop("_end", "_rank")
    spare = ranked.filter(chosen | (F.col("_rank") == F.when(F.col("_end") == "", 1).otherwise(half + 1)))
    place = Window.partitionBy(F.when(chosen, F.struct("_end", "_rank"))).orderBy(*order)
    return spare.withColumn("_place", F.row_number().over(place)).filter(F.col("_place") == 1).drop("_end", "_rank", "_place")


def exclude(df: DataFrame, ids: DataFrame, key: str, at_most: int | None = None) -> DataFrame:
    """Rows whose key is not among the ids.

    `at_most` is a proven bound on the number of ids; only then may they be broadcast.
    Otherwise distinct ids are shuffled and Spark picks the join by measured size.
    """
    right = ids.select(key).distinct()
    if at_most is not None and at_most <= BROADCAST_IDS:
        right = F.broadcast(right)
    return df.join(right, key, "left_anti")


def present(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the ids."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def distinct_ids(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def dedup_first(df: DataFrame, key: str, order: list[Column], drop_empty: bool = True) -> DataFrame:
    """The first-seen row of each key; rows with an empty key are dropped, or kept once."""
    if drop_empty:
        df = df.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    return top_per_key(df, [key], order, 1)


def dedup_by_text(df: DataFrame, text: str, order: list[Column]) -> DataFrame:
    """The first-seen row of each text. Rows sort by a hash; whole texts settle equal hashes."""
    hashed = df.withColumn("_hash", F.xxhash64(text))
    return top_per_key(hashed, ["_hash", text], order, 1).drop("_hash")


def ordered_distinct(df: DataFrame, key: str, order: str) -> DataFrame:
    """Distinct keys with the position of their first occurrence, in that order."""
    return df.groupBy(key).agg(F.min(order).alias("first_seen")).orderBy("first_seen", key)


def reviews_of(products: DataFrame, reviews: DataFrame, key: str = "product_id", keep_without: bool = True) -> DataFrame:
    """Products with their reviews as flat rows; products without reviews stay unless told otherwise.

    Spark can split a hot product of an inner join on either side, but not the optional
    side of an outer join. So the rows without reviews are added by an anti-join.
    """
    matched = products.join(reviews, key)
    if not keep_without:
        return matched
    return matched.unionByName(exclude(products, reviews, key), allowMissingColumns=True)
