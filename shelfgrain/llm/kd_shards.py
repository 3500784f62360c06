"""Shards of nearly equal bytes from a k-d tree over document metadata.

A node that has to give several shards is cut at a weighted median (at the share of its
left child, where that is not a half) along its widest metadata dimension, until each
leaf is one shard of the target bytes. Everything is DataFrame work: a cut is found by
three rounds of histograms over 16-bit digits of the sort code, whose sums are combined
before the shuffle, so only one row per node comes to the driver and no node is sorted.

A code is the dimension's value (16 bits), then a hash of the text, then a hash of the
id, so a value that a third of all rows share is cut within. Equal texts form a group
that has one place: the smallest source and language among its rows. The id's hash is
used only for groups too large to move as one; other groups are never cut apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import numbered
from .common import stored

SHARDS = 24
# groups of equal texts up to this part of a shard are never cut apart
WHOLE_PART = 100
DIGIT = 1 << 16


def _spread(value: Column) -> Column:
    """A place in 0..65535 for a category, equal for equal values; null is a category."""
    return F.pmod(F.xxhash64(value), F.lit(DIGIT)).cast("bigint")


def kd_shards(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    categories: tuple[str, ...] = ("source", "lang"),
    shards: int = SHARDS,
    row_bytes: int = 8,
) -> DataFrame:
    """id, size, text_crc32, shard and slot of every row.

    Size is the text's UTF-8 bytes plus `row_bytes`; shards have nearly equal sums of it.
    The dimensions are the size, on a logarithmic scale, and the category columns. Slots
    count from 0 within a shard in the order of the stored rows, without gaps. Groups of
    equal texts below 1/`WHOLE_PART` of a shard stay together.

    A null text is empty. Null categories are a category of their own; a missing category
    column is left out. Rows that share an id or are equal are rows like others and get
    slots of their own; rows with a null id too. Where a single text is larger than a
    shard's target, its shard is as large as that text. An empty table gives no rows.
    """
    kinds = [c for c in categories if c in docs.columns]
    body = F.coalesce(F.col(text), F.lit(""))
    names = [f"kind{i}" for i in range(len(kinds))]
    base = stored(
        docs.select(
            F.col(id).alias("id"),
            (F.octet_length(body) + row_bytes).cast("bigint").alias("size"),
            F.crc32(body.cast("binary")).alias("crc"),
            F.xxhash64(body).alias("digest"),
            *[_spread(F.col(c)).alias(n) for c, n in zip(kinds, names)],
            F.monotonically_increasing_id().alias("serial"),
        ),
        "kd-rows",
    )
    total = base.agg(F.sum("size")).first()[0] or 0
    groups = base.groupBy("digest", "crc").agg(F.sum("size").alias("bytes"), *[F.min(n).alias(n) for n in names])
    dims = [F.least(F.lit(DIGIT - 1), F.floor(F.log2(F.col("size") + 1) * 2048)).cast("bigint"), *map(F.col, names)]
    large = F.col("bytes") * shards * WHOLE_PART > total
    tail = F.pmod("digest", F.lit(DIGIT)) * DIGIT + F.when(large, F.pmod(F.xxhash64("id", "serial"), F.lit(DIGIT))).otherwise(0)
    light = stored(
        base.drop(*names).join(groups, ["digest", "crc"]).select("id", "size", "crc", "serial", F.array(*[d * (DIGIT * DIGIT) + tail for d in dims]).alias("codes")),
        "kd-codes",
    )
    placed = _grow(light, len(dims), shards).select("id", "size", "crc", "node", "serial")
    return numbered(placed, ["node"], "serial", out="position", id_limit=1 << 62).select(
        F.col("id").alias(id), "size", F.col("crc").alias("text_crc32"), F.col("node").cast("int").alias("shard"),
        (F.col("position") - 1).cast("bigint").alias("slot"),
    )


def _by_node(values: list, kind: str) -> str:
    """SQL for a constant per node, looked up with `[node]`."""
    return "array(" + ", ".join(f"cast({v!r} as {kind})" for v in values) + ")"


def _descend(levels: list[dict[int, tuple[int, int, int]]], shards: int) -> Column:
    """The node of a row below the given levels of cuts (dimension, code, shards of the left child)."""
    if not levels:
        return F.lit(0)
    tables = []
    for cuts in levels:
        dim, cut, left = zip(*[cuts.get(node, (0, 0, 0)) for node in range(shards)])
        tables.append(f"named_struct('dim', {_by_node(dim, 'int')}, 'cut', {_by_node(cut, 'bigint')}, 'left', {_by_node(left, 'int')})")
    step = "node + if(codes[level.dim[node]] >= level.cut[node], level.left[node], 0)"
    return F.expr(f"aggregate(array({', '.join(tables)}), 0, (node, level) -> {step})")


def _grow(light: DataFrame, dims: int, shards: int) -> DataFrame:
    """Rows with the shard they belong to, in `node`. All nodes of a level are cut at once; a node is named by its first shard."""
    nodes, levels = {0: shards}, []
    while any(n > 1 for n in nodes.values()):
        rows = light.withColumn("node", _descend(levels, shards))
        cuts = _cuts(rows, {first: n for first, n in nodes.items() if n > 1}, dims, shards)
        if not cuts:
            break
        levels.append({first: (*cut, nodes[first] // 2) for first, cut in cuts.items()})
        nodes = {k: v for first, n in nodes.items() for k, v in ({first: n} if n == 1 else {first: n // 2, first + n // 2: n - n // 2}).items()}
    return light.withColumn("node", _descend(levels, shards))


def _cuts(rows: DataFrame, nodes: dict[int, int], dims: int, shards: int) -> dict[int, tuple[int, int]]:
    """For each node its widest dimension, by weighted variance, and the code where its left part ends.

    Rows of a histogram are at most 65,536 for each node and dimension, which bounds the windows.
    Sums of bytes times digits are decimal: bytes times a squared digit leaves 64 bits from 2 GB of rows on.
    """
    share = F.expr(_by_node([(nodes.get(n, 1) // 2) / nodes.get(n, 1) for n in range(shards)], "double") + "[node]")
    whole, upto = Window.partitionBy("node", "dim"), Window.partitionBy("node", "dim").orderBy("digit")
    exact, digit = F.col("bytes").cast("decimal(20,0)"), F.col("digit").cast("decimal(5,0)")
    mean_of = lambda value: F.sum(exact * value).over(whole).cast("double") / F.col("total")
    first = (
        rows.filter(F.col("node").isin(list(nodes)))
        .select("node", "size", F.posexplode("codes").alias("dim", "code"))
        .groupBy("node", "dim", F.shiftright("code", 32).alias("digit")).agg(F.sum("size").alias("bytes"))
        .withColumn("total", F.sum("bytes").over(whole)).withColumn("upto", F.sum("bytes").over(upto))
        .withColumn("spread", mean_of(digit * digit) - mean_of(digit) * mean_of(digit))
        .withColumn("goal", F.col("total") * share)
        .filter((F.col("upto") >= F.col("goal")) & (F.col("upto") - F.col("bytes") < F.col("goal")))
    )
    state = {}
    for r in sorted(first.collect(), key=lambda r: (r["spread"], -r["dim"])):
        state[r["node"]] = {"dim": r["dim"], "goal": r["goal"], "before": r["upto"] - r["bytes"], "prefix": r["digit"], "bytes": r["bytes"]}
    for shift in (16, 0) if state else ():
        at = lambda name, kind, none: F.expr(_by_node([state[n][name] if n in state else none for n in range(shards)], kind) + "[node]")  # noqa: E731, B023
        coded = rows.select("node", "size", F.col("codes")[at("dim", "int", 0)].alias("code"))
        histogram = (
            coded.filter(F.shiftright("code", shift + 16) == at("prefix", "bigint", -1))
            .groupBy("node", F.shiftright("code", shift).alias("digit")).agg(F.sum("size").alias("bytes"))
            .withColumn("upto", F.sum("bytes").over(Window.partitionBy("node").orderBy("digit")) + at("before", "bigint", 0))
        )
        goal = at("goal", "double", 0.0)
        for r in histogram.filter((F.col("upto") >= goal) & (F.col("upto") - F.col("bytes") < goal)).collect():
            state[r["node"]].update(prefix=r["digit"], before=r["upto"] - r["bytes"], bytes=r["bytes"])
    # the rows at the cut itself go to the side that leaves the smaller miss
    return {n: (s["dim"], s["prefix"] + (s["before"] + s["bytes"] - s["goal"] < s["goal"] - s["before"])) for n, s in state.items()}
