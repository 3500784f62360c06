"""Which pages of a job count, decided while they arrive.

Pages come in any order and over many batches. For each job the state holds the next page
to decide on, the empty ones in a row before it, and the numbers of pages that came early;
payloads are no part of it. A page is decided once all before it are there, so what leaves
is what `operators.paging` gives for all pages at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import fixed_values as fv
from .landing import ROCKSDB

STATE = "next long, empties int, stopped boolean, early array<long>, early_items array<long>"


def advance(next_page: int, empties: int, early: dict[int, int], k: int) -> tuple[int, int, bool, list[tuple[int, int]]]:
    """Decide all pages in a row from `next_page` on: the new state, whether the job has ended, and the pages that stay."""
    kept = []
    while next_page in early:
        n_items = early.pop(next_page)
        if n_items > 0:
            kept.append((next_page, n_items))
            empties = 0
        else:
            empties += 1
            if empties == k:
                return next_page + 1, empties, True, kept
        next_page += 1
    return next_page, empties, False, kept


def kept_pages(
    stream: DataFrame, job: str = "job", page: str = "page", n_items: str = "n_items", k: int = fv.EMPTY_PAGES_TO_STOP, patience_ms: int | None = None, first_page: int = 1
) -> DataFrame:
    """(job, page, n_items): non-empty pages of each job before its first k empty ones in a row; k=1 stops at the first.

    A page that comes twice counts once, the first time; a null number of items is an empty
    page; rows without a job or page are left out. With `patience_ms`, a page that is still
    missing after that time without news of its job counts as an empty attempt, so that
    later pages need not wait for ever. Nothing leaves a job that has ended.
    """
    rows = stream.select(job, page, n_items).dropna(subset=[job, page])
    kind = rows.schema[job].dataType.simpleString()

    def decide(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        next_page, empties, stopped, pages, items = state.get if state.exists else (first_page, 0, False, [], [])
        early = dict(zip(pages, items))
        kept: list[tuple[int, int]] = []
        if state.hasTimedOut and early:
            early[next_page] = 0
        for batch in batches:
            for number, n in zip(batch[page].tolist(), batch[n_items].fillna(0).tolist()):
                if not stopped and number >= next_page:
                    early.setdefault(int(number), int(n))
        if not stopped:
            next_page, empties, stopped, kept = advance(next_page, empties, early, k)
        if stopped:
            early = {}
        state.update((next_page, empties, stopped, list(early), list(early.values())))
        if patience_ms is not None and early:
            state.setTimeoutDuration(patience_ms)
        if kept:
            yield pd.DataFrame({job: [key[0]] * len(kept), page: [p for p, _ in kept], n_items: [n for _, n in kept]})

    timeout = GroupStateTimeout.NoTimeout if patience_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return rows.groupBy(job).applyInPandasWithState(decide, f"`{job}` {kind}, `{page}` long, `{n_items}` long", STATE, "append", timeout)


def drain_pages(kept: DataFrame, out: str, checkpoint: str, once: bool = False) -> None:
    """Decide on everything that has landed and append it to `out`, each page once.

    `once` takes it in one batch, as is needed with patience: a stream that waits for time
    to pass never runs out of batches.
    """
    spark = kept.sparkSession
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, ROCKSDB)
    try:
        query = kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(**({"once": True} if once else {"availableNow": True})).start()
        query.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)
