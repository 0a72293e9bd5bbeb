"""Scoring: one batch job over all prompts through a pluggable model client.

The model call is the one step that must run Python: prompts go to the
client in Arrow batches (``mapInPandas``), one client per task, with a few
calls in flight per task.  Everything around it (score parsing, shortlist)
is native.  Replies are keyed by ``(house_id, wish_id)``: write them to a table
and anti-join already answered keys before calling again, because Spark may
re-run a task and every re-run repeats paid calls.

SURVEY IDs: M5, M6, A7.
"""

from __future__ import annotations

import math
import re
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.functions.text import col_, java_pattern
from hearth.operators.enrich import pending
from hearth.operators.prompt import first_per_key, messages_json
from hearth.session import ship_package

# How a reply states its score, and the valid range.
SCORE_RE = r"满意分[\s*]*[:：][\s*]*([0-9]+)"
MAX_SCORE = 100
SHORTLIST_MIN_SCORE = 60

REPLY_SCHEMA = "house_id bigint, wish_id bigint, reply string, outcome string"


class ModelClient(Protocol):
    def complete(self, messages_json: str) -> str: ...


ClientFactory = Callable[[], ModelClient]


class _Pace:
    """Lets calls through at most every ``gap`` seconds."""

    def __init__(self, gap: float):
        self.gap, self.next, self.lock = gap, 0.0, threading.Lock()

    def wait(self) -> None:
        with self.lock:
            at = max(self.next, time.monotonic())
            self.next = at + self.gap
        time.sleep(max(0.0, at - time.monotonic()))


def _call_batches(factory: ClientFactory, in_flight: int, gap: float = 0.0):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, pace = factory(), _Pace(gap)

        def one(m):
            if gap:
                pace.wait()
            try:
                reply = client.complete(m) or ""
                return reply, "answered" if reply else "empty"
            except Exception as e:  # any client error: the reply is '' and is asked again next run
                return "", type(e).__name__

        with ThreadPoolExecutor(max_workers=max(1, in_flight)) as pool:
            for pdf in batches:
                got = list(pool.map(one, pdf["messages_json"].tolist()))
                yield pd.DataFrame({"house_id": pdf["house_id"], "wish_id": pdf["wish_id"],
                                    "reply": [r for r, _ in got], "outcome": [o for _, o in got]})
    return run


def parse_score(reply) -> Column:
    """Score from '满意分: 85分。...'; null when absent or above 100."""
    p = java_pattern(SCORE_RE)
    n = F.regexp_extract(F.regexp_substr(col_(reply), F.lit(p)), p, 1).try_cast("int")
    return F.when(n <= MAX_SCORE, n).cast("int")


def unanswered(prompts: DataFrame, answered: DataFrame | None) -> DataFrame:
    """The prompts whose key is not among ``answered``."""
    if answered is None:
        return prompts
    return prompts.join(answered.select("house_id", "wish_id"), ["house_id", "wish_id"], "left_anti")


def waves(prompts: DataFrame, concurrency: int, batch: int) -> DataFrame:
    """Prompts with ``wave``, dealt evenly so that a wave gives ``concurrency`` tasks about ``batch`` prompts each.

    Write the result before using it: the dealing is not repeatable, the written column is.
    """
    tasks = concurrency * max(1, math.ceil(prompts.count() / (concurrency * batch)))
    return prompts.repartition(tasks).withColumn("wave", F.floor(F.spark_partition_id() / concurrency).cast("int"))


def reply_batch(prompts: DataFrame, factory: ClientFactory, answered: DataFrame | None = None,
                concurrency: int | None = None, in_flight: int = 4, per_minute: float | None = None) -> DataFrame:
    """prompts(house_id, wish_id, messages) -> replies(house_id, wish_id, reply, outcome, score).

    ``outcome`` is ``answered``, ``empty``, or the name of the error that the client raised.

    ``answered``: replies already stored (their keys are skipped; failed calls
    with '' replies should be filtered out of it by the caller so they retry).
    ``concurrency``: number of tasks calling the model (a round-robin
    repartition); ``in_flight``: calls per task at once.  ``per_minute`` bounds the calls of all
    tasks together (``concurrency`` must be given): each task takes its equal share.
    """
    ship_package(prompts.sparkSession)
    if per_minute and not concurrency:
        raise ValueError("a shared rate needs the number of tasks that share it")
    todo = unanswered(prompts, answered)
    if concurrency:
        todo = todo.repartition(concurrency)
    calls = todo.select("house_id", "wish_id", messages_json(F.col("messages")).alias("messages_json"))
    gap = 60.0 * concurrency / per_minute if per_minute else 0.0
    out = calls.mapInPandas(_call_batches(factory, in_flight, gap), REPLY_SCHEMA)
    return out.withColumn("score", parse_score(F.col("reply")))


def shortlist(replies: DataFrame, listings: DataFrame, min_score: int = SHORTLIST_MIN_SCORE,
              group_by=("community", "house_type"), key: str = "house_id",
              order: str = "seq") -> DataFrame:
    """Communities and layouts with qualifying listings, per wish.

    Groups are aggregated partially before the shuffle (count / max / sum),
    so a community holding a third of all listings is no hot spot; the
    listings themselves are not collected (see ``shortlisted_listings``).
    """
    attrs = first_per_key(listings, key, order).select(key, *group_by)
    ok = replies.filter(F.col("score") >= min_score).join(attrs, key, "inner")
    return (ok.groupBy("wish_id", *group_by)
            .agg(F.count(F.lit(1)).alias("n_listings"),
                 F.max("score").alias("max_score"),
                 F.avg("score").alias("avg_score")))


def shortlisted_listings(replies: DataFrame, listings: DataFrame,
                         min_score: int = SHORTLIST_MIN_SCORE, key: str = "house_id",
                         order: str = "seq") -> DataFrame:
    """The qualifying listings with their score, one row per (wish, listing)."""
    first = first_per_key(listings, key, order)
    return replies.filter(F.col("score") >= min_score).join(first, key, "inner")


# --- offline client -------------------------------------------------------------

_UNIT_PRICE_IN_PROMPT = re.compile(r"单价: ([-+0-9.eE]+|nan|inf)元/平")
STUB_MODULUS = 131
STUB_FAIL_AT = 113
STUB_REASON = "根据用户需求来看，单价与预期对比给出。"


class OfflineStubClient:
    """Deterministic stand-in for a chat model, for tests and offline runs.

    The score is a pure function of the prompt: floor(unit price) mod 131, so
    scores above 100 (invalid) occur too; a prompt without a unit price, or
    whose value mod 131 is 113, fails like a broken call.
    """

    def complete(self, messages_json: str) -> str:
        m = _UNIT_PRICE_IN_PROMPT.search(messages_json)
        if not m:
            raise RuntimeError("no unit price in prompt")
        v = float(m.group(1))
        if not math.isfinite(v):
            raise RuntimeError("unit price is not a number")
        n = math.floor(v) % STUB_MODULUS
        if n == STUB_FAIL_AT:
            raise RuntimeError("simulated model failure")
        return f"满意分: {n}分。{STUB_REASON}"


def offline_stub() -> ModelClient:
    return OfflineStubClient()


__all__ = ["ModelClient", "OfflineStubClient", "offline_stub", "parse_score", "reply_batch",
           "shortlist", "shortlisted_listings", "pending"]
