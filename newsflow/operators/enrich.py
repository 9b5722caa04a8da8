"""External lookups (text model, embedding model) as one column with a result or an error.

A client is any callable ``text -> value`` that may raise. It is made once per task by a factory.
Calls of one task run on a bounded pool of threads; rows keep their order.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
import time
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, TimeoutError as CallTimeout, wait
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow import schemas
from newsflow.functions import scalars as S

Client = Callable[[str], object]
ClientFactory = Callable[[], Client]

REPLY_TYPE = T.StringType()
VECTOR_TYPE = T.ArrayType(T.FloatType())


# ---- clients --------------------------------------------------------------------------------

def digest_scorer() -> Client:
    """Offline stand-in for a text model: a JSON reply whose score comes from the text's md5."""

    def call(text: str) -> str:
        score = 1 + int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % 10
        return "Reply: " + json.dumps({"sentiment_score": score, "sentiment_reason": f"digest {score}"})

    return call


def hashed_words_embedder(dim: int = schemas.VECTOR_DIM) -> ClientFactory:
    """Offline stand-in for an embedding model: hashed bag of words, length one."""

    def make() -> Client:
        @lru_cache(maxsize=65536)
        def slot(word: str) -> int:
            return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dim

        words = re.compile(r"[^ \t\r\n]+")

        def call(text: str) -> list[float]:
            counts: dict[int, int] = {}
            for word in words.findall(text):
                i = slot(word)
                counts[i] = counts.get(i, 0) + 1
            if not counts:
                raise ValueError("no words")
            norm = math.sqrt(sum(n * n for n in counts.values()))
            vector = [0.0] * dim
            for i, n in counts.items():
                vector[i] = n / norm
            return vector

        return call

    return make


def http_client(url: str, model: str, reply_key: str, timeout_s: float, options: dict | None = None) -> ClientFactory:
    """JSON over HTTP: posts ``{model, prompt, ...}`` and returns one key of the reply."""

    def make() -> Client:
        def call(text: str):
            body = {"model": model, "prompt": text, "stream": False}
            if options:
                body["options"] = options
            request = urllib.request.Request(
                url, json.dumps(body).encode("utf-8"), {"Content-Type": "application/json"}
            )
            with urllib.request.urlopen(request, timeout=timeout_s) as response:
                value = json.loads(response.read().decode("utf-8")).get(reply_key)
            if value is None or value == "":
                raise ValueError("empty reply")
            return value

        return call

    return make


def spread(rows: DataFrame, partitions: int) -> DataFrame:
    """Rows dealt out evenly, for outside calls and markup parsing that cost more than moving a few rows."""
    return rows.repartition(partitions)


# ---- the operator ---------------------------------------------------------------------------

def _run_calls(texts: Iterable[str | None], call: Client, in_flight: int, timeout_s: float, retries: int, ordered: bool = True):
    """A result for each text, in input order, with never more than ``in_flight`` calls running.

    A call past its time is given up, but keeps its place in the pool until it returns; calls that
    find no place in their own time are not started. When ``ordered`` the oldest call holds up the
    next start; else any call that ends lets the next one start.
    """

    def attempt(text: str):
        for left in range(retries, -1, -1):
            try:
                return call(text)
            except Exception:
                if left == 0:
                    raise

    pool = ThreadPoolExecutor(in_flight)
    results: list = []
    waiting: dict = {}

    def finish(future, at: int, deadline: float) -> None:
        try:
            results[at] = (True, None, future.result(timeout=max(0.0, deadline - time.monotonic())))
        except CallTimeout:
            future.cancel()
            results[at] = (False, "timeout", None)
        except Exception as error:  # the row carries the error
            results[at] = (False, f"{type(error).__name__}: {error}", None)

    def make_room() -> None:
        ready = next(iter(waiting))
        if not ordered:
            first = min(deadline for _, deadline in waiting.values())
            done, _ = wait(waiting, timeout=max(0.0, first - time.monotonic()), return_when=FIRST_COMPLETED)
            late = [f for f, (_, deadline) in waiting.items() if deadline <= time.monotonic()]
            ready = next(iter(done), late[0] if late else ready)
        finish(ready, *waiting.pop(ready))

    try:
        for text in texts:
            results.append((False, "no input", None))
            if text is not None:
                if len(waiting) == in_flight:
                    make_room()
                waiting[pool.submit(attempt, text)] = (len(results) - 1, time.monotonic() + timeout_s)
        while waiting:
            make_room()
    finally:
        pool.shutdown(wait=False, cancel_futures=True)
    return results


def enrich(rows: DataFrame, text: str, out: str, client: ClientFactory, value_type: T.DataType, *,
           capacity: int = 50, timeout_s: float = 10.0, retries: int = 1, tasks: int | None = None, ordered: bool = True) -> DataFrame:
    """Adds ``out``: a struct ``ok, error, value``. Only the text column travels to Python.

    With ``tasks`` at most ``capacity`` calls run at once in the whole cluster: the rows are dealt into so many
    partitions (no more than ``capacity``), and each has its share of the calls. Without it, the ceiling is that of one
    task. A task that is run twice at the same time, by speculation, counts twice.
    """
    dealt = None if tasks is None else max(1, min(tasks, capacity))
    share = max(1, capacity // (dealt or 1))
    result = T.StructType(
        [
            T.StructField("ok", T.BooleanType()),
            T.StructField("error", T.StringType()),
            T.StructField("value", value_type),
        ]
    )

    @F.pandas_udf(result)
    def lookup(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        call = client()
        for texts in batches:
            done = _run_calls(texts.tolist(), call, share, timeout_s, retries, ordered)
            yield pd.DataFrame(
                {
                    "ok": [d[0] for d in done],
                    "error": [d[1] for d in done],
                    "value": pd.Series([d[2] for d in done], dtype=object),
                }
            )

    # an outside call must not be repeated or moved by the optimiser
    spread_out = rows if dealt is None else spread(rows, dealt)
    return spread_out.withColumn(out, lookup.asNondeterministic()(F.col(text)))


def split_failed(rows: DataFrame, out: str, on_error: str = "dlq") -> tuple[DataFrame, DataFrame | None]:
    """Good rows with ``out`` unwrapped, and (for ``dlq``) the failed rows with a ``reason``.

    ``fail`` stops the job on the first failed row, ``drop`` forgets it. Persist ``rows`` when both
    frames are used, so the calls run once.
    """
    r = F.col(out)
    if on_error == "fail":
        checked = F.when(r["ok"], r["value"]).otherwise(
            F.raise_error(F.concat(F.lit(f"{out}: "), F.coalesce(r["error"], F.lit("failed"))))
        )
        return rows.withColumn(out, checked), None
    good = rows.where(r["ok"]).withColumn(out, r["value"])
    if on_error == "drop":
        return good, None
    if on_error != "dlq":
        raise ValueError("on_error is one of drop, fail, dlq")
    return good, rows.where(~r["ok"]).withColumn("reason", r["error"]).drop(out)


def score_news(news: DataFrame, client: ClientFactory = digest_scorer, *, capacity: int = 2,
               timeout_s: float = 120.0, tasks: int | None = None, ordered: bool = True,
               prompt: Column | None = None) -> DataFrame:
    """News with ``sentiment``: ok, error, value(sentiment_score, sentiment_reason).

    ``prompt`` replaces the question on title and summary. A reply without a readable object, or with a score
    outside 1..10, is an error of its row.
    """
    question = S.scoring_prompt(S.title_and_summary(F.col("title"), F.col("summary"))) if prompt is None else prompt
    asked = news.withColumn("_ask", question)
    replied = enrich(asked, "_ask", "_reply", client, REPLY_TYPE, capacity=capacity, timeout_s=timeout_s, tasks=tasks, ordered=ordered)
    return parse_replies(replied).drop("_ask")


def parse_replies(replied: DataFrame, reply: str = "_reply") -> DataFrame:
    """Replaces the raw ``reply`` struct by ``sentiment``, carrying the first error found."""
    r = F.col(reply)
    score = S.valid_score(F.col("_parsed.sentiment_score"))
    error = (
        F.when(~r["ok"], r["error"])
        .when(F.col("_parsed").isNull(), F.lit("no readable object"))
        .when(score.isNull(), F.lit("score missing or outside 1..10"))
    )
    value = F.struct(
        score.alias("sentiment_score"), F.col("_parsed.sentiment_reason").alias("sentiment_reason")
    )
    return (
        replied.withColumn("_parsed", S.model_reply(r["value"], schemas.MODEL_REPLY))
        .withColumn("_error", error)
        .withColumn(
            "sentiment",
            F.struct(F.col("_error").isNull().alias("ok"), F.col("_error").alias("error"), value.alias("value")),
        )
        .drop(reply, "_parsed", "_error")
    )


def flatten_score(scored: DataFrame, now=None) -> DataFrame:
    """``sentiment`` unwrapped into the ScoredNews columns."""
    return (
        scored.withColumn("sentiment_score", F.col("sentiment.sentiment_score"))
        .withColumn("sentiment_reason", F.col("sentiment.sentiment_reason"))
        .withColumn("raw_content", F.col("summary"))
        .withColumn("sentiment_es", S.now_ms() if now is None else now)
        .drop("sentiment")
    )


def embed(rows: DataFrame, text: str, client: ClientFactory, out: str = "vector", *, capacity: int = 50,
          timeout_s: float = 10.0, tasks: int | None = None, ordered: bool = True) -> DataFrame:
    return enrich(rows, text, out, client, VECTOR_TYPE, capacity=capacity, timeout_s=timeout_s, tasks=tasks, ordered=ordered)
