"""The memory of seen ids: exact within its days, bounded, and safe to run again."""

import json
import os

import pytest
from pyspark.sql import functions as F

from newsflow import schemas
from newsflow.config import JobConfig
from newsflow.sinks import seen, tables
from newsflow.streaming import jobs

DAY = 86_400_000
D0 = 20_000  # days since 1970


def items(spark, *rows):
    """(id, day) items, published when collected."""
    at = [(i, "t", "s", d * DAY, "src", d * DAY + n) for n, (i, d) in enumerate(rows)]
    return spark.createDataFrame(at, schemas.NEWS_ITEM)


def sent(spark, cfg):
    return sorted((r["batch_id"], json.loads(r["value"]).get("id", "")) for r in spark.read.parquet(f"{cfg.signal_path}/delta").collect())


@pytest.fixture
def job(tmp_path):
    cfg, root = JobConfig(signal_path=str(tmp_path / "signals")), str(tmp_path / "seen")
    return cfg, root, jobs.intake_batch(cfg, root, ["es"])


def test_ids_are_forgotten_after_their_last_sighting(spark, job):
    cfg, root, work = job
    for batch, rows in enumerate([[("a", D0), ("b", D0)], [("a", D0 + 6)], [("a", D0 + 12), ("b", D0 + 12)]]):
        work(items(spark, *rows), batch)
    # a was sighted every six days and is never sent twice; b stayed away for more than seven
    assert sent(spark, cfg) == [(0, "a"), (0, "b"), (2, "b")]


def test_an_id_costs_one_row_a_day(spark, job):
    cfg, root, work = job
    for batch in range(3):
        work(items(spark, *[("hot", D0)] * 500, ("x%d" % batch, D0), (None, D0)), batch)
    rows = [tuple(r) for r in tables.read_appended(spark, root, seen.SEEN).collect()]
    assert sorted(rows) == [("hot", D0), ("x0", D0), ("x1", D0), ("x2", D0)]
    assert [i for _, i in sent(spark, cfg) if i] == ["hot", "x0", "x1", "x2"]


def test_replays_and_empty_batches(spark, job):
    cfg, root, work = job
    work(items(spark), 0)
    work(items(spark, ("a", D0)), 1)
    work(items(spark, ("a", D0), ("b", D0 + 1)), 2)
    want = sent(spark, cfg)
    assert want == [(1, "a"), (2, "b")]
    work(items(spark, ("a", D0)), 1)
    work(items(spark, ("a", D0), ("b", D0 + 1)), 2)
    assert sent(spark, cfg) == want
    # folding leaves the newest batch apart, so that it can run again
    assert seen.forget(spark, root, D0 + 1) == 0
    work(items(spark, ("a", D0), ("b", D0 + 1)), 2)
    work(items(spark, ("a", D0 + 1), ("b", D0 + 1), ("c", D0 + 1)), 3)
    assert sent(spark, cfg) == [*want, (3, "c")]


def test_folding_drops_old_days_from_disk(spark, job):
    cfg, root, work = job
    assert seen.forget(spark, root, D0) is None
    for batch, day in enumerate([0, 3, 3, 9, 10]):
        work(items(spark, ("a", D0 + day), (f"n{batch}", D0 + day)), batch)
    seen.forget(spark, root, D0 + 9)
    seen.forget(spark, root, D0 + 9)
    kept = {(r["id"], r["day"] - D0) for r in tables.read_appended(spark, root, seen.SEEN).collect()}
    assert kept == {("n1", 3), ("n2", 3), ("a", 9), ("n3", 9), ("a", 10), ("n4", 10)}
    assert [x for x in os.listdir(f"{root}/base") if x.startswith("v=")] == ["v=1"]
    assert [x for x in os.listdir(f"{root}/delta") if x.startswith("batch_id=")] == ["batch_id=4"]


def test_a_batch_opens_only_its_days(spark, job):
    cfg, root, work = job
    for batch in range(4):
        work(items(spark, (f"n{batch}", D0 + 10 * batch)), batch)
    asked = items(spark, ("n2", D0 + 25)).select("id", F.lit(D0 + 25).cast("bigint").alias("_day"))
    found = seen.with_last_day(asked, tables.read_appended(spark, root, seen.SEEN))
    assert [r["_seen"] for r in found.collect()] == [D0 + 20]
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = [x for x in plan.splitlines() if "PartitionFilters" in x and "day" in x]
    assert scan and any(f">= {D0 + 18}" in x.split("PartitionFilters")[1] for x in scan)


def test_the_filter_keeps_all_matches_and_little_else(spark):
    rows = spark.range(200_000).select(F.md5(F.col("id").cast("string")).alias("id"), F.lit(1).cast("bigint").alias("day"))
    ids = spark.range(0, 2_000_000, 100).select(F.md5(F.col("id").cast("string")).alias("id"))
    kept = seen.may_match(rows, ids)
    assert kept.join(ids, "id", "left_semi").count() == 2_000
    assert kept.count() < 4_000
