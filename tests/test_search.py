"""Stored vector cells, and sparse search by slot lists."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from newsflow.operators import cells, decide, enrich, knn, sparse

NAMES = dict(q_id="id", m_id="id", q_vec="vec", m_vec="vec")


@pytest.fixture(autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def vectors(spark, n, dim, seed):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, dim)).astype(np.float32)
    return spark.createDataFrame([(i, m[i].tolist(), bool(i % 5)) for i in range(n)], "id bigint, vec array<float>, settled boolean")


def partition_filters(df):
    text = df._jdf.queryExecution().toString()  # all of it, unlike the plan's own short form
    return "\n".join(line for line in text.splitlines() if "PartitionFilters" in line)


def test_every_query_row_keeps_its_own_neighbours(spark):
    schema = "id bigint, vec array<float>, ret double"
    asked = spark.createDataFrame([(1, [1.0, 0.0], 0.0), (1, [0.0, 1.0], 0.0)], schema)
    memory = spark.createDataFrame([(10, [1.0, 0.1], 1.0), (20, [0.1, 1.0], -1.0)], schema)
    hits = knn.knn_join(asked, memory, 1, **NAMES, carry=["ret"])
    assert sorted((r.q_id, r.m_id, r["rank"]) for r in hits.collect()) == [(1, 10, 1), (1, 20, 1)]
    rated = decide.backtest_stats(hits, asked.withColumn("q_key", knn.query_key("vec")), "id", 0.9, "ret")
    assert {tuple(r.vec): r.win_rate for r in rated.collect()} == {(1.0, 0.0): 1.0, (0.0, 1.0): 0.0}
    # one id in two partitions has k neighbours in each
    both = spark.createDataFrame([(1, [1.0, 0.0], 0.0), (1, [1.0, 0.0], 1.0)], schema)
    parts = knn.knn_join(both, memory.unionByName(memory.withColumn("id", F.col("id") + 1).withColumn("ret", -F.col("ret"))), 1, **NAMES, part=("ret", "ret"))
    assert [(r.q_id, r.m_id) for r in parts.collect()] == [(1, 10)] or parts.count() == 1


def test_decisions_of_one_id_with_two_vectors(spark):
    cols = "id bigint, sentiment_score int, vector array<float>, is_settled boolean, return_24h float"
    memory = spark.createDataFrame([(i, 9, [1.0, 0.0], True, 1.0) for i in range(10)] + [(i, 9, [0.0, 1.0], True, -1.0) for i in range(10, 20)], cols)
    asked = spark.createDataFrame([(100, 9, [1.0, 0.0], False, 0.0), (100, 9, [0.0, 1.0], False, 0.0)], cols)
    assert sorted((tuple(r.vector), r.decision) for r in decide.analysis_decisions(asked, memory).collect()) == [((0.0, 1.0), "HOLD"), ((1.0, 0.0), "EXECUTE_BUY")]


def test_stored_cells_are_searched_without_reading_the_others(spark, tmp_path):
    rows, root = vectors(spark, 600, 8, 3), str(tmp_path / "cells")
    cells.create(rows, root, "id", "vec", nlist=16)
    for batch in (0, 1):
        cells.append(rows.where(F.col("id") % 2 == batch), root, batch, "id", "vec")
    cells.append(rows.where("id % 2 = 1"), root, 1, "id", "vec")  # replay
    with pytest.raises(ValueError):
        cells.search(rows, root, rows.schema, 5, **NAMES)
    nprobe, measured = cells.calibrate(spark, root, rows.schema, 5, "id", "vec", bounds=[("id", "!=", "id")])
    assert 1 <= nprobe < 16 and measured >= cells.TARGET
    assert cells.stored(spark, root, rows.schema).count() == 600
    exact = knn.knn_join(rows, rows, 5, **NAMES, bounds=[("id", "!=", "id")])
    found = cells.search(rows, root, rows.schema, 5, **NAMES, bounds=[("id", "!=", "id")])
    assert cells.recall(found.toPandas(), exact.toPandas()) >= 0.9
    every = cells.search(rows, root, rows.schema, 5, **NAMES, nprobe=16, bounds=[("id", "!=", "id")])
    key = lambda df: sorted((r.q_id, r.m_id, r["rank"]) for r in df.collect())
    assert key(every) == key(exact)
    assert "dynamicpruning" in partition_filters(cells.search(rows.where("id = 7"), root, rows.schema, 5, **NAMES, nprobe=1))


def test_a_query_goes_once_to_a_block_of_many_cells(spark, monkeypatch):
    rows, sent = vectors(spark, 400, 8, 4), []
    monkeypatch.setattr(knn, "top_k", lambda hits, k, rank=knn.top_k: (sent.append(hits), rank(hits, k))[1])
    found = knn.knn_ivf(rows, rows, 5, **NAMES, nlist=16, nprobe=16, bounds=[("id", "!=", "id")])
    assert sent[0].count() == 400 * 5  # one block, not sixteen cells
    exact = knn.knn_join(rows, rows, 5, **NAMES, bounds=[("id", "!=", "id")])
    key = lambda df: sorted((r.q_id, r.m_id, r["rank"]) for r in df.collect())
    assert key(found) == key(exact)


def test_copies_of_a_row_grow_with_the_rows_and_blocks_stay_bounded(spark):
    blocks = lambda n, dim, most=knn.BLOCK_ROWS: spark.range(n).select(F.array_repeat(F.lit(1.0), dim).alias("v")).agg(knn._blocks("v", most)).first()[0]
    assert [blocks(n, 2) for n in (0, 1, 1024, 2048, 100_000, 400_000)] == [1, 1, 1, 2, 16, 16]
    assert blocks(40_000, 2048) == 20 and blocks(400, 2, 50) == 8


def test_null_vectors_are_stored_and_never_found(spark, tmp_path):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None)], "id bigint, vec array<float>")
    root = str(tmp_path / "cells")
    cells.create(rows, root, "id", "vec", nlist=2)
    cells.append(rows, root, 0, "id", "vec")
    assert cells.stored(spark, root, rows.schema).where("cell = -1").count() == 1
    assert cells.search(rows, root, rows.schema, 5, **NAMES, nprobe=2).count() == 4


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall_of_the_query_at_its_own_settings(spark, sf):
    exact = entry.queries()["knn_ivf_all_cells"](spark, sf).toPandas()
    query = entry.queries()["knn_ivf_approx"]
    assert cells.recall(query(spark, sf).toPandas(), exact) >= 0.9
    assert "dynamicpruning" in partition_filters(query(spark, sf))


# ---- sparse -----------------------------------------------------------------------------------

def brute(queries, memory, k, dim):
    embed = enrich.hashed_words_embedder(dim)()
    unit = lambda t: (lambda v: v / np.linalg.norm(v))(np.array(embed(t), np.float32).astype(float))
    q, m = ({i: unit(t) for i, t in side if t and t.strip()} for side in (queries, memory))
    out = {}
    for i, v in q.items():
        sims = sorted((-round(float(v @ w), 10), j) for j, w in m.items() if v @ w > 0)
        out[i] = [j for _, j in sims[:k]]
    return {i: js for i, js in out.items() if js}


@pytest.mark.parametrize("dim, block, k", [(64, 40, 3), (16, 8192, 2), (4096, 7, 5)])
def test_sparse_search_equals_brute_force(spark, dim, block, k):
    rng = random.Random(dim)
    words = [f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(rng.randint(1, n)))
    memory = [(i, text(60)) for i in range(150)] + [(200, None), (201, " \t"), (202, "the " * 3000)]
    memory += [(300 + i, memory[0][1]) for i in range(5)]
    queries = [(i, text(12)) for i in range(30)] + [(99, ""), (98, memory[3][1]), (97, "unseen-word-xyz")]
    q, m = (sparse.hashed_words(spark.createDataFrame(x, "id bigint, text string"), "id", "text", dim) for x in (queries, memory))
    found = {}
    for r in sparse.top_k(q, m, k, block).orderBy("q_id", "rank").collect():
        found.setdefault(r.q_id, []).append(r.m_id)
    assert found == brute(queries, memory, k, dim)


def test_a_text_is_one_row_and_repeated_ids_are_one_text(spark):
    rows = spark.createDataFrame([(1, "a b a"), (1, "b b"), (2, None), (3, " "), (4, "c " * 2000)], "id bigint, text string")
    bags = sparse.hashed_words(rows, "id", "text", 4096)
    found = {r.id: (r.slots, r.units) for r in bags.collect()}
    assert bags.count() == 2 and sorted(found) == [1, 4]  # words never become rows, which a task would have to sort
    assert sorted(round(u, 6) for u in found[1][1]) == [0.5547, 0.83205] and found[1][0] == sorted(found[1][0])
    assert len(found[4][0]) == 1 and found[4][1] == [1.0]


def test_bounds_leave_lists_unread():
    """A query equal to a stored text stops before the long lists, with the same answer as reading them all."""
    rng = np.random.default_rng(5)
    rows, common = [], [5000, 5001, 5002]
    for i in range(400):
        slots = [*rng.choice(5000, 30, replace=False).tolist(), *common]
        weights = np.array([*(1 + rng.random(30)), 0.3, 0.3, 0.3])
        rows += [(i, s, u) for s, u in zip(slots, weights / np.linalg.norm(weights), strict=True)]
    rows = pd.DataFrame(rows, columns=["id", "slot", "unit"])
    lists = sparse.SlotLists(rows)
    dense = np.zeros((400, 5003))
    dense[rows.id, rows.slot] = rows.unit
    spared, entries = 0, rows.slot.value_counts()
    for i in range(400):
        mine = rows[rows.id == i]
        found, sims, read = lists.search(mine.slot.to_numpy(), mine.unit.to_numpy(), 2)
        exact = dense @ dense[i]
        want = np.lexsort((np.arange(400), -np.round(exact, 10)))[:2]
        assert found.tolist() == want.tolist() and np.allclose(sims, exact[want])
        spared += read < entries[mine.slot].sum()
    assert spared > 0
    mine = rows[rows.id == 3]
    assert lists.search(mine.slot.to_numpy(), mine.unit.to_numpy(), 1)[2] < entries[mine.slot].sum()
