import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsflow.operators import decide, knn

SCHEMA = "id bigint, part bigint, x double, ts bigint, vec array<float>, ret double"


def vectors(n, dim, seed, parts=3, copies=0):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, dim)).astype(np.float32)
    if copies:
        m[:copies] = m[0]  # a hot group of exact copies
    part = np.where(rng.random(n) < 0.5, 0, rng.integers(0, parts, n))  # one hot value
    return [
        (i, int(part[i]), float(rng.integers(0, 50)), int(rng.integers(0, 1000)), m[i].tolist(), float(rng.normal()))
        for i in range(n)
    ]


def brute(queries, memory, k, part=True, x=True):
    out = {}
    mv = np.array([m[4] for m in memory], dtype=np.float64)
    mv /= np.linalg.norm(mv, axis=1, keepdims=True)
    for q in queries:
        v = np.array(q[4], dtype=np.float64)
        sims = mv @ (v / np.linalg.norm(v))
        hits = [
            (-round(s, 10), m[0]) for s, m in zip(sims, memory)
            if (not part or m[1] == q[1]) and (not x or m[2] >= q[2]) and m[0] != q[0]
        ]
        out[q[0]] = [i for _, i in sorted(hits)[:k]]
    return {q: ids for q, ids in out.items() if ids}


def found(df):
    got = {}
    for r in df.orderBy("q_id", "rank").collect():
        got.setdefault(r["q_id"], []).append(r["m_id"])
        assert r["rank"] == len(got[r["q_id"]])
    return got


NAMES = dict(q_id="id", m_id="id", q_vec="vec", m_vec="vec")


@pytest.mark.parametrize("options", [dict(), dict(block_rows=16)])
def test_exact_search_equals_brute_force(spark, options):
    rows = vectors(300, 8, 1, copies=90)
    df = spark.createDataFrame(rows, SCHEMA)
    got = knn.knn_join(
        df, df, 5, **NAMES, part=("part", "part"), bounds=[("x", ">=", "x"), ("id", "!=", "id")], carry=["ret"], **options
    )
    assert found(got) == brute(rows, rows, 5)
    assert {r["m_id"]: r["ret"] for r in got.collect()}.items() <= {r[0]: r[5] for r in rows}.items()


def test_search_without_partition(spark):
    rows = vectors(120, 4, 2)
    df = spark.createDataFrame(rows, SCHEMA)
    got = knn.knn_join(df, df, 3, **NAMES, bounds=[("id", "!=", "id")], block_rows=50)
    assert found(got) == brute(rows, rows, 3, part=False, x=False)


def test_null_and_zero_vectors(spark):
    rows = [(1, 0, 0.0, 0, [1.0, 0.0], 0.0), (2, 0, 0.0, 0, [0.0, 0.0], 0.0), (3, 0, 0.0, 0, None, 0.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = knn.knn_join(df.where("id = 1"), df, 5, **NAMES).orderBy("rank").collect()
    assert [(r["m_id"], r["sim"]) for r in got] == [(1, 1.0), (2, 0.0)]


def test_no_queries_or_no_memory(spark):
    df = spark.createDataFrame(vectors(5, 4, 3), SCHEMA)
    none = df.where("id < 0")
    assert knn.knn_join(none, df, 5, **NAMES).count() == 0
    assert knn.knn_join(df, none, 5, **NAMES).count() == 0


def test_copies_of_a_query_get_the_neighbours_of_one(spark):
    rows = vectors(60, 4, 9)
    df = spark.createDataFrame(rows, SCHEMA)
    twice = df.where("id < 5").unionByName(df.where("id < 3"))
    got = knn.knn_join(twice, df, 4, **NAMES, bounds=[("id", "!=", "id")], carry=["ret"])
    assert found(got) == {q: ids for q, ids in brute(rows, rows, 4, part=False, x=False).items() if q < 5}
    stats = decide.backtest_stats(got, twice.select("id"), "id", -1.0, "ret").collect()
    assert sorted((r["id"], r["valid_matches"]) for r in stats) == [(0, 4), (0, 4), (1, 4), (1, 4), (2, 4), (2, 4), (3, 4), (4, 4)]


def test_building_a_search_runs_no_job_and_takes_many_cells(spark):
    df = spark.createDataFrame(vectors(40, 4, 10), SCHEMA).withColumn("part", F.col("id") * 1000)
    spark.sparkContext.setJobGroup("building", "none may run")
    built = knn.knn_join(df, df, 2, **NAMES, part=("part", "part"))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    assert built.count() == 40


def test_ivf_is_exact_when_all_cells_are_searched(spark):
    rows = vectors(400, 8, 4)
    df = spark.createDataFrame(rows, SCHEMA)
    got = knn.knn_ivf(df, df, 5, **NAMES, nlist=16, nprobe=16, bounds=[("id", "!=", "id")])
    assert found(got) == brute(rows, rows, 5, part=False, x=False)


def test_ivf_recall(spark):
    rows = vectors(400, 8, 5)
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(knn.knn_ivf(df, df, 5, **NAMES, nlist=16, nprobe=10, bounds=[("id", "!=", "id")]))
    want = brute(rows, rows, 5, part=False, x=False)
    hit = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hit / sum(map(len, want.values())) >= 0.9


# ---- statistics and decision ------------------------------------------------------------------

def test_statistics_over_neighbours(spark):
    hits = spark.createDataFrame(
        [("a", 0.95, 1.0), ("a", 0.91, -1.0), ("a", 0.92, 2.0), ("a", 0.9, 5.0), ("b", 0.2, 1.0)],
        "q_id string, sim double, `return` double",
    )
    queries = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    got = {r["id"]: tuple(r)[1:] for r in decide.backtest_stats(hits, queries, "id").collect()}
    assert got == {"a": (3, 0.95, 2, pytest.approx(2 / 3)), "b": (0, 0.0, 0, 0.0), "c": (0, 0.0, 0, 0.0)}


STATS = "id string, sentiment_score bigint, pubDate bigint, sentiment_es bigint, price_at_t double, max_similarity double, win_rate double"


def test_signal_gates(spark):
    rows = [("a", 9, 1, 2, 10.0, 0.95, 0.7), ("b", 1, 1, 2, 10.0, 0.95, 0.65), ("c", 5, 1, 2, 10.0, 0.0, 0.0),
            ("d", 9, None, 2, 10.0, 0.99, 0.99)]
    df = spark.createDataFrame(rows, STATS)
    strict = decide.trade_signals(df, now=F.lit(7).cast("bigint")).collect()
    assert [(r["event_id"], r["action"], r["buy_price"], r["buy_time"], r["sell_time"]) for r in strict] == [("a", "BUY", 10.0, 7, None)]
    loose = decide.trade_signals(df, "score_only").collect()
    assert {r["event_id"]: r["action"] for r in loose} == {"a": "BUY", "b": "SELL", "c": "HOLD"}
    with pytest.raises(ValueError):
        decide.trade_signals(df, "other")


def test_history_is_limited_to_the_past(spark):
    cols = "event_id string, sentiment_score bigint, rsi_14 double, sentiment_es bigint, vector array<float>, is_settled boolean, `return` double"
    memory = spark.createDataFrame(
        [("old", 9, 46.0, 1, [1.0, 0.0], True, 1.0), ("new", 9, 50.0, 99, [1.0, 0.0], True, 1.0),
         ("open", 9, 50.0, 1, [1.0, 0.0], False, 1.0), ("low", 9, 44.9, 1, [1.0, 0.0], True, 1.0),
         ("other", 8, 50.0, 1, [1.0, 0.0], True, 1.0), ("edge", 9, 45.0, 2, [0.0, 1.0], True, 1.0)], cols)
    query = spark.createDataFrame([("q", 9, 50.0, 50, [1.0, 0.0])], "id string, sentiment_score bigint, rsi_14 double, sentiment_es bigint, vector array<float>")
    assert found(decide.similar_history(query, memory)) == {"q": ["old", "edge"]}
    assert found(decide.similar_history(query, memory, point_in_time=False)) == {"q": ["new", "old", "edge"]}


def test_products_of_a_large_block_are_not_held_at_once():
    rng = np.random.default_rng(8)
    m, q = rng.normal(size=(20_000, 8)), rng.normal(size=(1100, 8))
    memory = pd.DataFrame({"m_id": range(20_000), "m_vec": m.tolist(), "m_part": 0, "mb_0": range(20_000)})
    queries = pd.DataFrame({"q_id": range(1100), "q_key": 0, "q_vec": q.tolist(), "q_part": 0, "qb_0": range(1100)})
    asked = knn._by_part(queries)
    tracemalloc.start()
    best = knn._best(asked, memory, 3, [("id", "!=", "id")])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    unit = lambda x: x / np.linalg.norm(x, axis=1)[:, None]
    sim = np.round(unit(q) @ unit(m).T, 10)
    sim[np.arange(1100), np.arange(1100)] = -2
    want = np.argsort(-sim, axis=1, kind="stable")[:, :3]
    assert best.sort_values(["q_id", "sim"], ascending=[True, False]).m_id.to_numpy().reshape(-1, 3).tolist() == want.tolist()


def test_ties_keep_id_order_with_few_and_many_copies():
    for copies in (3, 500):
        memory = pd.DataFrame({"m_id": range(copies, 0, -1), "m_vec": [[1.0, 0.0]] * copies, "m_part": [0] * copies})
        queries = pd.DataFrame({"q_id": [9, 8], "q_vec": [[1.0, 0.0], [0.5, 0.5]], "q_part": [0, 0]})
        best = knn._best(knn._by_part(queries), memory, 2, ())
        assert best.groupby("q_id").m_id.apply(list).to_dict() == {8: [1, 2], 9: [1, 2]}


def test_best_rows_so_far_change_nothing(monkeypatch):
    """Tiles, parts, ties and bounds against all pairs at once; later tiles are only searched for what is not worse."""
    rng, k = np.random.default_rng(4), 3
    vectors = np.round(rng.normal(size=(90, 4)))
    asked = pd.DataFrame({"q_id": range(60), "q_key": range(60), "q_vec": list(vectors[:60]), "q_part": [np.arange(3)] * 60, "qb_0": range(60), "qb_1": rng.integers(0, 9, 60)})
    memory = pd.DataFrame({"m_id": range(90), "m_vec": list(vectors), "m_part": rng.integers(0, 3, 90), "mb_0": range(90), "mb_1": rng.integers(0, 9, 90)})
    bounds, columns = (("event_id", "!=", "event_id"), ("day", "<=", "day")), ["q_id", "m_id", "sim"]
    monkeypatch.setattr(knn, "_MATRIX_ROWS", 16)
    monkeypatch.setattr(knn, "_MATRIX_COLUMNS", 7)
    whole, called = knn._top_cells, []
    monkeypatch.setattr(knn, "_top_cells", lambda *args: called.append(1) or whole(*args))
    got = knn._score_blocks(asked, memory, k=k, bounds=bounds, columns=columns)
    units = knn._unit_rows(memory["m_vec"])
    sim = units[:60] @ units.T
    want = []
    for i in range(60):
        able = [j for j in range(90) if j != i and memory.mb_1[j] <= asked.qb_1[i]]
        want += [(i, j) for j in sorted(able, key=lambda j: (-round(sim[i, j], 10), j))[:k]]
    assert sorted(zip(got.q_id, got.m_id, strict=True)) == sorted(want)
    tiles = sum(4 * -(-int(n) // 7) for n in memory.m_part.value_counts())
    assert len(called) < tiles
