"""The plans of the scalable operators: no products, no whole-table window, pushed-down scans."""

import inspect
import re

import pytest

import __spark_entry__ as entry

SPREADING = [
    "asof_price_features", "rsi_14", "knn_hybrid_top5", "news_dedup_seen", "settle_by_event_id", "employee_upsert",
    "settle_24h_price_later", "settle_24h_price_cross", "mempool_tx_lookup", "kline_replace_into", "latest_per_key", "last_n_bars",
    "backtest_stats", "semantic_search_top2", "memory_after_settlement", "memory_purge_trained",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", SPREADING)
def test_no_product_and_no_single_task_window(spark, sf, key):
    text = plan(entry.queries()[key](spark, sf))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Exchange SinglePartition" not in "\n".join(
        line for line in text.splitlines() if "Subquery" not in line
    ) or key == "semantic_search_top2"  # its numbers of blocks are global counts, read as subqueries


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(entry.queries()["training_window_filter"](spark, sf))
    assert re.search(r"ReadSchema: struct<vec_id:bigint>", text)
    text = plan(entry.queries()["news_count_by_source"](spark, sf))
    assert "ReadSchema: struct<source:string>" in text
    text = plan(entry.queries()["employee_projection"](spark, sf))
    assert "o_orderstatus" not in text


def test_last_n_is_cut_before_the_shuffle(spark, sf):
    text = plan(entry.queries()["last_n_bars"](spark, sf))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_asof_shares_one_exchange(spark, sf):
    df = entry.queries()["asof_price_features"](spark, sf)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_bars_are_hash_aggregated(spark, sf):
    text = plan(entry.queries()["ohlcv_bars"](spark, sf))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_predictions_come_from_all_trees(spark, monkeypatch):
    from newsflow.operators import retrain
    from newsflow.plans import catalog

    asked = []
    signature, fit = inspect.signature(retrain.fit), retrain.fit

    def quick(*args, **options):
        asked.append(signature.bind(*args, **options))
        asked[-1].apply_defaults()
        return fit(args[0], trees=1)

    monkeypatch.setattr(retrain, "fit", quick)
    assert catalog.QUERIES["predict_return"](spark, "/root/testdata/sf0.001").count() > 0
    assert [a.arguments["trees"] for a in asked] == [200]
