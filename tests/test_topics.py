"""Sequence numbers of messages, over several files and a hot key."""

import json

from pyspark.sql import functions as F

from newsflow.sinks import topics


def test_numbers_are_gapless_within_each_key(spark, tmp_path):
    rows = [("hot" if i % 3 else f"k{i % 7}" if i % 5 else None, (i * 37) % 1009, i) for i in range(1009)]
    df = spark.createDataFrame(rows, "key string, at bigint, other bigint").repartition(6)
    df.write.parquet(str(tmp_path / "in"))
    found = topics.numbered(spark.read.parquet(str(tmp_path / "in")), "key", ["at"], 8).withColumn("p", F.spark_partition_id())
    got = {}
    for r in found.collect():
        got.setdefault(r.key, []).append((r.sequence, r["at"], r.other))
    assert sum(map(len, got.values())) == 1009
    for key, held in got.items():
        held.sort()
        assert [x[0] for x in held] == list(range(len(held)))
        assert [x[1:] for x in held] == sorted((at, i) for k, at, i in rows if k == key)
    parts = topics.keyed_order(df, "key", ["at"], 8).where("key = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1  # the hot key lies in several tasks
    message = json.loads(topics.to_json_value(found.drop("p"), "key").where("key = 'hot'").first().value)
    assert {"key", "at", "other", "sequence"} == set(message)


def test_no_rows_give_no_numbers(spark):
    none = spark.createDataFrame([], "key string, at bigint")
    assert topics.numbered(none, "key", ["at"], 4).collect() == []
