"""The ceiling of outside calls over all tasks."""

import os
import time
import uuid
from collections.abc import Iterator

import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsflow.operators import enrich
from newsflow.session import configure


@pytest.mark.parametrize("ordered", [True, False])
def test_no_more_calls_than_the_capacity_over_all_tasks(spark, tmp_path, ordered):
    folder = str(tmp_path)

    def make():
        def call(text):
            mine = f"{folder}/{uuid.uuid4().hex}"
            open(mine, "w").close()
            seen = len(os.listdir(folder))
            time.sleep(0.02)
            os.remove(mine)
            return str(seen)

        return call

    rows = spark.range(60).select("id", F.col("id").cast("string").alias("text")).repartition(4)
    out = enrich.enrich(rows, "text", "r", make, enrich.REPLY_TYPE, capacity=2, tasks=4, ordered=ordered).collect()
    assert len(out) == 60 and all(r.r.ok for r in out)
    assert max(int(r.r.value) for r in out) <= 2


def test_python_sees_pages_and_texts_in_small_batches(spark):
    """Long rows reach a task's Python by a few MB, many short ones by a thousand."""
    for key in ("maxRecordsPerBatch", "maxBytesPerBatch"):
        spark.conf.unset(f"spark.sql.execution.arrow.{key}")
    configure(spark)

    @F.pandas_udf("long")
    def seen(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([len(batch)] * len(batch))

    most = lambda n, length: spark.range(0, n, 1, 1).select(seen(F.repeat(F.col("id").cast("string"), length)).alias("n")).agg(F.max("n")).first()[0]
    assert most(3000, 1) <= 1000
    assert most(400, 100_000) <= 90
