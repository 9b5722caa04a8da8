"""Landed REST pages as a stream of new posts; its offset is the last id.

A page is the JSON reply of one request, its posts under ``results``, landed as a file named after its largest
id (``land_page``). Names alone tell where the stream is: a batch opens the pages above its start, and of each page
come the posts above that start. The driver lists names and opens nothing; pages are read in tasks, several
to a partition, and parsed by Spark. A restart goes on behind the offset in the checkpoint and reads no old page, and
a batch that runs again gives the same posts. A page that comes late, when a newer one was handed out, adds nothing.
Pages of one batch may show the same post: ``once`` keeps it as the newest of them has it.

Defined results: pages that cannot be parsed, pages without posts and posts without an id give nothing; other
files in the folder are passed over; a post above the id its page is named after stops the stream, since a later
page would repeat it. The newest page has to stay in the folder; older ones may be removed.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from newsflow import schemas
from newsflow.operators import keyed
from newsflow.sources import feeds

_NAME = re.compile(r"(\d{20})\.json")


def page_name(last_id: int) -> str:
    return f"{last_id:020d}.json"


def land_page(folder: str, body: str) -> int | None:
    """Land one reply under its largest id, which is returned; a reply without posts is not landed.

    The file appears whole, and a reply that is fetched again replaces itself.
    """
    ids = [p["id"] for p in json.loads(body)["results"] if p.get("id") is not None]
    if not ids:
        return None
    system, inner = fs.FileSystem.from_uri(folder)
    system.create_dir(inner, recursive=True)
    target = f"{inner}/{page_name(max(ids))}"
    with system.open_output_stream(f"{target}.part") as out:
        out.write(body.encode("utf-8"))
    system.move(f"{target}.part", target)
    return max(ids)


class PagesReader(DataSourceStreamReader):
    def __init__(self, folder: str, start_after: int, pages_per_task: int) -> None:
        self.folder, self.start_after, self.pages_per_task = folder, start_after, pages_per_task

    def _landed(self) -> list[int]:
        system, inner = fs.FileSystem.from_uri(self.folder)
        found = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
        names = (_NAME.fullmatch(f.base_name) for f in found if f.type == fs.FileType.File)
        return sorted(int(m[1]) for m in names if m)

    def initialOffset(self) -> dict:
        return {"last_id": self.start_after}

    def latestOffset(self) -> dict:
        return {"last_id": max([self.start_after, *self._landed()])}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        ids = [i for i in self._landed() if start["last_id"] < i <= end["last_id"]]
        return [InputPartition((start["last_id"], ids[i:i + self.pages_per_task])) for i in range(0, len(ids), self.pages_per_task)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        system, inner = fs.FileSystem.from_uri(self.folder)
        above, ids = partition.value
        for last_id in ids:
            with system.open_input_stream(f"{inner}/{page_name(last_id)}") as page:
                yield last_id, above, page.read().decode("utf-8", "replace")


class LandedPages(DataSource):
    """``landed_pages``: options ``path``, ``startAfter`` (an id, default -1) and ``pagesPerTask`` (default 64)."""

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return "last_id bigint, above bigint, body string"

    def streamReader(self, schema: StructType) -> PagesReader:
        opened = self.options
        return PagesReader(opened["path"].rstrip("/"), int(opened.get("startAfter", -1)), int(opened.get("pagesPerTask", 64)))


def read_pages(spark: SparkSession, folder: str, start_after: int = -1, pages_per_task: int = 64) -> DataFrame:
    """Stream of landed pages ``(last_id, above, body)``."""
    spark.dataSource.register(LandedPages)
    reader = spark.readStream.format("landed_pages").option("startAfter", start_after).option("pagesPerTask", pages_per_task)
    return reader.load(folder)


def new_posts(pages: DataFrame, source_type: str) -> DataFrame:
    """The posts of each page above the start of its batch: ``schemas.NEWS_REST`` and the page's ``last_id``."""
    posts = feeds.rest_posts(pages, source_type, keep=["above", "last_id"])
    beyond = F.raise_error(F.concat(F.lit("post above its page: "), F.col("id").cast("string"))).cast("boolean")
    mine = F.when(F.col("id").isNull(), False).when(F.col("id") <= F.col("last_id"), F.col("id") > F.col("above")).otherwise(beyond)
    return posts.where(mine).drop("above")


def once(batch: DataFrame) -> DataFrame:
    """The posts of one batch, each as its newest page has it (``schemas.NEWS_REST``)."""
    order = ["last_id", "published_at", "title", "url", "domain"]
    return keyed.latest_per_key(batch, ["id"], order).select(schemas.NEWS_REST.fieldNames())
