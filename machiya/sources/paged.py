"""A paged search as a Spark data source: one partition per target, pages followed to their end.

The transport is a folder of saved pages (``<target>/<page>.html``), so that the source runs without a network; another
transport is a subclass with its own ``fetch``.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "target string, page int, position int, href string, card string, error string"


class TargetPartition(InputPartition):
    def __init__(self, target: str):
        super().__init__(target)
        self.target = target


class PagedReader(DataSourceReader):
    def __init__(self, folder: str, most_pages: int):
        self.folder, self.most_pages = folder, most_pages

    def partitions(self) -> list[InputPartition]:
        return [TargetPartition(p.name) for p in sorted(Path(self.folder).iterdir()) if p.is_dir()]

    def fetch(self, target: str, page: str) -> str:
        return (Path(self.folder) / target / page).read_text(encoding="utf-8")

    def read(self, partition: TargetPartition) -> Iterator[tuple]:
        from machiya.operators.pages import read_page

        page, seen = "1.html", set()
        for number in range(1, self.most_pages + 1):
            if page in seen:
                yield (partition.target, number, None, None, None, "loop")
                return
            seen.add(page)
            try:
                found = read_page(self.fetch(partition.target, page))
            except OSError as e:
                yield (partition.target, number, None, None, None, type(e).__name__)
                return
            links = [(label, value) for kind, _, label, value in found if kind == "link"]
            for i, (label, href) in enumerate(x for x in links if x[0] != "next"):
                yield (partition.target, number, i, href, label, None)
            following = [href for label, href in links if label == "next" or "次へ" in label or "次のページ" in label]
            if not following:
                return
            page = following[0].rsplit("/", 1)[-1]


class PagedSource(DataSource):
    """Options: ``path`` (folder of targets), ``maxPages`` (default 7)."""

    @classmethod
    def name(cls) -> str:
        return "machiya_paged"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(self.options["path"], int(self.options.get("maxPages", 7)))


def first_links(found: DataFrame, pattern: str) -> DataFrame:
    """(target, listingId, page, position, href): each listing's first link per target."""
    keyed = found.withColumn("listingId", F.nullif(F.lower(F.regexp_extract("href", pattern, 1)), F.lit(""))).where("listingId is not null")
    return keyed.groupBy("target", "listingId").agg(F.min(F.struct("page", "position", "href")).alias("f")).select("target", "listingId", "f.*")


def target_health(found: DataFrame) -> DataFrame:
    """(target, links, healthy): a target is healthy if it had no error and at least one link."""
    return found.groupBy("target").agg(F.count("href").alias("links"), F.max("error").alias("error")).withColumn("healthy", F.col("error").isNull() & (F.col("links") > 0))
