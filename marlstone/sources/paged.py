"""A data source over landed pages of a paginated interface: spark.read.format("landed_pages").load(folder).

Each page is a file {"items": [...], "next": "name of the next file" or null}; the chain starts at "start" (default page-0.json).
Chains that loop, repeat an item's id or run past max_pages or max_rows are refused, and so are items that lack a key in `required`.
With page_size, a shorter page is the last one, whatever it says. The folder must be on a path that executors share.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


class LandedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return "pos int, id string, item string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.folder, self.start = options["path"], options.get("start", "page-0.json")
        self.most, self.key = int(options.get("max_pages", 100)), options.get("id", "id")
        self.rows, self.size = int(options.get("max_rows", 1 << 62)), int(options.get("page_size", 0))
        self.required = [k for k in options.get("required", "").split(",") if k]

    def partitions(self):
        return [InputPartition(0)]  # a chain can only be followed page by page

    def read(self, partition):
        name, pages, ids, pos = self.start, set(), set(), 0
        while name:
            if name in pages or len(pages) >= self.most or os.path.basename(name) != name:
                raise ValueError(f"page chain broken at {name}")
            pages.add(name)
            with open(os.path.join(self.folder, name), encoding="utf-8") as f:
                page = json.load(f)
            if not isinstance(page, dict) or not isinstance(page.get("items"), list):
                raise ValueError(f"{name} is no page")
            for item in page["items"]:
                lacking = [k for k in (self.key, *self.required) if not isinstance(item, dict) or k not in item]
                if lacking:
                    raise ValueError(f"item without {', '.join(lacking)} in {name}")
                key = str(item[self.key])
                if key in ids:
                    raise ValueError(f"repeated item {key}")
                if pos >= self.rows:
                    raise ValueError(f"more than {self.rows} items")
                ids.add(key)
                yield pos, key, json.dumps(item, ensure_ascii=False)
                pos += 1
            name = None if len(page["items"]) < self.size else page.get("next")


def own_posts(items: DataFrame, creator: str, column: str = "item") -> DataFrame:
    """Of landed items (JSON) those that are published posts of a creator, and no responses to others."""
    at = lambda path: F.get_json_object(column, path)
    published = F.coalesce(at("$.firstPublishedAt").cast("long"), F.lit(0)) > 0
    return items.where((at("$.creator.id") == creator) & published & at("$.inResponseToPostResult.id").isNull())


def details(listing: DataFrame, landed: DataFrame, budget: int = 12) -> DataFrame:
    """listing (slug, updated_at, turn) with body_text from landed details (slug, updated_at, body_text): only of the same revision, and only for the first `budget` in turn."""
    bodies = landed.select("slug", "updated_at", "body_text").dropDuplicates(["slug", "updated_at"])
    asked = listing.where(F.col("turn") <= budget).join(bodies, ["slug", "updated_at"], "left")
    return asked.unionByName(listing.where(F.col("turn") > budget).withColumn("body_text", F.lit(None).cast("string"))).select(*listing.columns, "body_text")
