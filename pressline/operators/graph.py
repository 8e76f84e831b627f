"""Reachability over stored link edges."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pressline.operators.batches import global_index
from pressline.session import cut, new_path, tidy


class Visited:
    """``(url, depth)`` of a walk so far: one table, in buckets by URL, with a folder for each depth.

    A level is appended to the buckets.  New candidates are dealt into the same
    buckets and meet only those, so what was visited is read once a level and
    never shuffled again.
    """

    def __init__(self, like: DataFrame) -> None:
        self.spark = like.sparkSession
        self.name = f"walk_{uuid.uuid4().hex}"
        self.path = new_path(self.spark, "walk")
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self._write(like.limit(0).select("url"), 0, "overwrite")

    def _write(self, urls: DataFrame, depth: int, mode: str) -> None:
        rows = urls.withColumn("depth", F.lit(depth).cast("bigint"))
        rows.write.mode(mode).format("parquet").option("path", self.path).partitionBy("depth").bucketBy(self.buckets, "url").saveAsTable(self.name)

    def append(self, urls: DataFrame, depth: int) -> int:
        """Add a level; its size comes from the write itself."""
        size = Observation()
        self._write(urls.observe(size, F.count("*").alias("n")), depth, "append")
        return size.get["n"]

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def level(self, depth: int) -> DataFrame:
        return self.table().where(F.col("depth") == depth).select("url")

    def close(self) -> DataFrame:
        """Forget the name; the written rows stay and are the result."""
        self.spark.sql(f"DROP TABLE {self.name}")
        return self.spark.read.schema("url string, depth bigint").parquet(self.path)


def reachable(edges: DataFrame, seeds: DataFrame, *, max_depth: int, cap: int | None = None,
              fetched: DataFrame | None = None) -> DataFrame:
    """``(url, depth)`` of pages reached from the seeds within ``max_depth`` links.

    ``edges(src, dst)`` are stored links and ``seeds(url, depth)`` the start
    pages with their own depth.  A page gets its smallest depth.  Pages not in
    ``fetched`` have no content: they are neither reported nor expanded.  ``cap``
    stops after that many pages, in the order (depth, url); by default nothing
    is cut off.

    One join per level, and each of edges, visited and fetched pages is read once
    for it.  Edges and fetched pages are made sets once; what the walk writes for
    itself is removed at the end.
    """
    spark = edges.sparkSession
    with tidy(spark):
        links = cut(edges.select("src", "dst").where("src != dst").distinct())
        start = cut(seeds.where(F.col("url").isNotNull()).groupBy("url").agg(F.min("depth").cast("int").alias("depth")).where(F.col("depth") <= max_depth))
        known = None if fetched is None else cut(fetched.select("url").distinct())
        last_seed = start.agg(F.max("depth")).first()[0]
        visited, total, found = Visited(start), 0, 0
        for depth in range(-1 if last_seed is None else max_depth + 1):
            urls = start.where(F.col("depth") == depth).select("url")
            if found:
                # every src of the level once; the edge side may be skewed and is
                # split by adaptive execution, the level side is unique
                before = visited.level(depth - 1)
                urls = urls.unionByName(links.join(before, links["src"] == before["url"], "left_semi").select(F.col("dst").alias("url"))).distinct()
            urls = urls.join(visited.table().select("url"), "url", "left_anti")
            if known is not None:
                urls = urls.join(known, "url", "left_semi")
            if cap is not None:
                urls = cut(urls)
                if urls.count() > cap - total:
                    indexed = global_index(urls, "url")
                    urls = indexed.where(F.col("idx") < cap - total).select("url")
            found = visited.append(urls, depth)
            total += found
            if (cap is not None and total >= cap) or (not found and depth >= last_seed):
                break
        return visited.close()
