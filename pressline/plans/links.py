"""The link side of a run: stored listing pages to filtered links, batches, their index and what is left to do."""

from __future__ import annotations

import posixpath
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressline import fixed_values as fv
from pressline.operators import links as L
from pressline.operators.batches import assign_batches
from pressline.params import Blacklist, Site
from pressline.session import tidy
from pressline.sources import readers, sinks
from pressline.sources.dom import parse_pages


def listing_links(pages: DataFrame, *, site: Site = Site(), bl: Blacklist = Blacklist(),
                  segments: Sequence[str] = tuple(fv.ARTICLE_SEGMENTS)) -> list[DataFrame]:
    """Links that listing pages offer: of headings, of both content areas, and all that look like articles."""
    dom = parse_pages(pages)
    areas = [L.content_links(dom, area=area, segments=segments, site=site, bl=bl) for area in ("modules", "main")]
    return [L.heading_links(dom, site=site, bl=bl), *areas, L.article_links(L.extract_links(dom, site=site), site=site)]


def link_run(found: Sequence[DataFrame], out: str, *, site: Site = Site(), bl: Blacklist = Blacklist(), size: int = 1000,
             progress: str | None = None) -> dict[str, int]:
    """Link tables -> ``links``, ``link_batches`` and their index below ``out``; the counts of the writes.

    The union of all tables is made a set and filtered once and written; batches
    are cut from the written list, and the index is taken from the written
    batches.  ``to_do`` then has the links that the ledger at ``progress`` lacks.
    """
    spark, at = found[0].sparkSession, lambda *parts: posixpath.join(out, *parts)
    sinks.write_links(L.filter_links(L.union_links(*found), site=site, bl=bl), at("links"))
    with tidy(spark):
        sinks.write_batches(assign_batches(readers.read_link_rows(spark, at("links")), size=size), at("link_batches"))
    batches = read_batches(spark, at("link_batches"))
    counts = sinks.write_batch_index(batches, at("link_batches"), size=size)
    done = readers.read_progress(spark, progress or at("progress"))
    sinks.write_batches(L.remaining(batches, done), at("to_do"))
    counts["to_do"] = read_batches(spark, at("to_do")).count()
    return counts


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """(batch_no, url) of written link batches; the index beside them is left out."""
    return spark.read.schema("url string, batch_no int").option("pathGlobFilter", "part-*").json(path).select("batch_no", "url").where(F.col("batch_no").isNotNull())
