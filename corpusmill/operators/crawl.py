"""Link extraction and the crawl frontier."""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import urls as U
from corpusmill.plans.lineage import cut

HREF = r'(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"'


def links(pages: DataFrame) -> DataFrame:
    """(page_id, pos, href, target) of every anchor, in page order."""
    found = pages.select("page_id", "url", F.posexplode(F.regexp_extract_all("html", F.lit(HREF), 1)).alias("pos", "href"))
    return found.select("page_id", "pos", "href", U.resolve(F.col("url"), F.col("href")).alias("target"))


def candidate_links(pages: DataFrame, suffix: str = ".txt") -> DataFrame:
    """Anchors that read "download" or lead to a file of the suffix, then the latter only: first page and place of each."""
    anchor = r'(?is)<a\s[^>]*?href\s*=\s*"[^"]*"[^>]*>.*?</a>'
    found = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(anchor), 0)).alias("pos", "tag"))
    found = found.select("page_id", "pos", F.regexp_extract("tag", HREF, 1).alias("url"), F.lower(F.trim(F.regexp_replace("tag", "<[^>]*>", ""))).alias("label"))
    good = found.where((F.col("label") == "download") | F.endswith(F.lower("url"), F.lit(suffix))).where(F.endswith(F.lower("url"), F.lit(suffix)))
    return good.groupBy("url").agg(F.min(F.struct("page_id", "pos")).alias("first")).select("url", "first.page_id", "first.pos")


def pending(rows: DataFrame, order: str, done: DataFrame) -> DataFrame:
    """The pending queue: the first row inserted for each url, without the urls that are done."""
    first = rows.groupBy("url").agg(F.min_by(F.struct("depth_actual", "depth_effective"), order).alias("d"))
    return first.join(done.distinct(), "url", "left_anti").select("url", "d.*")


def crawl(start: DataFrame, edges: DataFrame, max_depth: int, home: Callable[[Column], Column] | None = None, visit: Callable[[Column], Column] | None = None, max_pages: int = 0) -> DataFrame:
    """Breadth-first traversal of ``edges`` (src, dst): (url, depth_actual, depth_effective).

    A page on a home domain has effective depth 0, any other one more than the page that led to it;
    pages of effective depth below ``max_depth`` are expanded. Each level is one join, its
    new urls are made distinct and kept against the visited ones by an anti join, and the
    levels are written, so the driver holds no urls. It ends when a level has no new urls, or
    after ``max_pages``.
    """
    at_home = home or (lambda u: F.lit(False))
    allowed = visit or (lambda u: F.lit(True))
    level = cut(start.select("url", F.lit(0).alias("depth_actual"), F.lit(0).alias("depth_effective")).dropDuplicates(["url"]))
    seen, total = level, level.count()
    for depth in count(1):
        if max_pages and total >= max_pages:
            break
        grown = level.where(F.col("depth_effective") < max_depth).join(edges, F.col("url") == F.col("src"))
        effective = F.when(at_home(F.col("dst")), 0).otherwise(F.col("depth_effective") + 1)
        grown = grown.where(allowed(F.col("dst"))).groupBy(F.col("dst").alias("url")).agg(F.lit(depth).alias("depth_actual"), F.min(effective).alias("depth_effective"))
        level = cut(grown.join(seen.select("url"), "url", "left_anti"))
        n = level.count()
        if not n:
            break
        total += n
        seen = seen.unionByName(level)
    return seen.orderBy("depth_actual", "url").limit(max_pages) if max_pages else seen
