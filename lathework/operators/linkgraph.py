"""Reachability over links between pages, level by level."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lathework.functions.web import code_blocks_of, content_select, detect_language, html_title, links_of, netloc, normalize_url, should_follow, urljoin
from lathework.session import BROADCAST_ROWS, cut_lineage

MAX_DEPTH = 4


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst) of all links of all pages, resolved and normalised, http only, distinct."""
    cut = pages.where(pages[url].isNotNull()).select(pages[url].alias("base"), F.explode(links_of(pages[html])).alias("href"))
    joined = cut.select(normalize_url("base").alias("src"), normalize_url(urljoin("base", "href")).alias("dst"))
    return joined.where("dst LIKE 'http%'").distinct()


def reachable(links: DataFrame, starts: DataFrame, most_depth: int = MAX_DEPTH, same_host: bool = True) -> DataFrame:
    """(url, depth) of all pages within ``most_depth`` links of the starts, with their least depth.

    One join and one anti-join a level, each level checkpointed; links of pages already visited
    are never followed again. Hot targets are met by the distinct before the anti-join, which
    combines before the shuffle.
    """
    edges = links.where(netloc("src") == netloc("dst")) if same_host else links
    edges = cut_lineage(edges.select("src", "dst").distinct())
    seen = cut_lineage(starts.select("url").where("url IS NOT NULL").distinct().withColumn("depth", F.lit(0)))
    frontier = seen
    for depth in range(1, most_depth + 1):
        near = frontier.join(edges, frontier["url"] == edges["src"]).select(F.col("dst").alias("url")).distinct()
        frontier = cut_lineage(near.join(seen.select("url"), "url", "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        seen = cut_lineage(seen.unionByName(frontier))
    return seen


def crawl(pages: DataFrame, starts: DataFrame, most_pages: int = 100, most_depth: int = 3, pattern: str | None = None, least: int = 100) -> DataFrame:
    """(start, url, domain, depth, title, content, code_blocks) of the pages that a crawl from every start collects.

    ``pages`` (url, html) are recorded; of several of one url that of the least html counts. Pages
    are visited in breadth-first order from every start, on its host, up to ``most_depth`` links
    away; only those with ``least`` characters of content count and have their links followed, and
    a start ends with ``most_pages`` of them. One round a level; the limit is a rank that every task
    applies to its part first, so a large site sends no more than the limit to the last task.
    """
    known = pages.where("url IS NOT NULL").select(normalize_url("url").alias("url"), "html").groupBy("url").agg(F.min("html").alias("html"))
    made = known.withColumn("content", content_select("html")).where(F.length("content") >= least)
    blocks = F.transform(code_blocks_of("html"), lambda b: F.struct(detect_language(b["classes"], b["code"]).alias("language"), b["code"].alias("code")))
    read = made.select("url", html_title("html").alias("title"), "content", blocks.alias("code_blocks"), links_of("html").alias("hrefs"))
    read = cut_lineage(read)
    frontier = starts.where("url IS NOT NULL").select(normalize_url("url").alias("start")).distinct()
    frontier = frontier.select("start", F.col("start").alias("url"), F.lit(0).cast("bigint").alias("place"))
    seen = cut_lineage(frontier)
    counts = frontier.select("start", F.lit(0).cast("bigint").alias("had"))
    out = None
    for depth in range(most_depth + 1):
        met = frontier.join(read, "url").join(counts, "start", "left").withColumn("had", F.coalesce("had", F.lit(0)))
        rank = F.row_number().over(Window.partitionBy("start").orderBy("place", "url"))
        now = met.withColumn("n", rank).where(F.col("n") <= most_pages).where(F.col("n") + F.col("had") <= most_pages)
        now = cut_lineage(now.withColumn("depth", F.lit(depth)))
        out = now if out is None else out.unionByName(now)
        if depth == most_depth or not now.limit(1).count():
            break
        hrefs = now.select("start", "url", "n", F.posexplode("hrefs").alias("at", "href"))
        links = hrefs.select("start", "n", "at", normalize_url(urljoin("url", "href")).alias("link")).where(should_follow("link", netloc("start"), pattern))
        links = links.groupBy("start", F.col("link").alias("url")).agg(F.min(F.struct("n", "at")).alias("x"))
        fresh = links.select("start", "url", (F.col("x.n").cast("bigint") * (1 << 20) + F.col("x.at")).alias("place")).join(seen.select("start", "url"), ["start", "url"], "left_anti")
        frontier = cut_lineage(fresh)
        seen = cut_lineage(seen.select("start", "url").unionByName(frontier.select("start", "url")))
        counts = cut_lineage(out.groupBy("start").agg(F.count("*").alias("had")))
    return out.select("start", "url", netloc("start").alias("domain"), "depth", "title", "content", "code_blocks")


def resume(links: DataFrame, visited: DataFrame, host: str | None = None) -> DataFrame:
    """(url) still to visit: what visited pages link to, less what was visited."""
    near = links.join(visited.select(F.col("url").alias("src")), "src").select(F.col("dst").alias("url")).distinct()
    near = near.where(netloc("url") == host) if host else near
    return near.join(visited.select("url"), "url", "left_anti")


def allowed(links: DataFrame, visited: DataFrame, forbidden: DataFrame, host: str, url: str = "url", most: int = BROADCAST_ROWS) -> DataFrame:
    """Urls of the host that were not visited and lie under no forbidden prefix (host, prefix).

    Up to ``most`` prefixes of the host are broadcast; more are joined by the beginnings of the path
    of the lengths that prefixes have.
    """
    mine = links.where(netloc(url) == host).join(visited.select("url"), url, "left_anti")
    barred = forbidden.where(F.col("host") == host).select("prefix").distinct()
    path = F.regexp_extract(mine[url], r"^[a-z]+://[^/]*(/[^?#]*)", 1)
    if barred.limit(most + 1).count() <= most:
        return mine.join(F.broadcast(barred), F.startswith(path, barred["prefix"]), "left_anti")
    lengths = barred.agg(F.collect_set(F.length("prefix")).alias("lengths"))  # one row, as many as a url has characters
    begins = mine.select(mine[url].alias("_url"), path.alias("_path")).distinct().crossJoin(lengths)
    begins = begins.select("_url", "_path", F.explode(F.filter("lengths", lambda n: n <= F.length("_path"))).alias("n"))
    under = begins.select("_url", F.substring("_path", F.lit(1), F.col("n")).alias("prefix")).join(barred, "prefix").select("_url").distinct()
    return mine.join(under, mine[url] == under["_url"], "left_anti")
