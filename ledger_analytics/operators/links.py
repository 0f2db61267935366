"""Links of stored pages and folder walks (S8–S11), re-aimed from a crawler.

Pages are rows (``page_id, url, html``); links become an edge table
(``page, pos, href, target``).  No network access happens here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import decode_entities, extract_hrefs, resolve_url
from ..session import ensure_checkpoint_dir

# Extensions the registry download keeps, and those the
# recursive walk counts as data files.
DOWNLOAD_EXTENSIONS = ("zip", "csv", "xlsx", "rar", "txt", "pdf")
WALK_EXTENSIONS = ("zip", "csv", "xlsx")


def page_links(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Every ``<a href>`` of every page in page order, resolved against the
    page URL (S8).  One row per link: ``page_id, pos, href, resolved``.
    Links in comments, scripts, text areas and other attributes do not count
    (:func:`~ledger_analytics.functions.urls.extract_hrefs`), and links without a
    target are dropped (they keep their place, so ``pos`` may have gaps)."""
    exploded = pages.select(F.col(id_col), F.col(url_col).alias("_url"),
                            F.posexplode(extract_hrefs(html_col)).alias("pos", "_raw")).where("_raw <> ''")
    links = exploded.select(F.col(id_col), "_url", F.col("pos").cast("int").alias("pos"),
                            decode_entities("_raw").alias("href"))
    return links.select(F.col(id_col), "pos", "href", resolve_url("_url", "href").alias("resolved"))


def first_matching_link(links: DataFrame, needle: str, id_col: str = "page_id") -> DataFrame:
    """Per page, the first link whose href contains ``needle``.
    A min over (pos, link) per page: partial aggregation, no sort."""
    hit = links.filter(F.col("href").contains(needle))
    first = hit.groupBy(id_col).agg(F.min(F.struct("pos", "href", "resolved")).alias("_m"))
    return first.select(id_col, "_m.pos", "_m.href", "_m.resolved")


def extension_pattern(extensions) -> str:
    return r"\.(" + "|".join(extensions) + r")$"


def links_by_extension(links: DataFrame, extensions=DOWNLOAD_EXTENSIONS, href_col: str = "href") -> DataFrame:
    """Links whose href ends with one of ``extensions``, any case."""
    return links.filter(F.lower(F.col(href_col)).rlike(extension_pattern(extensions)))


def is_folder(href):
    return href.endswith("/") | ~href.contains(".")


def latest_files(edges: DataFrame, root: str = "/", n: int = 3, extensions=WALK_EXTENSIONS) -> DataFrame:
    """The first ``n`` data files met by a depth-first walk from ``root``
    that visits a page's links last-first (S11).

    A link is a folder when it ends with ``/`` or has no ``.``; a file
    counts when its href ends with one of ``extensions``.  Each folder gets
    the path key ``[-pos at level 1, -pos at level 2, ...]``; sorting files
    by that array gives the depth-first visiting order.

    A folder link is followed only when its target extends the current page
    path (D14), so every walk ends and no depth bound is needed.  The walk
    doubles its reach each round: ``jumps`` holds all folder-to-folder steps
    of exactly 2^i levels, and the folders reached so far take one jump
    each, so a tree of depth d takes about log2(d) rounds of two joins.
    Both tables are checkpointed each round; the rounds end when no jump is
    left.  Files are joined once, after the walk.  Output: ``ordem`` (1..n),
    ``target``, ``href``.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    own = F.array(-F.col("pos").cast("long"))
    folder = is_folder(F.col("href"))
    deeper = F.col("target").startswith(F.col("page")) & (F.length("target") > F.length("page"))
    jumps = edges.where(folder & deeper).select("page", "target", own.alias("ord")).checkpoint()
    reached = spark.createDataFrame([(root, [])], "page string, ord array<bigint>")
    while not jumps.isEmpty():
        further = reached.join(jumps.withColumnRenamed("ord", "_ord"), "page") \
            .select(F.col("target").alias("page"), F.concat("ord", "_ord").alias("ord"))
        # dealt anew by page: a union of unions would double its partitions each round
        reached = reached.unionByName(further).repartition("page").checkpoint()
        then = jumps.select(F.col("page").alias("target"), F.col("target").alias("_end"), F.col("ord").alias("_ord"))
        jumps = jumps.join(then, "target").select("page", F.col("_end").alias("target"), F.concat("ord", "_ord").alias("ord")).repartition("page").checkpoint()
    files = edges.where(~folder & F.lower(F.col("href")).rlike(extension_pattern(extensions)))
    top = files.join(reached, "page").select("target", "href", F.concat("ord", own).alias("ord")).orderBy("ord").limit(n)
    # n rows only: the numbering window runs on the top-n result.
    return top.select(F.row_number().over(Window.orderBy("ord")).alias("ordem"), "target", "href")
