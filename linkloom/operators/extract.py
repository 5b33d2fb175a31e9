"""Page -> links (X1..X6, N1, F1, D1, N2).

The parser returns each page's anchors as one array, and the HTML column is
dropped right after parsing.  Two map-only forms follow, neither shuffles:

* with the per-page dedupe (D1): the anchors are normalised in place inside
  the page's array, filtered, and reduced to the first anchor per normalised
  URL before they are exploded;
* without it (and for the run-wide ``run_links``, where D2 subsumes D1): the
  anchors are exploded first and normalised row by row as compiled code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_ROOT_DOMAIN, TRACKING_PARAM_PREFIXES
from ..functions.html import extract_anchors
from ..functions.strings import normalize_space
from ..functions.urls import is_external, normalize_in_array, with_normalized_url
from .dedupe import run_distinct_links

def page_anchors(pages: DataFrame, page_id: str = "page_id", url: str = "url",
                 html: str = "html", partitions: int | None = None) -> DataFrame:
    """One row per page with its anchors array (``pos, href, text, rels``).

    A large input comes in splits enough for the CPU-bound parser;
    ``partitions`` spreads one that does not (a single row group, say), at the
    cost of a shuffle of its pages.
    """
    pages = pages.select(page_id, url, html)
    if partitions:
        pages = pages.repartition(partitions)
    return pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("page_url"),
                        extract_anchors(F.col(html)).alias("anchors"))


def anchor_rows(pages: DataFrame, **cols) -> DataFrame:
    """X1..X4 as rows: page_id, pos, href, anchor_text (normalised), rel."""
    a = page_anchors(pages, **cols)
    return (a.select("page_id", "page_url", F.explode_outer("anchors").alias("a"))
            .where(F.col("a").isNotNull())
            .select("page_id", "page_url", F.col("a.pos").alias("pos"), F.col("a.href").alias("href"),
                    normalize_space(F.col("a.text")).alias("anchor_text"),
                    F.when(F.size("a.rels") > 0, F.array_join("a.rels", " ")).alias("rel")))


def first_per_key_in_array(arr: Column, key_field: str, order_field: str) -> Column:
    """Keep, per distinct ``key_field``, the element with the smallest ``order_field``.

    Sorts (key, order) inside the array and keeps each run's head; the sorted
    array is bound once by a lambda so it is not recomputed per element.
    """
    tagged = F.transform(arr, lambda x: F.struct(x[key_field].alias("k"), x[order_field].alias("o"),
                                                  x.alias("e")))
    sorted_once = F.array(F.array_sort(tagged))
    heads = F.transform(sorted_once, lambda s: F.filter(
        s, lambda x, i: (i == 0) | (s[i - 1]["k"] != x["k"])))
    return F.transform(F.element_at(heads, 1), lambda x: x["e"])


def page_links_array(pages: DataFrame, root_domain: str = DEFAULT_ROOT_DOMAIN,
                     page_id: str = "page_id", url: str = "url", html: str = "html",
                     dedupe_page: bool = True, prefixes=TRACKING_PARAM_PREFIXES) -> DataFrame:
    """One row per page: ``page_id, page_url, links`` (array, D1 applied)."""
    a = page_anchors(pages, page_id=page_id, url=url, html=html)
    arr = normalize_in_array("anchors", "page_url", "href", "normalized_url", prefixes)
    arr = F.filter(arr, lambda x: F.coalesce(x["normalized_url"], F.lit("")) != "")      # F1
    if dedupe_page:
        arr = first_per_key_in_array(arr, "normalized_url", "pos")                          # D1
    return a.select("page_id", "page_url", arr.alias("links"))


def page_links(pages: DataFrame, root_domain: str = DEFAULT_ROOT_DOMAIN,
               page_id: str = "page_id", url: str = "url", html: str = "html",
               dedupe_page: bool = True, strict_external: bool = False,
               prefixes=TRACKING_PARAM_PREFIXES) -> DataFrame:
    """The link records of every page.

    Columns: ``page_id, pos, url`` (raw href), ``normalized_url, anchor_text,
    rel, is_external``.  ``pos`` is the anchor's 1-based place on its page;
    (page_id, pos) is the order in which links were seen.
    """
    if not dedupe_page:
        return _page_links_rows(pages, root_domain, page_id, url, html, strict_external, prefixes)
    per_page = page_links_array(pages, root_domain, page_id, url, html, dedupe_page, prefixes)
    # explode_outer: a plain explode makes the optimizer infer a size(links) > 0
    # filter below it, which would run the HTML parser a second time
    x = per_page.select("page_id", F.explode_outer("links").alias("l")).where(F.col("l").isNotNull())
    return x.select(
        "page_id",
        F.col("l.pos").alias("pos"),
        F.col("l.href").alias("url"),
        F.col("l.normalized_url").alias("normalized_url"),
        normalize_space(F.col("l.text")).alias("anchor_text"),                               # X3
        F.when(F.size("l.rels") > 0, F.array_join("l.rels", " ")).alias("rel"),               # X4
        is_external(F.col("l.normalized_url"), root_domain, strict_external).alias("is_external"),  # N2
    )


def _page_links_rows(pages: DataFrame, root_domain: str, page_id: str, url: str, html: str,
                     strict_external: bool, prefixes) -> DataFrame:
    """All links of every page without the per-page dedupe: anchors are
    exploded first and normalised row by row, which runs as compiled code
    (the in-array form is evaluated by higher-order functions)."""
    a = page_anchors(pages, page_id=page_id, url=url, html=html)
    rows = (a.select("page_id", "page_url", F.explode_outer("anchors").alias("a"))
            .where(F.col("a").isNotNull())
            .select("page_id", "page_url", F.col("a.pos").alias("pos"), F.col("a.href").alias("url"),
                    F.col("a.text").alias("text"), F.col("a.rels").alias("rels")))
    rows = with_normalized_url(rows, "page_url", "url", out="normalized_url", prefixes=prefixes)
    rows = rows.where(F.coalesce(F.col("normalized_url"), F.lit("")) != "")                  # F1
    return rows.select(
        "page_id", "pos", "url", "normalized_url",
        normalize_space(F.col("text")).alias("anchor_text"),                                  # X3
        F.when(F.size("rels") > 0, F.array_join("rels", " ")).alias("rel"),                   # X4
        is_external(F.col("normalized_url"), root_domain, strict_external).alias("is_external"),
    )


def run_links(pages: DataFrame, root_domain: str = DEFAULT_ROOT_DOMAIN, **kw) -> DataFrame:
    """X6 + D2: one row per normalised URL over all pages, first sighting wins.

    The per-page dedupe (D1) is left out: D2 keeps the first row by
    (page_id, pos), which D1 would have kept too, and the partial limit before
    D2's shuffle already drops a page's repeats inside its map task."""
    return run_distinct_links(page_links(pages, root_domain, dedupe_page=False, **kw))
