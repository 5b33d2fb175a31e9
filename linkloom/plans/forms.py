"""Queries over link forms that the page table itself lacks, and their DuckDB SQL.

Hrefs, markup and page folders are built around the keys of the given tables;
what must come out is stated next to each form, not computed a second way.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import with_normalized_url
from ..operators.classify import category_profile, classify_links
from ..operators.extract import anchor_rows, page_links, run_links
from ..session import scratch_path
from ..sources.config import read_settings
from ..sources.pages import stream_pages
from ..streaming.links import stream_seen_urls
from .catalog import PAGES_ROOT, table

HOST_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
PLAIN_BASE, DOTTED_BASE = "/a/b/c?old=1#top", "/a//b/../c"

# (href, link on the plain base, link on the dotted base); {w} is a word of the page, {h} its scheme and host
FORMS: list[tuple[str | None, str | None, str | None]] = [
    ("#top-{w}", None, None),
    ("  #{w}", None, None),
    ("mailto:{w}@x.example", None, None),
    ("tel:{w}", None, None),
    ("javascript:go({w})", None, None),
    ("data:,{w}", None, None),
    ("ftp://files.example/{w}", None, None),
    (None, None, None),
    ("", None, None),
    ("//Other.Example/{w}", "https://other.example/{w}", "https://other.example/{w}"),
    ("HTTP://Up.Example/{w}#frag", "http://up.example/{w}", "http://up.example/{w}"),
    ("?q={w}", "{h}/a/b/c?q={w}", "{h}/a/b/../c?q={w}"),
    ("{w}", "{h}/a/b/{w}", "{h}/a/{w}"),
    ("../{w}", "{h}/a/{w}", "{h}/{w}"),
    ("{w}/./d/../e", "{h}/a/b/{w}/e", "{h}/a/{w}/e"),
    ("/a//b///{w}", "{h}/a/b/{w}", "{h}/a/b/{w}"),
    ("/x;v=1/{w};p=2", "{h}/x;v=1/{w}", "{h}/x;v=1/{w}"),
    ("  /sp/{w}\t", "{h}/sp/{w}", "{h}/sp/{w}"),
    ("/p?a=%41{w}&utm_source=n&b=c d&e", "{h}/p?a=A{w}&b=c+d&e=", "{h}/p?a=A{w}&b=c+d&e="),
    ("/k?gclid=1&fbclid=2&mc_cid=3&sc_x=4&gclsrc=5", "{h}/k", "{h}/k"),
    ("/k?a=1;b={w}&c=%zz", "{h}/k?a=1%3Bb%3D{w}&c=%25zz", "{h}/k?a=1%3Bb%3D{w}&c=%25zz"),
]

MARKUP = ('<div><a rel="nofollow" class="c" href="/d/{w}?a=1&amp;b=2"> <b>T{w}</b>&eacute;\n x </a>'
          '<a name="n"><i rel="r1"><span href="/in/{w}" rel="r2">i</span></i></a>'
          '<a href="/first{w}"><em href="/second">s</em></a><a>no link</a>'
          "<A HREF='/up/{w}' REL=ugc></A></div>")
# the anchors of MARKUP in order: href, text, rel
ANCHORS_OF_MARKUP = [("/d/{w}?a=1&b=2", "T{w}é x", "nofollow"), ("/in/{w}", "i", "r1 r2"),
                     ("/first{w}", "s", None), (None, "no link", None), ("/up/{w}", None, "ugc")]

# Left-out end tags; the comments say where an anchor ends.
IMPLIED = ('<table><tr><td><a href="/cell{w}">x<td>y'                            # <td> ends the anchor in the cell before
           '<tr><th><a href="/head{w}">h</table>after'                           # so does </table>
           '<ul><li><a href="/one{w}">one<li><a href="/two{w}">two</ul>'          # <a> ends an open one, </ul> ends the other
           '<p><a href="/para{w}">p1<p>p2</a> p3'                                # <p> ends a p on top, not the anchor
           '<div><a href="/box{w}">in<div>side</a> out</div> more</div> end'     # </a> ends no div; the outer </div> ends both
           '<select><option><a href="/o{w}">1</a><option>2</select>'
           '<a href="/t{w}">cap<table><tr><td>no</table></a>no')                 # <table> ends the anchor
ANCHORS_OF_IMPLIED = [("/cell{w}", "x", None), ("/head{w}", "h", None), ("/one{w}", "one", None), ("/two{w}", "two", None),
                      ("/para{w}", "p1p2", None), ("/box{w}", "inside out more", None), ("/o{w}", "1", None), ("/t{w}", "cap", None)]

PATH_RULES = [("vowel", "/[AEIOU][^/]*$", ["IGNORECASE"]), ("even", "[02468]/?$", []), ("late", "[n-z]$", [])]


def _fill(template: str | None, word: Column) -> Column:
    return F.lit(None).cast("string") if template is None else F.replace(F.lit(template), F.lit("{w}"), word)


def links_forms(spark: SparkSession, sf: str) -> DataFrame:
    """N1, N1a..N1k, F1: every href form on a plain and a dotted page URL; dropped hrefs leave no row."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    word = F.concat(F.lit("w"), F.col("page_id").cast("string"))
    host = F.upper(F.regexp_extract("url", HOST_RE, 1))
    bases = F.array(*[F.concat(F.lit("HTTPS://"), host, F.lit(p)) for p in (PLAIN_BASE, DOTTED_BASE)])
    rows = (pages.select("page_id", word.alias("word"), F.posexplode(bases).alias("b", "base"))
            .select("page_id", (F.col("b") == 1).alias("dotted"), "base",
                    F.posexplode(F.array(*[_fill(h, F.col("word")) for h, _, _ in FORMS])).alias("form", "href")))
    return (with_normalized_url(rows, "base", "href")
            .where(F.coalesce("normalized_url", F.lit("")) != "")
            .select("page_id", "dotted", "form", "normalized_url"))


def links_markup(spark: SparkSession, sf: str) -> DataFrame:
    """X1..X4: nested hrefs, several rels, entities and upper-case markup around every document id."""
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("page_id"), F.lit("https://site.example/").alias("url"),
        _fill(MARKUP, F.col("doc_id").cast("string")).alias("html"))
    return anchor_rows(docs).select("page_id", "pos", "href", "anchor_text", "rel")


def links_implied(spark: SparkSession, sf: str) -> DataFrame:
    """X1..X4 where end tags are left out or misplaced, around every page's path."""
    pages = table(spark, sf, "pages").select(
        "page_id", "url", _fill(IMPLIED, F.concat(F.lit("-"), F.col("page_id").cast("string"))).alias("html"))
    return anchor_rows(pages).select("page_id", "pos", "href", "anchor_text", "rel")


def rules_from_config(spark: SparkSession, sf: str) -> DataFrame:
    """The run's links under a caller's rules, read from a JSON config file."""
    config = {"classification": {"url_col": "normalized_url", "patterns": [
        {"label": label, "pattern": pattern, "flags": flags} for label, pattern, flags in PATH_RULES]}}
    path = scratch_path(spark, "config")
    spark.createDataFrame([(json.dumps(config),)], "value string").coalesce(1).write.text(path)
    settings = read_settings(spark, path)
    links = run_links(table(spark, sf, "pages").select("page_id", "url", "html"), PAGES_ROOT)
    return category_profile(classify_links(links, settings.rules, url_col=settings.url_col), url_col="normalized_url")


def stream_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Pages streamed in, each normalised URL kept once by streaming state."""
    schema = table(spark, sf, "pages").schema
    pages = stream_pages(spark, f"{sf.rstrip('/')}/pages*.parquet", schema)
    seen = stream_seen_urls(page_links(pages, PAGES_ROOT, dedupe_page=False).select("normalized_url"))
    out = scratch_path(spark, "seen-urls")
    (seen.writeStream.format("parquet").option("checkpointLocation", scratch_path(spark, "seen-ckpt"))
     .trigger(availableNow=True).start(out).awaitTermination())
    return spark.read.schema(seen.schema).parquet(out)


FORM_QUERIES = {f.__name__: f for f in (links_forms, links_markup, links_implied, rules_from_config, stream_distinct)}


def _text(template: str | None, word: str, host: str = "''") -> str:
    if template is None:
        return "CAST(NULL AS VARCHAR)"
    quoted = template.replace("'", "''")
    return f"replace(replace('{quoted}', '{{w}}', {word}), '{{h}}', {host})"


def forms_sql() -> str:
    def side(dotted: bool) -> str:
        values = ", ".join(_text(f[2 if dotted else 1], "w", "'https://' || lower(host)") for f in FORMS)
        return (f"SELECT page_id, {str(dotted).lower()} AS dotted, CAST(unnest(range({len(FORMS)})) AS INTEGER) AS form, "
                f"unnest([{values}]) AS normalized_url FROM p")

    return (f"WITH p AS (SELECT page_id, 'w' || page_id AS w, regexp_extract(url, '{HOST_RE}', 1) AS host FROM pages) "
            f"SELECT * FROM ({side(False)} UNION ALL {side(True)}) WHERE normalized_url IS NOT NULL")


def markup_sql(anchors=ANCHORS_OF_MARKUP, source: str = "documents", key: str = "doc_id", word: str = "CAST(doc_id AS VARCHAR)") -> str:
    lists = [", ".join(_text(a[i], word) for a in anchors) for i in range(3)]
    return (f"SELECT {key} AS page_id, CAST(unnest(range(1, {len(anchors) + 1})) AS INTEGER) AS pos, "
            f"unnest([{lists[0]}]) AS href, unnest([{lists[1]}]) AS anchor_text, unnest([{lists[2]}]) AS rel FROM {source}")


def implied_sql() -> str:
    return markup_sql(ANCHORS_OF_IMPLIED, "pages", "page_id", "'-' || page_id")
