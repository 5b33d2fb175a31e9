"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables (or what Spark derives from them) in
full; nothing is sampled or capped except where a limit is the operator (the
next-batch top-k).
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TAXONOMY, rule_pack
from ..functions.hashing import content_hash, page_changes, page_history
from ..functions.prompts import answer_label, user_prompt
from ..functions.urls import is_external, with_normalized_url
from ..operators.classify import (category_profile, classify_links, classify_url, merge_profiles, profile_counts,
                                  profile_partial)
from ..operators.extract import anchor_rows, page_links, run_links
from ..operators.ids import dense_rank_rows
from ..operators.jobs import classify_table, store_links
from ..operators.keyed import insert_if_absent
from ..operators.pagetable import upsert_page_table, write_page_table
from ..operators.relabel import apply_labels, label_residue, next_batch, relabel_counts, relabel_pass, residue
from ..session import reliable_checkpoint, scratch_path
from ..sources.config import Settings
from ..sources.export import export_categories, read_export
from ..sources.tables import apply_column_map, ensure_column, read_link_table
from ..streaming.links import start_link_stream
from .catalog import OLD_TS, PAGES_ROOT, RUN_TS, SHOP_ROOT, shop_links, table
from .forms import FORM_QUERIES
from .stubs import stub_complete

SHOP_RULES = rule_pack(SHOP_ROOT)
PAGE_RULES = rule_pack(PAGES_ROOT)
MANY_RULES = [(f"group{k % 7}", rf"^https?://(?:www\.)?shop\.example/.+-p-hbv{k}(?:[/?].*)?$", ["IGNORECASE"]) for k in range(1, 2001)]
DIGIT_RULES = [("even", "[02468]/?$", []), ("odd", "[13579]/?$", [])]


def _pages(spark, sf):
    """The page table, one row group at these scales, spread over the session's cores for the parser."""
    return table(spark, sf, "pages").select("page_id", "url", "html").repartition(spark.sparkContext.defaultParallelism)


# --- extraction ------------------------------------------------------------

def links_extract(spark: SparkSession, sf: str) -> DataFrame:
    """X1..X5: every anchor of every page, in document order."""
    return anchor_rows(_pages(spark, sf)).select("page_id", "pos", "href", "anchor_text", "rel")


def links_normalize(spark: SparkSession, sf: str) -> DataFrame:
    """N1 on the page URLs themselves (fragments, tracking keys, query re-encoding)."""
    p = table(spark, sf, "pages").select("page_id", "url")
    return with_normalized_url(p, "url", "url")


def links_resolve(spark: SparkSession, sf: str) -> DataFrame:
    """N1 on every anchor (no dedupe): relative hrefs resolved against the page."""
    return page_links(_pages(spark, sf), PAGES_ROOT, dedupe_page=False) \
        .select("page_id", "pos", "url", "normalized_url")


def links_dedupe_page(spark: SparkSession, sf: str) -> DataFrame:
    """First anchor per normalised URL within each page (no shuffle)."""
    return page_links(_pages(spark, sf), PAGES_ROOT) \
        .select("page_id", "pos", "url", "normalized_url", "anchor_text", "rel")


def links_dedupe_run(spark: SparkSession, sf: str) -> DataFrame:
    """First sighting per normalised URL over the whole run."""
    return run_links(_pages(spark, sf), PAGES_ROOT) \
        .select("normalized_url", "page_id", "pos", "url", "anchor_text")


def links_external(spark: SparkSession, sf: str) -> DataFrame:
    """Off-site flag against the root domain (parity and strict)."""
    links = page_links(_pages(spark, sf), PAGES_ROOT)
    return links.select("page_id", "pos", "normalized_url", "is_external",
                        is_external(F.col("normalized_url"), PAGES_ROOT, strict=True)
                        .alias("is_external_strict"))


def links_category_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: pages -> links -> run distinct -> classify -> links per category."""
    links = run_links(_pages(spark, sf), PAGES_ROOT)
    classified = classify_links(links, PAGE_RULES, url_col="normalized_url")
    return category_profile(classified)


# --- classification --------------------------------------------------------

def classify_first_match(spark: SparkSession, sf: str) -> DataFrame:
    """First matching rule per link, NULL urls left untouched."""
    return classify_links(shop_links(spark, sf), SHOP_RULES).select("id", "url", "pred_category")


def classify_only_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """rows already labelled keep their label."""
    links = shop_links(spark, sf).withColumn(
        "pred_category", F.when(F.col("p_size") > 25, F.lit("kept")))
    return classify_links(links, SHOP_RULES).select("id", "url", "pred_category")


def classify_force_ignorecase(spark: SparkSession, sf: str) -> DataFrame:
    """The variant that matches case-insensitively whatever the flags say."""
    rules = [(label, pat, []) for label, pat, _ in SHOP_RULES]
    links = shop_links(spark, sf).withColumn("url", F.upper(F.col("url")))
    return classify_links(links, rules, force_ignorecase=True).select("id", "url", "pred_category")


def classify_row(spark: SparkSession, sf: str) -> DataFrame:
    """Row-wise label of stripped urls; NULL is ``other``."""
    links = shop_links(spark, sf)
    padded = F.when(F.col("p_size") < 10, F.concat(F.lit("  "), F.col("url"), F.lit(" "))) \
        .otherwise(F.col("url"))
    return links.select("id", padded.alias("url"), classify_url(padded, SHOP_RULES).alias("category"))


def category_profile_shop(spark: SparkSession, sf: str) -> DataFrame:
    """D4 over the classified shop links."""
    return category_profile(classify_links(shop_links(spark, sf), SHOP_RULES), url_col="url")


def classify_many_rules(spark: SparkSession, sf: str) -> DataFrame:
    """2,000 rules over the shop links, found by their literals."""
    return classify_links(shop_links(spark, sf), MANY_RULES, lookup=True).select("id", "url", "pred_category")


def profile_merged(spark: SparkSession, sf: str) -> DataFrame:
    """D4 of four batches of links, merged: counts are exact, the distinct URLs are within 5 % of a recount."""
    links = classify_links(shop_links(spark, sf), SHOP_RULES)
    parts = [profile_partial(links.where(F.pmod(F.xxhash64("id"), F.lit(4)) == k)) for k in range(4)]
    halves = [merge_profiles(parts[k].unionByName(parts[k + 1])) for k in (0, 2)]
    merged = profile_counts(merge_profiles(halves[0].unionByName(halves[1])))
    exact = category_profile(links, url_col="url").select(F.col("pred_category").alias("c"), "n_distinct")
    close = F.abs(F.col("n_distinct_estimate") - F.col("n_distinct")) <= 0.05 * F.col("n_distinct")
    return merged.join(exact, F.col("pred_category").eqNullSafe(F.col("c"))).select("pred_category", "n_links", "n_external", "n_internal", close.alias("distinct_is_close"))


# --- keyed writes ----------------------------------------------------------

def _run_links(spark, sf):
    return page_links(_pages(spark, sf), PAGES_ROOT)


def insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    """Links of '#top' pages are stored; the whole run is inserted
    again; the result is the rows appended, with their new ids."""
    # both the stored part and the batch come from one parse of the pages
    links = reliable_checkpoint(_run_links(spark, sf))
    pages = table(spark, sf, "pages").select("page_id", F.col("url").alias("page_url"))
    first = links.join(pages.where(F.col("page_url").endswith("#top")).select("page_id"), "page_id")
    target = insert_if_absent(first, None, "normalized_url", ["page_id", "pos"])
    added = insert_if_absent(links, target, "normalized_url", ["page_id", "pos"])
    return added.select("id", "normalized_url", "page_id", "pos", "url")


def links_store(spark: SparkSession, sf: str) -> DataFrame:
    """Pages -> links -> first sighting -> column map and defaults -> new link table with ids, read back."""
    path = scratch_path(spark, "links")
    return store_links(_pages(spark, sf), path, PAGES_ROOT, run_ts=F.to_timestamp(F.lit(RUN_TS))).select(
        "id", "url", "normalized_url", "anchor_text", "rel", "is_external",
        F.date_format("discovered_at", "yyyy-MM-dd HH:mm:ss").alias("discovered_at"))


def _crawl_classify_crawl(spark: SparkSession, sf: str, partition_by_category: bool) -> DataFrame:
    pages = _pages(spark, sf)
    settings = Settings(rules=DIGIT_RULES, url_col="normalized_url")
    first, labelled = scratch_path(spark, "crawl"), scratch_path(spark, "crawl-labelled")
    store_links(pages.where(F.col("url").endswith("#top")), first, PAGES_ROOT, settings)
    classify_table(spark, first, labelled, None, settings, partition_by_category=partition_by_category)
    store_links(pages, labelled, PAGES_ROOT, settings)
    return store_links(pages, labelled, PAGES_ROOT, settings).select("id", "normalized_url", "url", "pred_category")


def crawl_classify_crawl(spark: SparkSession, sf: str) -> DataFrame:
    """Links stored, labelled by rules, then more links stored twice: labels stay, new rows have none, the
    second time adds nothing."""
    return _crawl_classify_crawl(spark, sf, False)


def crawl_category_layout(spark: SparkSession, sf: str) -> DataFrame:
    """The same over a table laid out by category: appended rows go into its layout and are read back."""
    return _crawl_classify_crawl(spark, sf, True)


def surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Dense ids in (p_name, p_partkey) order without a single-task window."""
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    return dense_rank_rows(p, ["p_name", "p_partkey"], out="rn", start=1)


def _page_items(pages: DataFrame, title: str, seq_offset: int, depth: int) -> DataFrame:
    return pages.select(
        "url", (F.col("page_id") + F.lit(seq_offset)).alias("seq"),
        F.lit(200).alias("status_code"), F.lit(title).alias("title"),
        F.col("html").alias("html_content"),
        F.length("html").cast("int").alias("content_length"), F.lit(depth).alias("link_depth"))


def upsert_pages_q(spark: SparkSession, sf: str) -> DataFrame:
    """A stored page table merged with a batch; the later item wins."""
    pages = table(spark, sf, "pages")
    stored = pages.where(~F.col("url").contains("?"))
    target = (dense_rank_rows(stored.select("page_id", "url", "html"), ["page_id"], out="id")
              .select("id", "url", F.lit(200).alias("status_code"), F.lit("old").alias("title"),
                      F.lit("meta").alias("meta_description"), F.col("html").alias("html_content"),
                      F.length("html").cast("int").alias("content_length"),
                      F.lit(0).alias("link_depth"),
                      F.to_timestamp(F.lit(OLD_TS)).alias("fetched_at"),
                      content_hash(F.col("html")).alias("content_hash")))
    batch = _page_items(pages.where(F.col("url").contains("?") | F.col("url").endswith("#top")),
                        "first", 0, 1) \
        .unionByName(_page_items(pages.where(F.col("url").contains("?page=")), "second", 1_000_000_000, 2))
    path = scratch_path(spark, "page-table")
    write_page_table(target, path, buckets=16)
    merged = upsert_page_table(batch, path, "seq", run_ts=F.to_timestamp(F.lit(RUN_TS)))
    return merged.select("id", "url", "status_code", "title", "meta_description", "html_content", "content_length",
                         "link_depth", F.date_format("fetched_at", "yyyy-MM-dd").alias("fetched_day"),
                         "content_hash")


def column_map(spark: SparkSession, sf: str) -> DataFrame:
    """K3/K8/K9: mapped output columns, defaults for missing fields."""
    links = _run_links(spark, sf).withColumn("is_external", F.lit(None).cast("boolean"))
    cmap = [("link", "normalized_url"), ("source_href", "url"), ("text", "anchor_text"),
            ("is_external", "is_external"), ("discovered_at", "seen_at")]
    out = ensure_column(apply_column_map(links, cmap, run_ts=F.to_timestamp(F.lit(RUN_TS))),
                        "pred_category")
    return out.select("link", "source_href", "text", "is_external",
                      F.date_format("discovered_at", "yyyy-MM-dd HH:mm:ss").alias("discovered_at"),
                      "pred_category")


def ensure_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """K8/K9: the category column is added when missing; a missing off-site flag
    becomes false and a missing discovery time becomes the run time."""
    links = _run_links(spark, sf)
    raw = links.select(
        "normalized_url",
        F.when(F.col("anchor_text").contains("e"), F.lit(None).cast("boolean"))
         .otherwise(F.col("is_external")).alias("is_external"),
        F.when(F.col("pos") % 2 == 0, F.to_timestamp(F.lit(OLD_TS))).alias("discovered_at"))
    cmap = [("normalized_url", "normalized_url"), ("is_external", "is_external"),
            ("discovered_at", "discovered_at")]
    out = ensure_column(apply_column_map(raw, cmap, run_ts=F.to_timestamp(F.lit(RUN_TS))), "pred_category")
    return out.select("normalized_url", "is_external",
                      F.date_format("discovered_at", "yyyy-MM-dd HH:mm:ss").alias("discovered_at"),
                      "pred_category")


# --- pages -----------------------------------------------------------------

def page_hash(spark: SparkSession, sf: str) -> DataFrame:
    """H1: SHA-256 of every page's HTML."""
    return table(spark, sf, "pages").select("page_id", "url", content_hash(F.col("html")).alias("content_hash"))


def page_changes_q(spark: SparkSession, sf: str) -> DataFrame:
    """H2: new / changed / same / gone between two crawls of the page table."""
    pages = table(spark, sf, "pages")
    old = pages.where(~F.col("url").endswith("#top")).select("url", content_hash(F.col("html")).alias("content_hash"))
    new_html = F.when(F.col("url").contains("?page="), F.concat(F.col("html"), F.lit("<!-- v2 -->"))) \
        .otherwise(F.col("html"))
    new = pages.where(~F.col("url").contains("utm_source")).select(
        "url", content_hash(new_html).alias("content_hash"))
    return page_changes(old, new).select("url", "change")


def page_history_q(spark: SparkSession, sf: str) -> DataFrame:
    """H2 over four crawls: pages that never change, change once, change back, and are missed by a crawl."""
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    kind = F.col("page_id") % 5
    crawl = F.col("crawl")
    html = (F.when((kind == 1) & (crawl >= 2), F.concat(F.col("html"), F.lit("<!-- changed -->")))
            .when((kind == 2) & (crawl == 2), F.concat(F.col("html"), F.lit("<!-- for a while -->")))
            .otherwise(F.col("html")))
    sightings = (pages.withColumn("crawl", F.explode(F.array(*[F.lit(c) for c in (1, 2, 3, 4)])))
                 .where(~((kind == 3) & (crawl == 2)) & ~((kind == 4) & (crawl == 1))).select("url", "crawl", content_hash(html).alias("content_hash")))
    return page_history(sightings)


# --- relabel ---------------------------------------------------------------

def residue_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The next batch of 100 lowest ids among unlabelled or ``other`` rows."""
    links = classify_links(shop_links(spark, sf), SHOP_RULES)
    # a predicate is the whole selection, so it names the residue itself
    return next_batch(links, 100, where="COALESCE(pred_category, 'other') = 'other' AND anchor_text LIKE '%a%'")


def relabel_where(spark: SparkSession, sf: str) -> DataFrame:
    """a configured predicate selects rows that already have a label."""
    links = classify_links(shop_links(spark, sf), SHOP_RULES)
    return residue(links, where="pred_category = 'help'").select("id", "url", "pred_category")


def prompt_build(spark: SparkSession, sf: str) -> DataFrame:
    """M2: the user prompt of every link."""
    links = shop_links(spark, sf)
    return links.select("id", user_prompt(F.col("url"), F.col("anchor_text"), F.col("rel"),
                                          F.col("is_external")).alias("prompt"))


def answer_parse(spark: SparkSession, sf: str) -> DataFrame:
    """M3: labels parsed from model-style answers built around conversation turns."""
    c = table(spark, sf, "conversations")
    lbl = (F.when(F.col("role") == "user", F.lit("product"))
           .when(F.col("role") == "assistant", F.lit("brand")).otherwise(F.lit("Policy")))
    js = F.concat(F.lit('{"label":"'), lbl, F.lit('"}'))
    shape = F.col("turn") % 6
    raw = (F.when(shape == 0, js)
           .when(shape == 1, F.concat(F.lit("  ```json\n"), js, F.lit("\n```")))
           .when(shape == 2, F.concat(F.lit("Answer: "), js, F.lit(" end")))
           .when(shape == 3, F.concat(js, F.lit(' {"x":1}')))
           .when(shape == 4, F.col("text"))
           .otherwise(F.concat(F.lit('{"label":'), F.length("text").cast("string"), F.lit("}"))))
    return c.select("conv_id", "turn", answer_label(raw, TAXONOMY).alias("label"))


def _relabelled(spark, sf):
    links = classify_links(shop_links(spark, sf), SHOP_RULES)
    labels = label_residue(links, stub_complete, sleep=lambda s: None)
    return links, labels


def relabel_apply(spark: SparkSession, sf: str) -> DataFrame:
    """Residue labelled by the stub labeller and written back by id."""
    links, labels = _relabelled(spark, sf)
    return apply_labels(links, labels).select("id", "url", "pred_category")


def relabel_capped(spark: SparkSession, sf: str) -> DataFrame:
    """A pass capped at two batches of 100 asks only the 200 lowest residue ids."""
    links = classify_links(shop_links(spark, sf), SHOP_RULES)
    labels = label_residue(links, stub_complete, batch_size=100, max_batches=2, sleep=lambda s: None)
    return apply_labels(links, labels).select("id", "url", "pred_category")


def relabel_counts_q(spark: SparkSession, sf: str) -> DataFrame:
    """D3: rows updated per batch of 100 (id order)."""
    _, labels = _relabelled(spark, sf)
    return relabel_counts(labels)


def _repeating_links(spark, sf):
    """Shop links whose prompts repeat: no anchor, and the URL's key in eight values."""
    links = classify_links(shop_links(spark, sf), SHOP_RULES)
    short = F.regexp_replace("url", r"\d+$", (F.col("id") % 8).cast("string"))
    return links.withColumn("url", F.when(F.col("pred_category") == "other", F.regexp_replace(short, r"/[a-z-]+-p-HBV", "/x-p-")))


def relabel_asks(spark: SparkSession, sf: str) -> DataFrame:
    """Equal prompts are asked once and answered for all their rows: rows, prompts sent and labels per batch."""
    links = _repeating_links(spark, sf).withColumn("anchor_text", F.lit(None).cast("string"))
    labels = label_residue(links, stub_complete, sleep=lambda s: None)
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("asked").alias("n_asked"))


def relabel_passes(spark: SparkSession, sf: str) -> DataFrame:
    """Capped passes go on from a stored cursor until every residue row has been asked once."""
    links = classify_links(shop_links(spark, sf), SHOP_RULES)
    cursor = scratch_path(spark, "cursor")
    cap = -(-residue(links).count() // 3)
    reports = None
    for _ in range(3):
        labels, report = relabel_pass(links, stub_complete, cursor, batch_size=cap, max_batches=1, sleep=lambda s: None)
        links = reliable_checkpoint(apply_labels(links, labels))
        report = labels.agg(F.min("id").alias("first_id"), F.max("id").alias("last_id")).crossJoin(report)  # one row each
        reports = report if reports is None else reports.unionByName(report)
    return reports.select("pass", "n_rows", "first_id", "last_id", "n_unasked")


# --- export and streaming --------------------------------------------------

def export_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Sorted CSV export of (url, category), read back."""
    classified = classify_links(shop_links(spark, sf), SHOP_RULES)
    path = export_categories(classified, scratch_path(spark, "export"))
    return read_export(spark, path)


def _pages_glob(sf: str) -> str:
    return f"{sf.rstrip('/')}/pages*.parquet"  # a glob, so the file source watches the folder for this table's files


def _streamed_twice(spark: SparkSession, sf: str, seen: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    out = scratch_path(spark, "stream-links")
    for _ in range(2):      # the second run replays from a fresh checkpoint and must add nothing
        q = start_link_stream(spark, _pages_glob(sf), pages.schema, out, scratch_path(spark, "stream-ckpt"),
                              PAGES_ROOT, available_now=True, seen=seen)
        q.awaitTermination()
    return read_link_table(spark, out).select("normalized_url", "url", "anchor_text", "is_external")


def stream_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """S1..S3: pages streamed in, first sightings by keyed state, run twice."""
    return _streamed_twice(spark, sf, "state")


def stream_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Pages streamed in, micro-batches compared with the stored keys, run twice."""
    return _streamed_twice(spark, sf, "table")


def stream_retry(spark: SparkSession, sf: str) -> DataFrame:
    """A micro-batch fails before its rows are written, then after; the stream resumes and no row is lost or doubled."""
    pages = table(spark, sf, "pages")
    out, checkpoint = scratch_path(spark, "stream-links"), scratch_path(spark, "stream-ckpt")
    for broken in ("before", "after", None):
        def watch(moment: str, _batch: int, broken=broken) -> None:
            if moment == broken:
                raise ConnectionError("the sink went away")

        q = start_link_stream(spark, _pages_glob(sf), pages.schema, out, checkpoint, PAGES_ROOT, watch=watch)
        try:
            q.awaitTermination()
        except StreamingQueryException:
            if broken is None:
                raise
    return read_link_table(spark, out).select("normalized_url", "url", "anchor_text", "is_external")


QUERIES = {
    "links_extract": links_extract,
    "links_normalize": links_normalize,
    "links_resolve": links_resolve,
    "links_dedupe_page": links_dedupe_page,
    "links_dedupe_run": links_dedupe_run,
    "links_external": links_external,
    "links_category_profile": links_category_profile,
    "classify_first_match": classify_first_match,
    "classify_only_nulls": classify_only_nulls,
    "classify_force_ignorecase": classify_force_ignorecase,
    "classify_row": classify_row,
    "category_profile": category_profile_shop,
    "classify_many_rules": classify_many_rules,
    "profile_merged": profile_merged,
    "insert_ignore": insert_ignore,
    "links_store": links_store,
    "crawl_classify_crawl": crawl_classify_crawl,
    "crawl_category_layout": crawl_category_layout,
    "surrogate_keys": surrogate_keys,
    "upsert_pages": upsert_pages_q,
    "column_map": column_map,
    "ensure_defaults": ensure_defaults,
    "page_hash": page_hash,
    "page_changes": page_changes_q,
    "page_history": page_history_q,
    "residue_topk": residue_topk,
    "relabel_where": relabel_where,
    "prompt_build": prompt_build,
    "answer_parse": answer_parse,
    "relabel_apply": relabel_apply,
    "relabel_capped": relabel_capped,
    "relabel_counts": relabel_counts_q,
    "relabel_asks": relabel_asks,
    "relabel_passes": relabel_passes,
    "export_rows": export_rows,
    "stream_dedupe": stream_dedupe,
    "stream_compare": stream_compare,
    "stream_retry": stream_retry,
    **FORM_QUERIES,
}
