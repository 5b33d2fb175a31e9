"""URL resolution and normalisation as native Spark column expressions.

``normalized_url`` reproduces the link normaliser of the original tool:
resolution of a reference against the page URL the way Python's ``urljoin``
does it, fragment removed, http/https only, lower-case authority, tracking
keys dropped from the query, the query re-encoded the way ``urlencode`` does
it, ``//`` collapsed in the path and the last segment's ``;params`` dropped.

Every step is a built-in expression, in two layers:

* a compiled fast path (``fast_result``) for the common hrefs, built from
  ``instr``/``substring_index`` and a few regexes;
* the general case as named stages (``base_stages`` + ``href_stages``, run
  by ``staged.chain``), which handle everything else exactly.

``with_normalized_url``/``normalized_url`` work on rows;
``normalize_in_array`` works on all anchors of a page inside its array and
parses the page URL once for them.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SKIPPED_HREF_PREFIXES, TRACKING_PARAM_PREFIXES
from .staged import Stage, chain, let
from .strings import py_strip, starts_with_any

# scheme (1), '//'+authority marker (2), authority (3), path (4), query (5).
# The scheme is the text before the first ':' when it is an ASCII letter
# followed by letters, digits, '+', '-' or '.'.
_URL_RE = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
_DOT_SEGMENT_RE = r"(^|/)\.{1,2}(/|$)"
_BRACKET_HOST_RE = r"^(v[0-9A-Fa-f]+\..+|[0-9A-Fa-f.]*:[0-9A-Fa-f:.]*(%.+)?)$"

_BUILT: dict[tuple, tuple[object, Column]] = {}


def _memo(key: tuple, build: Callable[[], Column]) -> Column:
    """Reuse an expression over columns given by name while the same JVM gateway lives.

    Columns bound to a DataFrame are never kept: two of them print alike.

    Building the normaliser takes a few thousand JVM calls (about a second);
    a Column is an immutable expression tree, so one copy serves every query.
    The gateway object is kept with the entry, so a new gateway never matches
    an old entry.
    """
    gateway = SparkContext._gateway
    hit = _BUILT.get(key)
    if hit is None or hit[0] is not gateway:
        hit = (gateway, build())
        _BUILT[key] = hit
    return hit[1]


def _null_str() -> Column:
    return F.lit(None).cast("string")


def pre_clean(c: Column) -> Column:
    """URL splitting first drops tab/CR/LF anywhere and C0 controls/space in front."""
    return F.regexp_replace(F.regexp_replace(c, r"[\t\r\n]", ""), r"^[\x00-\x20]+", "")


def drop_last_params(path: Column) -> Column:
    """Remove ``;params`` of the last path segment (``/a;b/c;d`` -> ``/a;b/c``)."""
    return F.regexp_replace(path, r";[^/]*$", "")


def collapse_slashes(path: Column) -> Column:
    return F.regexp_replace(path, r"/{2,}", "/")


def bad_netloc(marker: Column, netloc: Column) -> Column:
    """Unbalanced or invalid bracketed host (the original raises; here the link is NULL)."""
    has_o = F.instr(netloc, "[") > 0
    has_c = F.instr(netloc, "]") > 0
    inner = F.regexp_extract(netloc, r"\[([^\]]*)", 1)
    return (marker != "") & ((has_o != has_c) | (has_o & has_c & ~inner.rlike(_BRACKET_HOST_RE)))


def fold_dots(segs: Column) -> Column:
    """Apply '.' and '..' segments ('..' at the root is ignored) and join with '/'."""
    empty = F.array().cast("array<string>")
    folded = F.aggregate(
        segs, empty,
        lambda acc, x: F.when(
            x == "..",
            F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc),
        ).when(x == ".", acc).otherwise(F.concat(acc, F.array(x))),
    )
    tail_dir = F.element_at(segs, -1).isin(".", "..")
    return F.array_join(F.when(tail_dir, F.concat(folded, F.array(F.lit("")))).otherwise(folded), "/")


def _decode(c: Column) -> Column:
    """``unquote_plus``: '+' is a space, bad escapes stay literal."""
    fixed = F.regexp_replace(c, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(fixed), c)


def _encode(c: Column) -> Column:
    """``quote_plus``: keeps ``A-Za-z0-9_.-~``, space as '+', the rest %XX of UTF-8."""
    return F.regexp_replace(F.regexp_replace(F.url_encode(c), r"\*", "%2A"), "%7E", "~")


def clean_query(q: Column, prefixes=TRACKING_PARAM_PREFIXES) -> Column:
    """Split pairs on '&' (blank values kept, empty items dropped), drop
    tracking keys by decoded-key prefix, re-encode in the original order."""
    items = F.filter(F.split(q, "&"), lambda x: x != "")
    raw = F.transform(items, lambda x: F.struct(
        F.regexp_extract(x, r"^([^=]*)", 1).alias("k"),
        F.regexp_extract(x, r"(?s)^[^=]*=(.*)$", 1).alias("v")))
    dec = F.transform(raw, lambda p: F.struct(_decode(p["k"]).alias("k"), _decode(p["v"]).alias("v")))
    kept = F.filter(dec, lambda p: ~starts_with_any(p["k"], prefixes)) if prefixes else dec
    enc = F.transform(kept, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"])))
    return F.when(q == "", F.lit("")).otherwise(F.array_join(enc, "&"))


def resolve_dots(bpath: Column, hpath: Column) -> Column:
    """Merge a reference path holding '.'/'..' segments with the base path.

    An absolute reference path is folded on its own; a relative one is
    appended to the base directory (the base path without its last segment),
    empty segments between the first and the last are dropped, then folded.
    Only evaluated for references that have such segments."""
    stages: list[Stage] = [
        {"hparts": lambda g: F.split(g("hpath"), "/"),
         "bparts": lambda g: F.split(g("bpath"), "/")},
        {"segs0": lambda g: F.when(g("hpath").startswith("/"), g("hparts")).otherwise(F.concat(
            F.when(F.element_at(g("bparts"), -1) == "", g("bparts"))
             .otherwise(F.slice(g("bparts"), 1, F.size(g("bparts")) - 1)),
            g("hparts")))},
        {"segs": lambda g: F.when(g("hpath").startswith("/"), g("segs0"))
            .otherwise(F.filter(g("segs0"), lambda x, i: (x != "") | (i == 0)
                                | (i == F.size(g("segs0")) - 1)))},
        {"out": lambda g: fold_dots(g("segs"))},
    ]
    return chain(stages, {"bpath": bpath, "hpath": hpath}, ["out"])["out"]


BASE_FIELDS = ["bs", "b3", "b5", "bpath", "bad_b"]

# Fast paths, compiled string functions only; every other href takes the
# stages.  Only printable-ASCII hrefs without '#' or ';' on a plain http(s)
# page URL qualify:
#  * site-relative: "/path" with no dot segment -> scheme://host of the page
#    + the path with '//' collapsed;
#  * folder-relative: "path" with no dot segment and no ':' before its first
#    '/' -> scheme://host + the page's folder + the path, '//' collapsed;
#  * absolute: "http(s)://host/path" with no user info or brackets (dot
#    segments stay as written, as they do for such references);
#  * either may carry a query of key=value pairs of unreserved characters:
#    decoding and re-encoding leave such pairs as they are, so dropping the
#    tracking keys is one regexp_replace.
# (Java regex is slow on large negated Unicode classes, so the checks use
# instr/substring_index and one positive ASCII class.)
_SAFE = r"A-Za-z0-9_.~\-"
_SAFE_QUERY_RE = r"^[" + _SAFE + r"]+=[" + _SAFE + r"]*(?:&[" + _SAFE + r"]+=[" + _SAFE + r"]*)*\z"
_PRINTABLE_ASCII_RE = r"^[\x21-\x7E]+\z"
_DOT_SEGMENT_Z_RE = r"(?:^|/)\.{1,2}(?:/|\z)"


def _drop_tracking_safe(q: Column, prefixes) -> Column:
    """Tracking keys out of a query of plain key=value pairs."""
    if not prefixes:
        return q
    alt = "|".join(re.escape(p) for p in prefixes)
    dropped = F.regexp_replace(F.regexp_replace(q, r"(?:^|&)(?:" + alt + r")[^&]*", ""), "^&", "")
    return F.when(q == "", q).otherwise(dropped)


def _collapse_cheap(p: Column) -> Column:
    return F.when(F.instr(p, "//") > 0, collapse_slashes(p)).otherwise(p)


def _with_query(q: Column) -> Column:
    return F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit(""))


def fast_result(prefix: Column, base_dir: Column, href: Column, prefixes) -> Column:
    """The normalised URL when a fast path applies, else NULL.

    ``prefix`` and ``base_dir`` are ``fast_base_prefix``/``fast_base_dir`` of
    the page URL (NULL when the page URL is not plain)."""
    h = href
    qpos = F.instr(h, "?")
    before_q = F.substring_index(h, "?", 1)
    query = F.when(qpos > 0, F.substr(h, qpos + 1, F.length(h))).otherwise(F.lit(""))
    eligible = (prefix.isNotNull() & h.rlike(_PRINTABLE_ASCII_RE) & (F.instr(h, "#") == 0)
                & (F.instr(h, ";") == 0) & ((query == "") | query.rlike(_SAFE_QUERY_RE)))
    q = _with_query(_drop_tracking_safe(query, prefixes))
    no_dots = ~((F.instr(before_q, ".") > 0) & before_q.rlike(_DOT_SEGMENT_Z_RE))
    # relative to the site: "/path"
    is_rel = h.startswith("/") & ~h.startswith("//") & no_dots
    rel = F.concat(prefix, _collapse_cheap(before_q), q)
    # relative to the page's folder: "path" (no ':' before the first '/', so
    # it cannot be read as a scheme)
    is_doc_rel = ((before_q != "") & ~h.startswith("/")
                  & (F.instr(F.substring_index(before_q, "/", 1), ":") == 0) & no_dots)
    doc_rel = F.concat(prefix, _collapse_cheap(F.concat(base_dir, before_q)), q)
    # absolute: "scheme://host/path"
    scheme = F.lower(F.substring_index(before_q, "://", 1))
    after = F.substr(before_q, F.length(scheme) + 4, F.length(before_q))
    host = F.substring_index(after, "/", 1)
    path = _collapse_cheap(F.substr(after, F.length(host) + 1, F.length(after)))
    is_abs = (scheme.isin("http", "https") & (host != "") & (F.instr(host, "@") == 0)
              & (F.instr(host, "[") == 0) & (F.instr(host, "]") == 0))
    absolute = F.concat(scheme, F.lit("://"), F.lower(host),
                        F.when(path == "", F.lit("/")).otherwise(path), q)
    return (F.when(~eligible, F.lit(None).cast("string"))
            .when(is_rel, rel)
            .when(is_abs, absolute)
            .when(is_doc_rel, doc_rel))


def _plain_base(base: Column) -> tuple[Column, Column, Column, Column]:
    """(plain?, scheme, host, rest after the host) of a page URL.

    Plain: starts with http:// or https:// (any case), no tab/CR/LF anywhere
    and no bracket in the authority."""
    scheme = F.lower(F.substring_index(base, "://", 1))
    after = F.substr(base, F.length(scheme) + 4, F.length(base))
    host = F.substring_index(F.substring_index(F.substring_index(after, "/", 1), "?", 1), "#", 1)
    plain = (scheme.isin("http", "https") & (F.instr(base, "\t") == 0) & (F.instr(base, "\r") == 0)
             & (F.instr(base, "\n") == 0) & (F.instr(host, "[") == 0) & (F.instr(host, "]") == 0))
    rest = F.substr(after, F.length(host) + 1, F.length(after))
    return plain, scheme, host, rest


def fast_base_prefix(base: Column) -> Column:
    """``scheme://host`` of a plain http(s) page URL, else NULL."""
    plain, scheme, host, _ = _plain_base(base)
    return F.when(plain, F.concat(scheme, F.lit("://"), F.lower(host)))


def fast_base_dir(base: Column) -> Column:
    """The folder of a plain page URL's path, up to and including its last
    '/' ('/' for an empty path); NULL for other URLs and for paths with dot segments."""
    plain, _, _, rest = _plain_base(base)
    path = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    folder = F.substr(path, F.lit(1), F.length(path) - F.length(F.substring_index(path, "/", -1)))
    # dots in the page's own path are left to the stages
    return F.when(plain & ~path.rlike(_DOT_SEGMENT_RE), F.when(folder == "", F.lit("/")).otherwise(folder))


def base_stages(base: str = "base") -> list[Stage]:
    """Stages that parse the page URL (shared by all of a page's anchors)."""
    ex = lambda src, i: (lambda g: F.regexp_extract(g(src), _URL_RE, i))
    return [
        {"b_c": lambda g: pre_clean(g(base))},
        {f"b{i}": ex("b_c", i) for i in range(1, 6)},
        {"bs": lambda g: F.lower(g("b1")),
         "bpath": lambda g: drop_last_params(g("b4")),
         "bad_b": lambda g: bad_netloc(g("b2"), g("b3"))},
    ]


def href_stages(prefixes=TRACKING_PARAM_PREFIXES, href: str = "href") -> list[Stage]:
    """Stages from ``href`` and the base fields (``BASE_FIELDS``) to ``norm``."""
    ex = lambda src, i: (lambda g: F.regexp_extract(g(src), _URL_RE, i))
    return [
        {"h_s": lambda g: py_strip(g(href))},
        {"h_c": lambda g: pre_clean(g("h_s")),
         "skip": lambda g: g(href).isNull() | (g(href) == "")
            | starts_with_any(g("h_s"), SKIPPED_HREF_PREFIXES)},
        {f"h{i}": ex("h_c", i) for i in range(1, 6)},
        {"hs": lambda g: F.lower(g("h1")),
         "hpath": lambda g: drop_last_params(g("h4")),
         "base_only": lambda g: g("h4").isin("", ";"),
         "bad_h": lambda g: bad_netloc(g("h2"), g("h3"))},
        {"eff": lambda g: F.when(g("hs") != "", g("hs")).otherwise(g("bs")),
         # an explicit other scheme, or an authority, makes the reference absolute as written
         "own": lambda g: ((g("hs") != "") & (g("hs") != g("bs"))) | (g("h3") != "")},
        {"fold": lambda g: ~g("own") & ~g("base_only") & (g("hpath").rlike(_DOT_SEGMENT_RE)
            | (~g("hpath").startswith("/") & g("bpath").rlike(_DOT_SEGMENT_RE))),
         "net": lambda g: F.lower(F.when(g("own"), g("h3")).otherwise(g("b3"))),
         "query": lambda g: F.when(~g("own") & g("base_only") & (g("h5") == ""), g("b5"))
            .otherwise(g("h5")),
         "drop": lambda g: g("skip") | ~g("eff").isin("http", "https") | g("bad_b")
            | (g("own") & g("bad_h"))},
        {"path": lambda g: F.when(g("own"), g("hpath"))
            .when(g("base_only"), g("bpath"))
            .when(g("fold"), resolve_dots(g("bpath"), g("hpath")))
            .when(g("hpath").startswith("/"), g("hpath"))
            .otherwise(F.concat(F.regexp_extract(g("bpath"), r"(?s)^(.*/)", 1), g("hpath"))),
         "q2": lambda g: clean_query(g("query"), prefixes)},
        {"p1": lambda g: collapse_slashes(g("path"))},
        {"p2": lambda g: F.when(g("p1") == "", F.lit("/"))
            .when((g("net") != "") & ~g("p1").startswith("/"), F.concat(F.lit("/"), g("p1")))
            .otherwise(g("p1"))},
        {"norm": lambda g: F.when(g("drop"), _null_str()).otherwise(F.concat(
            g("eff"), F.lit(":"),
            F.when(g("net") != "", F.concat(F.lit("//"), g("net"), g("p2")))
             .when(g("p2").startswith("/"), F.concat(F.lit("//"), g("p2")))
             .otherwise(g("p2")),
            F.when(g("q2") != "", F.concat(F.lit("?"), g("q2"))).otherwise(F.lit(""))))},
    ]


def normalize_stages(prefixes=TRACKING_PARAM_PREFIXES, base: str = "base",
                     href: str = "href") -> list[Stage]:
    """All stages from inputs ``base`` and ``href`` to output ``norm``.

    The base stages depend on nothing from the href side and the first href
    stages on nothing from the base side, so they share levels."""
    b, h = base_stages(base), href_stages(prefixes, href)
    return [{**b[i], **h[i]} for i in range(len(b))] + h[len(b):]


def with_normalized_url(df: DataFrame, base: Column | str, href: Column | str,
                        out: str = "normalized_url", prefixes=TRACKING_PARAM_PREFIXES) -> DataFrame:
    """Add ``out``: the absolute, normalised URL of ``href`` on page ``base`` (NULL when dropped)."""
    by_name = isinstance(base, str) and isinstance(href, str)
    build = lambda: normalized_url(F.col(base) if isinstance(base, str) else base,
                                   F.col(href) if isinstance(href, str) else href, prefixes)
    value = _memo(("rows", base, href, tuple(prefixes or ())), build) if by_name else build()
    # Computed in a projection (compiled), then passed through a one-element
    # explode: a filter on the result stays above the generator, so the
    # optimizer never copies the normaliser into a pushed-down filter (which
    # would compute it twice, and grow without bound when a normalised column
    # is normalised again).
    tmp = "__normalized_url"
    keep = [F.col(c) for c in df.columns if c != out]
    staged = df.select(*keep, value.alias(tmp))
    return staged.select(*keep, F.explode(F.array(F.col(tmp))).alias(out))


def normalized_url(base: Column, href: Column, prefixes=TRACKING_PARAM_PREFIXES) -> Column:
    """The normalised URL of ``href`` on page ``base`` as one column expression."""
    full = chain(normalize_stages(prefixes), {"base": base, "href": href}, ["norm"])["norm"]
    # coalesce evaluates the stages only where no fast path applies
    fast = fast_result(fast_base_prefix(base), fast_base_dir(base), href, prefixes)
    return F.coalesce(fast, full)


def normalize_in_array(arr: Column | str, base: Column | str, href_field: str = "href",
                       out_field: str = "normalized_url", prefixes=TRACKING_PARAM_PREFIXES) -> Column:
    """Add field ``out_field`` to every struct of ``arr`` (one page's anchors).

    The page URL is parsed once per page and shared by all its anchors.
    """
    build = lambda: _normalize_in_array(F.col(arr) if isinstance(arr, str) else arr,
                                        F.col(base) if isinstance(base, str) else base, href_field, out_field, prefixes)
    if isinstance(arr, str) and isinstance(base, str):
        return _memo(("array", arr, base, href_field, out_field, tuple(prefixes or ())), build)
    return build()


def _normalize_in_array(arr: Column, base: Column, href_field: str, out_field: str,
                        prefixes) -> Column:
    hst = href_stages(prefixes, href=href_field)
    parsed_base = chain(base_stages("__base"), {"__base": base}, BASE_FIELDS)
    page = F.struct(parsed_base.alias("p"), fast_base_prefix(base).alias("prefix"),
                    fast_base_dir(base).alias("dir"))

    def per_page(b: Column) -> Column:
        def per_anchor(x: Column) -> Column:
            env = {f: b["p"][f] for f in BASE_FIELDS}
            env[href_field] = x[href_field]
            full = chain(hst, env, ["norm"])["norm"]
            fast = fast_result(b["prefix"], b["dir"], x[href_field], prefixes)
            return x.withField(out_field, F.coalesce(fast, full))
        return F.transform(arr, per_anchor)
    return let(page, per_page)


def url_netloc(url: Column) -> Column:
    """Authority of an absolute URL ('' when it has none)."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*:(?://([^/?#]*))?", 1)


def url_host(url: Column) -> Column:
    """Host of an absolute URL: authority without user info and port."""
    return F.regexp_extract(url_netloc(url), r"^(?:.*@)?(\[[^\]]*\]|[^:]*)", 1)


def is_external(normalized_url: Column, root_domain: str, strict: bool = False) -> Column:
    """Whether a normalised link leaves the site.

    Parity mode (default) keeps the original test: the authority, port
    included, does not end with the root domain.  ``strict=True`` compares the
    port-less host for equality or a sub-domain.
    """
    if strict:
        host = url_host(normalized_url)
        inside = (host == root_domain) | host.endswith("." + root_domain)
    else:
        inside = url_netloc(normalized_url).endswith(root_domain)
    return F.when(normalized_url.isNull(), F.lit(None).cast("boolean")).otherwise(~inside)
