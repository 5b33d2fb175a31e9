"""Main text of pages by deducing each host's template from equivalence classes of tokens.

Tokens are the tags of containers and the words of text blocks, both told
apart by their path from the root (tag and class names).  Over a host's pages
every token has an occurrence vector: its count on each page, kept as a sum of
hashes.  Tokens with equal vectors form an equivalence class.  A class of two
or more tokens that covers four fifths of the host's pages (four at least) is
valid, since words of articles practically never share their counts over so
many pages.  Valid classes nest along the paths of their tags; together they
are the template.  A block is the template's if every word of it is on four
fifths of the pages and most of them lie in valid classes; all other blocks
fill its slots, and every slot's text is kept.

What a slot is for is read from the page and weighed with the host's counts:

* navigation, asides, footers, forms, dialogs, headers outside articles,
  hidden elements and their roles are never main text;
* a container whose class or id names a menu, an advert, comments ... is left
  out unless it holds half of the host's text or more and no article lies
  outside it; a name that only contains such a word (``related-work``) counts
  only where half of its text is links;
* on pages without an article or main element, lists that are nearly all
  links are left out;
* of a page with article (else main) elements, text outside them is left out.

A page whose text would be gone, or whose main text would lose more than nine
tenths to the template (a host of copies), keeps what the template took.

Pages are parsed once, into a table of their blocks.  Few tokens are on four
fifths of a host's pages, so vectors are kept for those alone that may be:
per host, pages are first counted by ``SLOTS`` slots of token hashes, and a
token is on no more pages than its slot, so leaving out the tokens of rarer
slots loses none.  Slots and vectors are summed before any shuffle, so a host
with a third of all pages is no hot group; a host's template is one row, no
larger than about one page.

Defined results: null html is empty text; null urls are one host; repeated
rows repeat; an empty table gives an empty result; extra columns are ignored;
unclosed elements run to the end of the page, stray end tags are ignored, a
tag cut off at the end of the page is dropped.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import materialize
from linkloom.llm.words import WordHashes, hash64

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[a-zA-Z/!?][^>]*\Z", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?")
_SPACE = re.compile(r"[ \t\n\r\f\v ]+")

RAW = {"script", "style", "noscript", "template", "iframe", "svg", "select", "textarea", "button", "object", "title"}
LISTS = {"ul", "ol", "dl", "table"}
CONTAINERS = LISTS | {"html", "head", "body", "div", "section", "article", "main", "nav", "aside", "header", "footer", "form",
                      "thead", "tbody", "tfoot", "figure", "details", "dialog", "fieldset", "center"}
BREAKS = CONTAINERS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "td", "th", "caption", "blockquote",
                       "pre", "hr", "address", "figcaption", "summary", "option", "legend"}
OUT_TAGS = {"head", "nav", "aside", "footer", "form", "dialog", "fieldset"}
OUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert"}
HINTS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "banner",
         "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "footer", "masthead", "cookie",
         "cookies", "consent", "notice", "notices", "alert", "popup", "modal", "newsletter", "subscribe", "comment",
         "comments", "share", "sharing", "social", "related", "widget"}
COVER = 0.8      # share of a host's pages a template token is on
LEAST_PAGES = 4
HALF = 0.5
ALL_LINKS = 0.8
LEAST_LEFT = 0.1
HELD = 100_000   # tokens a task sums before it hands them on
HELD_HOSTS = 500  # hosts whose slots a task sums before it hands them on
SLOTS = 2048


@dataclass
class Block:
    """A stretch of text without a block break; ``regions``: (kind, path) of hinted containers and lists around it."""

    path: str
    raw: list[str] = field(default_factory=list)
    link_chars: int = 0
    links: int = 0
    out: bool = False
    article: bool = False
    main: bool = False
    regions: tuple[tuple[str, str], ...] = ()
    text: str = ""


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), value.strip("\"'"))
    return found


def _marks(tag: str, raw: str) -> tuple[str, bool, str]:
    """Name of a container in paths, whether it is never main text, and its hint: "named", "contains" or ""."""
    found = _attributes(raw) if raw.strip() else {}
    names = f"{found.get('class', '')} {found.get('id', '')}".lower().split()
    label = re.sub(r"\d+", "0", ".".join(found.get("class", "").split()))[:60]
    out = (tag in OUT_TAGS or found.get("role", "").lower() in OUT_ROLES or "hidden" in found
           or found.get("aria-hidden", "").lower() == "true" or "display:none" in re.sub(r"\s", "", found.get("style", "").lower()))
    hint = "named" if HINTS.intersection(names) else ""
    if not hint and any(HINTS.intersection(re.split(r"[_\-]+", n)) for n in names):
        hint = "contains"
    return f"{tag}.{label}" if label else tag, out, hint


def page_blocks(html: str) -> tuple[list[Block], dict[str, int]]:
    """The page's blocks in order, and how often each container path opens."""
    tags: dict[str, int] = {}
    blocks: list[Block] = []
    stack: list[tuple[str, str, bool, tuple]] = []  # tag, path, out, regions
    depth: dict[str, int] = {}
    current: Block | None = None
    block_tag, in_link, at = "", False, 0

    def add(raw: str) -> None:
        nonlocal current
        if current is None:
            _, path, out, regions = stack[-1] if stack else ("", "", False, ())
            current = Block(f"{path}/{block_tag}", out=out, article=bool(depth.get("article")), main=bool(depth.get("main")),
                            regions=regions)
        current.raw.append(raw)
        if in_link:
            current.link_chars += len(raw.strip())

    def finish() -> None:
        nonlocal current
        if current is not None:
            text = _SPACE.sub(" ", unescape("".join(current.raw)))
            current.text = " ".join(text.split())
            if current.text:
                blocks.append(current)
            current = None

    while True:
        m = _TOKEN.search(html, at)
        stop = m.start() if m else len(html)
        if stop > at:
            add(html[at:stop])
        if not m:
            finish()
            return blocks, tags
        at = m.end()
        if m.group(2) is None:
            continue
        tag, ends = m.group(2).lower(), bool(m.group(1))
        if tag in RAW:
            if not ends and not m.group(3).endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if tag == "a":
            in_link = not ends
            if in_link and current is not None:
                current.links += 1
            elif in_link:
                add("")
                current.links += 1
            continue
        if tag in BREAKS:
            finish()
            block_tag = "" if tag in CONTAINERS or ends else tag
        elif tag == "br":
            add(" ")
        if tag not in CONTAINERS:
            continue
        if ends:
            if depth.get(tag):
                while stack:
                    name = stack.pop()[0]
                    depth[name] -= 1
                    if name == tag:
                        break
        elif not m.group(3).endswith("/"):
            label, out, hint = _marks(tag, m.group(3))
            _, above, above_out, regions = stack[-1] if stack else ("", "", False, ())
            path = f"{above}/{label}" if above else label
            if hint or tag in LISTS:
                regions = (*regions, (hint or "list", path))
            out = out or above_out or tag == "header" and not depth.get("article")
            stack.append((tag, path, out, regions))
            depth[tag] = depth.get(tag, 0) + 1
            tags[path] = tags.get(path, 0) + 1


def _host(url: str | None) -> str:
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", url or "")
    return m.group(1).lower() if m else ""


def pack_blocks(blocks: list[Block], tags: dict[str, int]) -> bytes:
    """Blocks and tags of a page as compressed JSON behind its length."""
    kinds: dict[tuple, int] = {}
    rows = [(kinds.setdefault((b.path, b.regions), len(kinds)), b.out, b.article, b.main, b.link_chars, b.links, b.text) for b in blocks]
    raw = json.dumps([tags, list(kinds), rows], ensure_ascii=False, separators=(",", ":")).encode("utf-8", "surrogatepass")
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack_blocks(packed: bytes) -> tuple[list[Block], dict[str, int]]:
    raw = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)
    tags, kinds, rows = json.loads(raw.decode("utf-8", "surrogatepass"))
    kinds = [(path, tuple(map(tuple, regions))) for path, regions in kinds]
    return [Block(kinds[k][0], [], link_chars, links, out, article, main, kinds[k][1], text)
            for k, out, article, main, link_chars, links, text in rows], tags


class Tokens:
    """63-bit token hashes: a path's and a word's, exclusive or."""

    def __init__(self) -> None:
        self.words, self.paths = WordHashes(), WordHashes()

    def of_page(self, blocks: list[Block], tags: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct tokens of a page and how often each is on it."""
        texts = [b.text.split() for b in blocks]
        words = self.words.array([w for ws in texts for w in ws])
        paths = np.repeat(self.paths.array([b.path for b in blocks]), [len(ws) for ws in texts])
        opens = self.words.array(["<"]) ^ self.paths.array(list(tags))
        tokens, n = np.unique((words ^ paths) >> np.uint64(1), return_counts=True)
        return (np.concatenate([tokens, opens >> np.uint64(1)]).astype(np.int64),
                np.concatenate([n, np.array(list(tags.values()), dtype=np.int64)]))

    def constant(self, block: Block, common: frozenset, valid: frozenset) -> bool:
        """Whether every word of a block is common, and most are of valid classes."""
        words, inside = block.text.split() if common else [], 0
        for lo in range(0, len(words), 16):
            for token in ((self.words.array(words[lo:lo + 16]) ^ self.paths.array([block.path])) >> np.uint64(1)).tolist():
                if token not in common:
                    return False
                inside += token in valid
        return bool(words) and 2 * inside > len(words)


def region_sums(blocks: list[Block]) -> tuple[dict[str, list[int]], int]:
    """Per region [text, text in links, links, pages with an article outside it]; text that may be main."""
    regions: dict[str, list[int]] = {}
    chars = 0
    for b in blocks:
        if b.out:
            continue
        chars += len(b.text)
        for kind, path in set(b.regions):
            r = regions.setdefault(f"{kind} {path}", [0, 0, 0, 0])
            r[0] += len(b.text)
            r[1] += min(b.link_chars, len(b.text))
            r[2] += b.links
    for name, r in regions.items():
        path = tuple(name.split(" ", 1))
        r[3] = int(any((b.article or b.main) and not b.out and path not in b.regions for b in blocks))
    return regions, chars


def parsed_pages(pages: DataFrame) -> DataFrame:
    """A row per page (host, blocks), and rows of sums: per host and region ('' is the host), and per host the pages of its slots."""
    kind = pages.schema["page_id"].dataType.simpleString()
    schema = (f"page_id {kind}, url string, host string, blocks binary, region string, pages long, chars long, link_chars long, "
              "links long, others long, slots array<short>, counts array<int>")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        sums: dict[tuple[str, str], list[int]] = {}
        hits: dict[str, np.ndarray] = {}

        def rows(types: list[pa.DataType], n: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], t) if c in columns
                                               else pa.nulls(n, t) for c, t in zip(names, types)], names=names)

        def flush(types):
            yield rows(types, len(sums), host=[h for h, _ in sums], region=[r for _, r in sums],
                       **{c: [v[i] for v in sums.values()] for i, c in enumerate(names[5:10])})
            found = {h: np.flatnonzero(c) for h, c in hits.items()}
            yield rows(types, len(hits), host=list(hits), slots=[x.tolist() for x in found.values()],
                       counts=[hits[h][x].tolist() for h, x in found.items()])
            sums.clear()
            hits.clear()

        types = None
        for batch in (whole.slice(lo, 500) for whole in batches for lo in range(0, whole.num_rows, 500)):
            types = [batch.schema.field(0).type, pa.string(), pa.string(), pa.binary(), pa.string(), *[pa.int64()] * 5,
                     pa.list_(pa.int16()), pa.list_(pa.int32())]
            hosts, packed = [], []
            for url, html in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                host = _host(url)
                blocks, tags = page_blocks(html or "")
                hosts.append(host)
                packed.append(pack_blocks(blocks, tags))
                hit = np.zeros(SLOTS, dtype=bool)
                hit[tokens.of_page(blocks, tags)[0] % SLOTS] = True
                if host not in hits:
                    hits[host] = np.zeros(SLOTS, dtype=np.int32)
                hits[host] += hit
                regions, chars = region_sums(blocks)
                for region, values in (*regions.items(), ("", [chars, 0, 0, 0])):
                    s = sums.setdefault((host, region), [0, 0, 0, 0, 0])
                    s[0] += 1
                    for i, v in enumerate(values):
                        s[1 + i] += v
                if len(hits) > HELD_HOSTS or len(sums) > HELD:
                    yield from flush(types)
            yield rows(types, batch.num_rows, page_id=batch.column(0), url=batch.column(1), host=hosts, blocks=packed)
        if types:
            yield from flush(types)

    return pages.select("page_id", "url", "html").mapInArrow(run, schema)


def _may_cover(pages: str) -> Column:
    return (F.col(pages) >= LEAST_PAGES) & (F.col(pages) >= COVER * F.col("all_pages"))


def occurrence_vectors(parsed: DataFrame, hosts: DataFrame) -> DataFrame:
    """Per host and token that may be on most of the host's pages: pages and vector hash."""
    schema = "host string, token long, pages long, vector long"
    counted = parsed.where("slots is not null").select("host", F.explode(F.arrays_zip("slots", "counts")).alias("at"))
    slots = (counted.groupBy("host", "at.slots").agg(F.sum("at.counts").alias("on")).join(hosts, "host").where(_may_cover("on"))
             .groupBy("host").agg(F.collect_list("slots").alias("open")))  # SLOTS at most
    # a small table's size lets Spark send it to the pages; a large one meets them in a shuffle
    joined = (parsed.where("blocks is not null").select("url", "host", "blocks")
              .join(materialize(slots, "host-slots"), "host").select("url", "host", "blocks", "open"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, known = Tokens(), {}
        sums: dict[tuple[str, int], list[int]] = {}

        def flush():
            keys = [pa.array(c, t) for c, t in zip(list(zip(*sums)) or [(), ()], (pa.string(), pa.int64()))]
            values = [pa.array([r[i] for r in sums.values()], pa.int64()) for i in range(2)]
            sums.clear()
            return pa.RecordBatch.from_arrays([*keys, *values], names=["host", "token", "pages", "vector"])

        for batch in (whole.slice(lo, 500) for whole in batches for lo in range(0, whole.num_rows, 500)):
            for k, (url, host, packed) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(3)))):
                if host not in known:
                    if len(known) > HELD_HOSTS:
                        known.clear()
                    known[host] = np.zeros(SLOTS, dtype=bool)
                    known[host][batch.column(3)[k].as_py()] = True
                page = hash64(f"{url}".encode("utf-8", "surrogatepass"))
                found, n = tokens.of_page(*unpack_blocks(packed))
                may = known[host][found % SLOTS]
                for token, times in zip(found[may].tolist(), n[may].tolist()):
                    s = sums.setdefault((host, token), [0, 0])
                    s[0] += 1
                    s[1] += hash((page, times)) & 0xFFFFFFFF
                if len(sums) > HELD:
                    yield flush()
        yield flush()

    return joined.mapInArrow(run, schema).groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.sum("vector").alias("vector"))


def host_templates(parsed: DataFrame) -> DataFrame:
    """host, common (tokens on most pages), valid (those in valid classes), left_out (regions); ``parsed``: of ``parsed_pages``."""
    regions = materialize(parsed.where("region is not null").groupBy("host", "region")
                          .agg(*[F.sum(c).alias(c) for c in ("pages", "chars", "link_chars", "links", "others")]), "regions")
    hosts = regions.where("region = ''").select("host", F.col("pages").alias("all_pages"), F.col("chars").alias("all_chars"))
    frequent = occurrence_vectors(parsed, hosts).join(hosts, "host").where(_may_cover("pages"))
    classes = frequent.groupBy("host", "vector").agg(F.collect_list("token").alias("tokens"))  # tokens of about one page
    template = classes.groupBy("host").agg(
        F.flatten(F.collect_list("tokens")).alias("common"),
        F.flatten(F.collect_list(F.when(F.size("tokens") >= 2, F.col("tokens")))).alias("valid"))
    kind = F.substring_index("region", " ", 1)
    linked = F.col("link_chars") / F.greatest("chars", F.lit(1))
    gone = (((kind == "named") & ((F.col("others") >= HALF * F.col("pages")) | (F.col("chars") < HALF * F.col("all_chars"))))
            | ((kind == "contains") & (linked >= HALF))
            | ((kind == "list") & (linked >= ALL_LINKS) & (F.col("links") >= 3 * F.col("pages"))))
    left_out = (regions.where("region != ''").join(hosts, "host").where(gone)
                .groupBy("host").agg(F.collect_list("region").alias("left_out")))
    return template.join(left_out, "host", "full")


def main_text(blocks: list[Block], tokens: Tokens, common: frozenset = frozenset(), valid: frozenset = frozenset(),
              left_out: frozenset = frozenset()) -> str:
    """Text of the blocks that fill the template's slots and belong to the main text, a block a line."""
    blocks = [b for b in blocks if not b.out]
    inside = [b for b in blocks if b.article] or [b for b in blocks if b.main]
    kept = [b for b in inside or blocks
            if not any(f"{kind} {path}" in left_out for kind, path in b.regions if kind != "list" or not inside)]
    slots = [b for b in kept if not tokens.constant(b, common, valid)]
    if sum(len(b.text) for b in slots) < LEAST_LEFT * sum(len(b.text) for b in kept):
        slots = kept
    return "\n".join(b.text for b in slots or inside or blocks)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    parsed = materialize(parsed_pages(pages), "parsed-pages", compression="zstd")
    joined = (parsed.where("blocks is not null").select("page_id", "url", "host", "blocks")
              .join(materialize(host_templates(parsed), "templates"), "host", "left")
              .select("page_id", "url", "blocks", "host", "common", "valid", "left_out"))
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, known = Tokens(), {}
        for batch in (whole.slice(lo, 500) for whole in batches for lo in range(0, whole.num_rows, 500)):
            texts = []
            for k, (packed, host) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                if host not in known:
                    if len(known) > HELD_HOSTS:
                        known.clear()
                    known[host] = tuple(frozenset(batch.column(4 + i)[k].as_py() or ()) for i in range(3))
                texts.append(main_text(unpack_blocks(packed)[0], tokens, *known[host]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
