"""Anchor extraction from HTML (X1..X4): an Arrow UDF over whole pages.

Per page it returns every ``<a>`` element in document order as
``struct<pos int, href string, text string, rels array<string>>``:

* ``href``: the first ``href`` attribute in the anchor's subtree, the anchor
  itself first (``.//@href``);
* ``text``: all text under the anchor, entities decoded, not yet
  whitespace-normalised (that is a native expression, ``normalize_space``);
* ``rels``: every ``rel`` attribute in the subtree, in document order.

Tree rules: comments and the bodies of ``script``/``style`` are not markup; a
new ``<a>`` ends an open one; a start tag first ends the open elements on top
that its row of ``_ENDS`` names (``<td>`` ends ``td``, ``<div>`` ends ``p`` ...);
an end tag ends every element opened after its matching start tag, unless one
of those ranks higher (``</a>`` does not end a ``div``), in which case it is
ignored; void elements have no content; end of input ends all.
The parser is Python's stdlib ``html.parser``; Spark partitions the pages and
each task parses its own batch.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

ANCHOR_TYPE = T.ArrayType(T.StructType([
    T.StructField("pos", T.IntegerType()),
    T.StructField("href", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("rels", T.ArrayType(T.StringType())),
]))

# --- fixed values: HTML void elements (no end tag, no content).
_VOID = frozenset({
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
    "param", "source", "track", "wbr", "keygen", "frame", "basefont", "isindex",
})

# --- fixed values: which open elements a start tag ends while they are on top (optional end tags).
_BLOCKS = ("address", "article", "aside", "blockquote", "center", "dir", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3",
           "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul")
_ENDS: dict[str, frozenset[str]] = {
    **{tag: frozenset({"p"}) for tag in _BLOCKS},
    "li": frozenset({"li", "p"}),
    "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"}),
    "option": frozenset({"option"}), "optgroup": frozenset({"option", "optgroup"}),
    "rp": frozenset({"rp", "rt"}), "rt": frozenset({"rp", "rt"}),
    "body": frozenset({"head"}),
    "table": frozenset({"p", "a"}), "fieldset": frozenset({"p", "a"}),
    "td": frozenset({"td", "th", "p", "a"}), "th": frozenset({"td", "th", "p", "a"}),
    "tr": frozenset({"tr", "td", "th", "p", "a", "caption", "colgroup"}),
    **{tag: frozenset({"thead", "tbody", "tfoot", "tr", "td", "th", "p", "a", "caption", "colgroup"})
       for tag in ("thead", "tbody", "tfoot")},
}

# --- fixed values: an end tag ends no element of a higher rank; elements not named rank 100.
_RANK = {"div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180, "tfoot": 180, "table": 190,
         "head": 200, "body": 200, "html": 220}


class _AnchorScan(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[dict] = []
        self.stack: list[str] = []
        self.open: dict[str, int] = {}   # open elements per tag
        self.cur: dict | None = None
        self.depth = 0

    def updatepos(self, i: int, j: int) -> int:
        # line/column bookkeeping is never read here; skipping it saves ~8 %
        return j

    def _close(self) -> None:
        a = self.cur
        self.found.append((len(self.found) + 1, a["href"], "".join(a["text"]), a["rels"]))
        self.cur = None

    def _take(self, attrs) -> None:
        seen = set()
        for name, value in attrs:
            if name in seen:          # a repeated attribute keeps its first value
                continue
            seen.add(name)
            if name == "href" and self.cur["href"] is None:
                self.cur["href"] = value if value is not None else ""
            elif name == "rel":
                self.cur["rels"].append(value if value is not None else "")

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            if self.cur is not None:
                self._cut(self.depth)
                self._close()
            self.depth = len(self.stack)
            self._push("a")
            self.cur = {"href": None, "text": [], "rels": []}
            self._take(attrs)
            return
        ends = _ENDS.get(tag)
        if ends:
            self._end_top(ends)
        if self.cur is not None:
            self._take(attrs)
        if tag not in _VOID:
            self._push(tag)

    def _end_top(self, tags):
        """End the elements on top that are among ``tags``."""
        at = len(self.stack)
        while at and self.stack[at - 1] in tags:
            at -= 1
        if at < len(self.stack):
            self._cut(at)
            if self.cur is not None and at <= self.depth:
                self._close()

    def _push(self, tag):
        self.stack.append(tag)
        self.open[tag] = self.open.get(tag, 0) + 1

    def _cut(self, depth):
        """Pop down to ``depth`` elements; each element is pushed and popped once."""
        while len(self.stack) > depth:
            self.open[self.stack.pop()] -= 1

    def handle_startendtag(self, tag, attrs):
        if tag == "a":
            self.handle_starttag(tag, attrs)
            self.handle_endtag(tag)
        elif self.cur is not None:
            self._take(attrs)

    def handle_endtag(self, tag):
        if not self.open.get(tag):      # a stray end tag closes nothing
            return
        at, rank = len(self.stack) - 1, _RANK.get(tag, 100)
        while self.stack[at] != tag:
            if _RANK.get(self.stack[at], 100) > rank:
                return
            at -= 1
        self._cut(at)
        if self.cur is not None and len(self.stack) <= self.depth:
            self._close()

    def handle_data(self, data):
        if self.cur is not None:
            self.cur["text"].append(data)

    def finish(self) -> list[tuple]:
        self.close()
        if self.cur is not None:
            self._close()
        return self.found


def _scan(html: str | None) -> list[tuple]:
    """(pos, href, text, rels) of every anchor of one document."""
    if not html or ("<a" not in html and "<A" not in html):
        return []
    scan = _AnchorScan()
    scan.feed(html)
    return scan.finish()


def anchors_of(html: str | None) -> list[dict]:
    """All anchors of one document as dicts (plain Python, for tests and callers)."""
    return [{"pos": p, "href": h, "text": t, "rels": r} for p, h, t, r in _scan(html)]


def anchors_arrow(html: pa.Array) -> pa.Array:
    """Anchors of a batch of documents, built column by column as Arrow arrays
    (no per-anchor Python objects to convert)."""
    offsets, pos, href, text, rel_offsets, rel_values = [0], [], [], [], [0], []
    for doc in html.to_pylist():
        for p, h, t, r in _scan(doc):
            pos.append(p)
            href.append(h)
            text.append(t)
            rel_values.extend(r)
            rel_offsets.append(len(rel_values))
        offsets.append(len(pos))
    rels = pa.ListArray.from_arrays(pa.array(rel_offsets, pa.int32()), pa.array(rel_values, pa.string()))
    items = pa.StructArray.from_arrays(
        [pa.array(pos, pa.int32()), pa.array(href, pa.string()), pa.array(text, pa.string()), rels],
        names=["pos", "href", "text", "rels"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)


@F.arrow_udf(ANCHOR_TYPE)
def extract_anchors(html: pa.Array) -> pa.Array:
    return anchors_arrow(html)
