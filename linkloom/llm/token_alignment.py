"""Cross-tokenizer alignment by merge-path partitioning, with corpus-wide counts of linked token ids.

Space + text is encoded by a byte-level tokenizer (A) and by a piece
tokenizer (B).  Byte offsets where a token of A and one of B both end cut the
tokens into groups; all pairs of a group are links.  The ends of many texts
lie on one line of offsets.  Diagonals at equal distances split the merge of
the two sorted lists into pieces of equal work, each found by binary search
and independent of the others; a piece emits the common ends it sees, and
boundaries join what a group has on both sides of a piece's edge.

Neither tokenizer joins anything over a space between two other characters:
A's first step always splits before it, and no piece of B holds a space after
another character (checked on loading; texts are encoded whole otherwise, or
if they hold one of the few characters that libraries disagree about as white
space).  So texts are encoded stretch by stretch between such spaces, and a
worker keeps the ids of stretches it has seen.

Counting: every task deals its documents into blocks of bounded size and sums,
per block, how many documents hold each linked id pair; Spark sums the blocks.
The totals go back to a block once for each of its distinct pairs, and each
block's documents look theirs up there.  So no row per document and pair is
shuffled, and the count table is never held as a whole.

Defined results: a null or empty text, or one whose tokens of A or B do not
spell space + text byte by byte, has no tokens: zeros and an empty hash
column; special tokens' strings are plain text; repeated rows count as
documents each; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
from array import array
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from linkloom.llm.common import materialize

PIECE = 8192            # merged ends a piece handles
BLOCK = 400_000         # pairs of documents in a block (a single document may exceed it)
TEXTS = 400             # texts encoded at once
TEXT_BYTES = 1_500_000  # and their characters, unless a single text is longer
KEPT = 400_000          # stretches a worker process keeps the ids of (a full store is emptied)
KEPT_CHARS = 40         # and their length
SPLIT = re.compile(r"(?<=\S) (?=\S)")
DISPUTED = re.compile("[\x1c-\x1f\x85\u180e]")  # white space for some libraries only
WIDE = 1024             # links from which a group is paired by its distinct ids


# ---------------------------------------------------------------- tokenizers

class Tokenizers:
    """Both tokenizers with the bytes and the decimal name of every id."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        self.bytes_a = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode()
                        for t in map(self.a.id_to_token, range(self.a.get_vocab_size()))]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.sizes = [np.array([len(x) for x in t], dtype=np.int64) for t in (self.bytes_a, self.bytes_b)]
        self.splits = all("▁" not in p.lstrip("▁") for p in map(self.b.id_to_piece, range(self.b.get_piece_size())))
        self.ids_a: dict[str, bytes] = {}
        self.ids_b: dict[str, bytes] = {}
        self.odd: set[str] = set()  # kept stretches that either tokenizer spells otherwise
        self.names = [np.array([f"{i}{end}" for i in range(max(len(self.bytes_a), len(self.bytes_b)))], dtype=object)
                      for end in (",", "|", ";")]

    @classmethod
    def of_process(cls, path_a: str, path_b: str) -> Tokenizers:
        """The tokenizers of this worker process, kept from task to task."""
        held = vars(sys.modules.setdefault("_tokenizers_of_process", ModuleType("_tokenizers_of_process")))
        if (path_a, path_b) not in held:
            held[path_a, path_b] = cls(path_a, path_b)
        return held[path_a, path_b]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and of B per text; none where either does not spell space + text."""
        kept = self.ids_a, self.ids_b
        if len(self.ids_a) > KEPT:
            for d in kept:
                d.clear()
            self.odd.clear()
        rows = [SPLIT.split(t) if self.splits and not DISPUTED.search(t) else [t] if t else [] for t in texts]
        new = list(set().union(*rows) - self.ids_a.keys())
        for lo in range(0, len(new), 20_000):
            some = new[lo:lo + 20_000]
            ids_a = [e.ids for e in self.a.encode_batch([" " + c for c in some], add_special_tokens=False)]
            ids_b = self.b.encode(some, num_threads=1)
            for d, ids in zip(kept, (ids_a, ids_b)):
                d.update(zip(some, [array("i", x).tobytes() for x in ids]))
            self.odd.update(c for c, x, y in zip(some, ids_a, ids_b) if not c or not (
                b"".join([self.bytes_a[i] for i in x]) == (" " + c).encode("utf-8", "surrogatepass")
                == b"".join([self.bytes_b[i] for i in y])))
        good = [row if self.odd.isdisjoint(row) else [] for row in rows]
        out = tuple([np.frombuffer(b"".join(map(d.__getitem__, row)), dtype=np.intc).astype(np.int64) for row in good] for d in kept)
        for c in new:
            if len(c) > KEPT_CHARS:
                self.odd.discard(c)
                for d in kept:
                    del d[c]
        return out


def byte_letters() -> dict[str, int]:
    """The letters byte-level vocabularies use: printable bytes are themselves, the others follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


# ---------------------------------------------------------------- merge path

def diagonal_cuts(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of ``a`` and of ``b`` lie before every ``piece``-th step of their merge (a first on ties)."""
    steps = np.r_[np.arange(0, len(a) + len(b), piece), len(a) + len(b)]
    low, high = np.maximum(steps - len(b), 0), np.minimum(steps, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        across = np.maximum(steps - mid - 1, 0)
        more = open_ & (a[np.minimum(mid, len(a) - 1)] <= b[np.minimum(across, len(b) - 1)])
        low = np.where(more, mid + 1, low)
        high = np.where(open_ & ~more, mid, high)
    return low, steps - low


def common_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Places after every end that ``a`` and ``b`` (rising) share, in order."""
    if not len(a) or not len(b):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    cut_a, cut_b = diagonal_cuts(a, b, piece)
    after_a, after_b = [], []
    for i0, i1, j0, j1 in zip(cut_a[:-1], cut_a[1:], cut_b[:-1], cut_b[1:]):
        if i0 and j0 < j1 and a[i0 - 1] == b[j0]:  # a tie over the edge: its b comes first here
            after_a.append(np.array([i0]))
            after_b.append(np.array([j0 + 1]))
        mine, other = a[i0:i1], b[j0:j1]
        if len(mine) and len(other):
            at = np.searchsorted(other, mine)
            same = np.flatnonzero(other[np.minimum(at, len(other) - 1)] == mine)
            after_a.append(same + i0 + 1)
            after_b.append(at[same] + j0 + 1)
    return (np.concatenate(after_a) if after_a else np.zeros(0, dtype=np.int64),
            np.concatenate(after_b) if after_b else np.zeros(0, dtype=np.int64))


# ---------------------------------------------------------------- documents

def align(tok: Tokenizers, texts: list[str]) -> list[dict]:
    """Per text: numbers of tokens, groups and links, the groups' hash, distinct linked pairs (a * size of B + b) and their links."""
    ids_a, ids_b = tok.encode(texts)
    n_a, n_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (ids_a, ids_b))
    all_a, all_b = np.concatenate(ids_a), np.concatenate(ids_b)
    to_a, to_b = common_ends(np.cumsum(tok.sizes[0][all_a]), np.cumsum(tok.sizes[1][all_b]))
    from_a, from_b = np.r_[0, to_a[:-1]].astype(np.int64)[:len(to_a)], np.r_[0, to_b[:-1]].astype(np.int64)[:len(to_b)]
    many_a, many_b = to_a - from_a, to_b - from_b
    doc_of_group = np.searchsorted(np.cumsum(n_a), to_a)
    n_groups = np.bincount(doc_of_group, minlength=len(texts))
    n_links = np.zeros(len(texts), dtype=np.int64)
    np.add.at(n_links, doc_of_group, many_a * many_b)

    # the groups as text: every id with what follows it, a group's A before its B
    line = np.empty(len(all_a) + len(all_b), dtype=object)
    group_a, group_b = np.repeat(np.arange(len(to_a)), many_a), np.repeat(np.arange(len(to_b)), many_b)
    at_a, at_b = np.arange(len(all_a)) + from_b[group_a], np.arange(len(all_b)) + to_a[group_b]
    line[at_a] = tok.names[0][all_a]
    line[at_b] = tok.names[0][all_b]
    line[at_a[to_a - 1]] = tok.names[1][all_a[to_a - 1]]
    line[at_b[to_b - 1]] = tok.names[2][all_b[to_b - 1]]

    doc, pair, links = _pairs(len(tok.bytes_b), all_a, all_b, from_a, from_b, many_a, many_b, doc_of_group)
    ends = np.cumsum(n_a + n_b)
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    out = []
    for k in range(len(texts)):
        if not n_a[k]:
            out.append(dict(n_a=0, n_b=0, n_groups=0, n_links=0, groups_sha256="", pairs=[], links=[]))
            continue
        groups = "".join(line[ends[k] - n_a[k] - n_b[k]:ends[k]].tolist())[:-1]
        out.append(dict(n_a=int(n_a[k]), n_b=int(n_b[k]), n_groups=int(n_groups[k]), n_links=int(n_links[k]),
                        groups_sha256=hashlib.sha256(groups.encode()).hexdigest(),
                        pairs=pair[cut[k]:cut[k + 1]], links=links[cut[k]:cut[k + 1]]))
    return out


def _pairs(base, all_a, all_b, from_a, from_b, many_a, many_b, doc_of_group):
    """Distinct (document, id pair) in order, with their numbers of links."""
    size = many_a * many_b
    small = np.flatnonzero(size <= WIDE)
    # a small group's pairs one by one: the link's place in its group gives its A and its B
    group = np.repeat(small, size[small])
    place = np.arange(len(group)) - np.repeat(np.cumsum(size[small]) - size[small], size[small])
    a = all_a[from_a[group] + place // many_b[group]]
    b = all_b[from_b[group] + place % many_b[group]]
    docs, pairs, counts = [doc_of_group[group]], [a * base + b], [np.ones(len(group), dtype=np.int64)]
    for g in np.flatnonzero(size > WIDE):
        xa, ca = np.unique(all_a[from_a[g]:from_a[g] + many_a[g]], return_counts=True)
        xb, cb = np.unique(all_b[from_b[g]:from_b[g] + many_b[g]], return_counts=True)
        docs.append(np.full(len(xa) * len(xb), doc_of_group[g]))
        pairs.append((xa[:, None] * base + xb[None, :]).ravel())
        counts.append((ca[:, None] * cb[None, :]).ravel())
    doc, pair, count = np.concatenate(docs), np.concatenate(pairs), np.concatenate(counts)
    order = np.lexsort((pair, doc))
    doc, pair, count = doc[order], pair[order], count[order]
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])]) if len(doc) else np.zeros(0, dtype=np.int64)
    return doc[new], pair[new], np.add.reduceat(count, new) if len(new) else count


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for hi, text in enumerate(texts):
        if hi > lo and (hi - lo == TEXTS or size + len(text or "") > TEXT_BYTES):
            yield lo, hi
            lo, size = hi, 0
        size += len(text or "")
    if texts:
        yield lo, len(texts)


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Written rows of two kinds, by block: documents (counts, hash, pairs, links) and a block's pairs with their documents."""
    doc_id = docs.schema["doc_id"].dataType
    schema = (f"block long, doc boolean, doc_id {doc_id.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS)
              + ", groups_sha256 string, pairs array<long>, links array<long>")
    arrow = pa.schema([("block", pa.int64()), ("doc", pa.bool_()), ("doc_id", to_arrow_type(doc_id)),
                       *[(c, pa.int64()) for c in COUNTS], ("groups_sha256", pa.string()),
                       ("pairs", pa.list_(pa.int64())), ("links", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext

        tok = Tokenizers.of_process(path_a, path_b)
        block, held, size = TaskContext.get().partitionId() << 32, [], 0

        def close() -> Iterator[pa.RecordBatch]:
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            for lo in range(0, len(pairs), 50_000):
                yield pa.RecordBatch.from_pylist([{"block": block, "doc": False, "pairs": pairs[lo:lo + 50_000],
                                                   "links": n[lo:lo + 50_000]}], schema=arrow)

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in _chunks(texts):
                rows = align(tok, [t or "" for t in texts[lo:hi]])
                yield pa.RecordBatch.from_pylist([{"block": block, "doc": True, "doc_id": d, **r} for d, r in zip(ids[lo:hi], rows)],
                                                 schema=arrow)
                held += [r["pairs"] for r in rows if len(r["pairs"])]
                size += sum(len(r["pairs"]) for r in rows)
                if size >= BLOCK:
                    yield from close()
                    block, held, size = block + 1, [], 0
        if held:
            yield from close()

    return materialize(docs.select("doc_id", "text").mapInArrow(run, schema), "aligned")


def pair_counts(blocks: DataFrame, base: int) -> DataFrame:
    """pair, count (documents that hold it linked), top (no pair of its A id has more)."""
    counts = materialize(blocks.where("not doc").select(F.explode(F.arrays_zip("pairs", "links")).alias("x"))
                         .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.links").alias("count")), "pair-counts")
    a = F.floor(F.col("pair") / base).alias("a")
    most = counts.groupBy(a).agg(F.max("count").alias("most"))  # a row per id of A: the vocabulary bounds the broadcast
    return (counts.select("pair", "count", a).join(F.broadcast(most), "a")
            .select("pair", "count", (F.col("count") == F.col("most")).alias("top")))


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    from sentencepiece import SentencePieceProcessor

    base = SentencePieceProcessor(model_file=path_b).get_piece_size()
    blocks = aligned_blocks(docs, path_a, path_b)
    known = (blocks.where("not doc").select(F.col("block").alias("of"), F.explode("pairs").alias("pair"))
             .join(pair_counts(blocks, base), "pair"))
    id_type = docs.schema["doc_id"].dataType
    schema = (f"doc_id {id_type.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS)
              + ", n_best long, count_sum long, groups_sha256 string")

    def look_up(rows: pa.Table, table: pa.Table) -> pa.Table:
        pairs = table.column("pair").to_numpy()
        order = np.argsort(pairs)
        lists = rows.column("pairs").combine_chunks()
        links = np.asarray(rows.column("links").combine_chunks().flatten(), dtype=np.int64)
        at = order[np.searchsorted(pairs, np.asarray(lists.flatten(), dtype=np.int64), sorter=order)]
        ends = np.r_[0, np.cumsum(np.asarray(lists.value_lengths(), dtype=np.int64))]
        sums = [np.r_[0, np.cumsum(x)] for x in (links * table.column("top").to_numpy()[at], links * table.column("count").to_numpy()[at])]
        best, total = (pa.array(x[ends[1:]] - x[ends[:-1]]) for x in sums)
        return pa.table([rows.column("doc_id"), *[rows.column(c) for c in COUNTS], best, total, rows.column("groups_sha256")],
                        names=["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"])

    return (blocks.where("doc").select("block", "doc_id", *COUNTS, "groups_sha256", "pairs", "links").groupBy("block")
            .cogroup(known.groupBy("of")).applyInArrow(look_up, schema))
