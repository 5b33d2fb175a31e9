"""Packing of token sequences into a window by non-negative least squares.

A document of L tokens becomes L // W whole windows and a rest.  The rest is
cut once per level into digits to base 16 (for W = 4096: multiples of 256, of
16, and of 1), so that every level packs lengths 1..15 into a window of 16:
the multisets of lengths filling it are 230 strategies, and the histogram of
a level is 15 numbers whatever the corpus size.  Non-negative least squares
gives how often each strategy is used; counts are rounded down and the
residual is packed greedily.  Filled windows of one level are pieces of
length one for the level above.  Pieces that no strategy can fill are cut
into powers of two, which always fill, so only the last sequence is padded.

Tokenising, cutting and placing are map-only; the driver sees histograms.

Defined results: null text is empty (one end token); repeated rows are
packed separately; an empty table gives an empty result; other columns are
ignored; texts of any length are tokenised whole.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, repeat
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import body, materialize

BASE = 16
LEVELS = 3
WINDOW = BASE ** LEVELS
CACHE_WORDS = 700_000  # cached words per worker process (memory bound; a full cache keeps the words met again, if few enough)
TEXTS = 1000           # texts tokenised at once

PIECES = ("part int, doc_id {id}, doc_tokens long, start array<long>, length array<long>, cls array<int>, "
          "rank array<long>, crc array<long>, bit_crc array<array<long>>")


# ---------------------------------------------------------------- strategies

def strategies(window: int = BASE) -> np.ndarray:
    """Every multiset of lengths 1..window-1 that sums to ``window``, one per row."""
    found: list[list[int]] = []

    def extend(counts: list[int], largest: int, left: int) -> None:
        if left == 0:
            found.append(counts.copy())
            return
        for size in range(min(largest, left), 0, -1):
            counts[size - 1] += 1
            extend(counts, size, left - size)
            counts[size - 1] -= 1

    extend([0] * (window - 1), window - 1, window)
    return np.array(found, dtype=np.int64)


def nnls(a: np.ndarray, b: np.ndarray, limit: int = 400) -> np.ndarray:
    """Least squares with x >= 0 by the active-set method."""
    x = np.zeros(a.shape[1])
    free = np.zeros(a.shape[1], dtype=bool)
    scale = max(1.0, float(np.abs(b).max(initial=0.0)))
    for _ in range(limit):
        slope = a.T @ (b - a @ x)
        slope[free] = -np.inf
        j = int(np.argmax(slope))
        if slope[j] <= 1e-9 * scale:
            break
        free[j] = True
        while True:
            trial = np.zeros_like(x)
            trial[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            if trial[free].min() > 0:
                x = trial
                break
            bad = free & (trial <= 0)
            step = np.min(x[bad] / np.maximum(x[bad] - trial[bad], 1e-300))
            x = x + step * (trial - x)
            free &= x > 1e-12 * scale
            x[~free] = 0
            if not free.any():
                break
    return x


@dataclass
class Level:
    """How one level's pieces map to its windows.

    ``kinds``: pieces of length c used whole, then the power-of-two parts of
    pieces that had to be cut.  For kind k, ``ends[k]`` are running totals of
    pieces per strategy, and per strategy the pieces of k in one window, the
    first window, and the first offset.
    """

    whole: np.ndarray                      # pieces of class c (1..15) used whole
    windows: int                           # filled windows
    tail: int                              # units in the unfilled rest
    rules: dict = field(default_factory=dict)
    part_base: dict = field(default_factory=dict)  # (power, class) -> first index among parts of that power


def plan_level(counts: np.ndarray, table: np.ndarray) -> Level:
    """``counts[c-1]`` pieces of length c; ``table`` from :func:`strategies`."""
    left = counts.astype(np.int64).copy()
    solved = nnls(table.T.astype(float), counts.astype(float))
    rules: dict[int, list[tuple[int, int, int, int]]] = {}
    windows = 0

    def use(combo: dict[int, int], repeats: int) -> None:
        nonlocal windows
        offset = 0
        for kind in sorted(combo, key=lambda k: (-_units(k), k)):
            rules.setdefault(kind, []).append((repeats, combo[kind], windows, offset))
            offset += combo[kind] * _units(kind)
        windows += repeats

    for k in np.argsort(-solved, kind="stable"):
        need = table[k]
        used = need > 0
        repeats = int(min(np.floor(solved[k] + 1e-6), (left[used] // need[used]).min()))
        if repeats > 0:
            left = left - repeats * need
            use({int(c) + 1: int(need[c]) for c in np.flatnonzero(need)}, repeats)
    cut = np.zeros_like(left)
    while left.any():  # greedy: largest first, as often as the pieces last
        combo, room = _greedy({c + 1: int(left[c]) for c in range(len(left))})
        largest = max(combo)
        if room:
            cut[largest - 1] = left[largest - 1]
            left[largest - 1] = 0
            continue
        repeats = min(int(left[c - 1]) // m for c, m in combo.items())
        for c, m in combo.items():
            left[c - 1] -= repeats * m
        use(combo, repeats)
    whole = counts.astype(np.int64) - cut
    part_base, parts = {}, {}
    for power in (8, 4, 2, 1):
        total = 0
        for c in range(1, BASE):
            if c & power:
                part_base[power, c] = total
                total += int(cut[c - 1])
        parts[-power] = total
    while True:
        combo, room = _greedy(parts)
        if room:
            break
        repeats = min(parts[k] // m for k, m in combo.items())
        for k, m in combo.items():
            parts[k] -= repeats * m
        use(combo, repeats)
    tail = 0
    for kind in (-8, -4, -2, -1):
        if parts[kind]:
            rules.setdefault(kind, []).append((1, parts[kind], -1, tail))
            tail += parts[kind] * -kind
    packed = {}
    for kind, rows in rules.items():
        r = np.array(rows, dtype=np.int64)
        packed[kind] = (np.cumsum(r[:, 0] * r[:, 1]), r)
    return Level(whole, windows, tail, packed, part_base)


def _units(kind: int) -> int:
    return abs(kind)


def _greedy(have: dict[int, int]) -> tuple[dict[int, int], int]:
    """Largest pieces first into one window: what was taken, and the room left."""
    room, combo = BASE, {}
    for kind in sorted(have, key=lambda k: -_units(k)):
        n = min(have[kind], room // _units(kind))
        if n:
            combo[kind] = n
            room -= n * _units(kind)
    return combo, room


def locate(level: Level, kind: int, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Window (-1: the unfilled rest) and unit offset of pieces ``index`` of a kind."""
    ends, rows = level.rules[kind]
    k = np.searchsorted(ends, index, side="right")
    repeats, each, first, offset = rows[k].T
    at = index - (ends[k] - repeats * each)
    window = np.where(first < 0, -1, first + at // each)
    return window, offset + (at % each) * _units(kind)


@dataclass
class Plan:
    levels: list[Level]      # from single tokens up to whole windows
    counts: np.ndarray       # per level, pieces of each class from documents
    full: int                # windows filled by one document alone

    def place(self, depth: int, kind: int, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and token offset for pieces ``index`` of ``kind`` at a level."""
        window, offset = locate(self.levels[depth], kind, index)
        scale = BASE ** depth
        sequence = np.empty(len(index), dtype=np.int64)
        token = offset * scale
        rest = window < 0
        sequence[rest] = self.levels[-1].windows + self.full
        token[rest] += sum(lv.tail * BASE ** d for d, lv in enumerate(self.levels) if d > depth)
        inner = ~rest
        if inner.any():
            if depth + 1 == len(self.levels):
                sequence[inner] = window[inner]
            else:
                up = self.counts[depth + 1, 0] + window[inner]
                lv = self.levels[depth + 1]
                for sel, k, idx in _split(lv, 1, up):
                    rows = np.flatnonzero(inner)[sel]
                    s, t = self.place(depth + 1, k, idx)
                    sequence[rows] = s
                    token[rows] += t
        return sequence, token


def _split(level: Level, cls: int, rank: np.ndarray):
    """(rows, kind, index) for pieces of a class of power-of-two length: whole or as their one part."""
    whole = rank < level.whole[cls - 1]
    if whole.any():
        yield np.flatnonzero(whole), cls, rank[whole]
    if not whole.all():
        yield np.flatnonzero(~whole), -cls, rank[~whole] - level.whole[cls - 1] + level.part_base[cls, cls]


def make_plan(counts: np.ndarray, full: int) -> Plan:
    """``counts[d, c-1]``: pieces of c units of 16**d tokens."""
    table = strategies()
    levels, filled = [], 0
    for d in range(LEVELS):
        n = counts[d].copy()
        n[0] += filled
        levels.append(plan_level(n, table))
        filled = levels[-1].windows
    return Plan(levels, counts, full)


# ---------------------------------------------------------------- tokens

class WordCache:
    """Ids of texts, word by word; a word is encoded once per worker process.

    White space only separates words for this tokeniser (its normaliser maps
    runs to one space, which its splitter drops) and case is folded, so a
    text's ids are those of its words in order.  Texts with a separator that
    only Arrow takes for white space, or with what may be a special token, are
    encoded whole.
    """

    ODD = "[\x1c-\x1f]|<\\|"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    @classmethod
    def of_process(cls, path: str) -> WordCache:
        """The cache of this worker process, kept from task to task."""
        held = sys.modules.setdefault("_word_ids_of_process", ModuleType("_word_ids_of_process"))
        if path not in vars(held):
            vars(held)[path] = cls(path)
        return vars(held)[path]

    @staticmethod
    def forget() -> None:
        """Free this worker process's caches: all texts are tokenised."""
        sys.modules.pop("_word_ids_of_process", None)

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, dtype="<u4")
        self.ends = np.zeros(1 << 14, dtype=np.int64)  # ends[k]: where word k's ids end; word 0 is empty
        self.again = np.zeros(1 << 14, dtype=bool)     # whether a later batch held word k too
        self.number[""] = 0

    def drop_single(self) -> None:
        """Forget the words of one batch only; all words if more than half of the room would stay taken."""
        names, old, ids = list(self.number), self.ends, self.ids
        kept = np.flatnonzero(self.again[:len(names)])
        kept = kept[kept > 0]
        self.clear()
        if not 0 < len(kept) <= CACHE_WORDS // 2:
            return
        n = old[kept] - old[kept - 1]
        ends = np.cumsum(n)
        self.ids = ids[np.arange(int(ends[-1])) + np.repeat(old[kept - 1] - (ends - n), n)]
        if not len(self.ids):
            self.ids = np.zeros(1, dtype="<u4")
        self.ends = np.r_[0, ends].astype(np.int64)
        self.again = np.zeros(len(kept) + 1, dtype=bool)
        self.number.update(zip([names[k] for k in kept.tolist()], range(1, len(kept) + 1)))

    def _add(self, words: list[str]) -> None:
        k, at = len(self.number), int(self.ends[len(self.number) - 1])
        for lo in range(0, len(words), 10_000):
            some = words[lo:lo + 10_000]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            n = np.array([len(f) for f in found], dtype=np.int64)
            ends = at + np.cumsum(n)
            while len(self.ids) < ends[-1]:
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            while len(self.ends) < k + len(some):
                self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
                self.again = np.concatenate([self.again, np.zeros_like(self.again)])
            self.ids[at:ends[-1]] = np.fromiter(chain.from_iterable(found), dtype="<u4", count=int(n.sum()))
            self.ends[k:k + len(some)] = ends
            self.number.update(zip(some, range(k, k + len(some))))
            k, at = k + len(some), int(ends[-1])

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of every text."""
        if len(self.number) > CACHE_WORDS:
            self.drop_single()
        odd = pc.match_substring_regex(texts, self.ODD)
        plain = pc.ascii_lower(pc.if_else(odd, pa.scalar("", texts.type), texts))
        words = pc.utf8_split_whitespace(plain)
        flat = words.flatten().dictionary_encode()
        names = flat.dictionary.to_pylist()
        known = np.fromiter(map(self.number.get, names, repeat(-1)), dtype=np.int64, count=len(names))
        new = np.flatnonzero(known < 0)
        self.again[known[known >= 0]] = True
        known[new] = len(self.number) + np.arange(len(new))
        self._add([names[i] for i in new.tolist()])
        number = known[flat.indices.to_numpy()]
        stop = self.ends[number]
        start = np.where(number > 0, self.ends[np.maximum(number - 1, 0)], stop)
        n = stop - start
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.arange(total) + np.repeat(start - (ends - n), n)]
        word_ends = words.offsets.to_numpy()
        cuts = np.r_[0, ends][word_ends - word_ends[0]]
        out = [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        for r in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            out[r] = np.array(self.tokenizer.encode(texts[r].as_py(), add_special_tokens=False).ids, dtype="<u4")
        return out


def cut_document(ids: bytes, window: int = WINDOW):
    """(start, length, class) of a document's pieces; class 0: a whole window, else 16 * level + digit."""
    n = len(ids) // 4
    out = [(s, window, 0) for s in range(0, n - n % window, window)]
    at, unit = n - n % window, window // BASE
    for depth in range(LEVELS - 1, -1, -1):
        digit = (n - at) // unit
        if digit:
            out.append((at, digit * unit, BASE * depth + digit))
            at += digit * unit
        unit //= BASE
    return out


def _bit_crcs(ids: bytes, start: int, cls: int) -> list[int]:
    """Checksums of a piece's power-of-two parts, longest first."""
    digit, unit = cls % BASE, BASE ** (cls // BASE)
    out = []
    for power in (8, 4, 2, 1):
        if digit & power:
            out.append(zlib.crc32(ids[4 * start:4 * (start + power * unit)]))
            start += power * unit
    return out


def cut_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """One row a document: its pieces, their checksums and their rank within (task, class)."""
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        cache, end = WordCache.of_process(tokenizer_path), np.array([end_id], dtype="<u4").tobytes()
        seen = [0] * (BASE * LEVELS)
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS):
                some = batch.slice(lo, TEXTS)
                rows = {k: [] for k in ("doc_tokens", "start", "length", "cls", "rank", "crc", "bit_crc")}
                for own in cache.batch(some.column(1)):
                    ids = own.tobytes() + end
                    pieces = cut_document(ids)
                    rows["doc_tokens"].append(len(ids) // 4)
                    rows["start"].append([p[0] for p in pieces])
                    rows["length"].append([p[1] for p in pieces])
                    rows["cls"].append([p[2] for p in pieces])
                    ranks = []
                    for _, _, c in pieces:
                        ranks.append(seen[c])
                        seen[c] += 1
                    rows["rank"].append(ranks)
                    rows["crc"].append([zlib.crc32(ids[4 * s:4 * (s + n)]) for s, n, _ in pieces])
                    rows["bit_crc"].append([_bit_crcs(ids, s, c) if c else [] for s, _, c in pieces])
                many = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * some.num_rows, pa.int32()), some.column(0),
                     pa.array(rows["doc_tokens"], pa.int64()), pa.array(rows["start"], many),
                     pa.array(rows["length"], many), pa.array(rows["cls"], pa.list_(pa.int32())),
                     pa.array(rows["rank"], many), pa.array(rows["crc"], many),
                     pa.array(rows["bit_crc"], pa.list_(many))],
                    names=["part", "doc_id", "doc_tokens", "start", "length", "cls", "rank", "crc", "bit_crc"])

    return (docs.select("doc_id", body().alias("text"))
            .mapInArrow(run, PIECES.format(id=id_type.simpleString())))


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = materialize(cut_pieces(docs, tokenizer_path, end_id), "pieces")
    per_part = pieces.select("part", F.explode("cls").alias("cls")).groupBy("part", "cls").count()
    earlier = Window.partitionBy("cls").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = (per_part.withColumn("before", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
             .groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("cls", "before"))).alias("before")))
    totals = {r["cls"]: int(r["n"]) for r in
              per_part.groupBy("cls").agg(F.sum("count").alias("n")).collect()}  # at most 46 rows
    counts = np.array([[totals.get(BASE * d + c, 0) for c in range(1, BASE)] for d in range(LEVELS)], dtype=np.int64)
    plan = make_plan(counts, totals.get(0, 0))
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        WordCache.forget()
        for batch in batches:
            for lo in range(0, batch.num_rows, 2 * TEXTS):
                yield place_batch(batch.slice(lo, 2 * TEXTS), plan)

    schema = (f"doc_id {id_type.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long")
    return pieces.join(shift, "part").mapInArrow(run, schema)


def place_batch(batch: pa.RecordBatch, plan: Plan) -> pa.RecordBatch:
    col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
    row = np.repeat(np.arange(batch.num_rows), np.diff(col["cls"].offsets.to_numpy()))
    flat = {k: col[k].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            for k in ("start", "length", "cls", "rank", "crc")}
    part = col["part"].to_numpy()
    kinds, first = np.unique(part, return_index=True)
    shift = np.zeros((len(kinds), BASE * LEVELS), dtype=np.int64)
    for i, r in enumerate(first.tolist()):
        for c, n in col["before"][r].as_py():
            shift[i, c] = n
    rank = flat["rank"] + shift[np.searchsorted(kinds, part)[row], flat["cls"]]
    bits = col["bit_crc"].flatten()
    out: list[tuple[np.ndarray, ...]] = []

    full = np.flatnonzero(flat["cls"] == 0)
    if len(full):
        out.append((row[full], flat["start"][full], flat["length"][full], flat["crc"][full],
             plan.levels[-1].windows + rank[full], np.zeros(len(full), dtype=np.int64)))
    for cls in np.unique(flat["cls"]):
        if cls == 0:
            continue
        depth, digit = divmod(int(cls), BASE)
        level, unit = plan.levels[depth], BASE ** depth
        at = np.flatnonzero(flat["cls"] == cls)
        whole = rank[at] < level.whole[digit - 1]
        w = at[whole]
        if len(w):
            sequence, offset = plan.place(depth, digit, rank[w])
            out.append((row[w], flat["start"][w], flat["length"][w], flat["crc"][w], sequence, offset))
        p = at[~whole]
        if len(p):
            start = flat["start"][p].copy()
            own = bits.take(pa.array(p)).to_pylist()
            for k, power in enumerate(q for q in (8, 4, 2, 1) if digit & q):
                index = rank[p] - level.whole[digit - 1] + level.part_base[power, digit]
                sequence, offset = plan.place(depth, -power, index)
                length = np.full(len(p), power * unit, dtype=np.int64)
                crc = np.array([b[k] for b in own], dtype=np.int64)
                out.append((row[p], start.copy(), length, crc, sequence, offset))
                start += length
    rows, start, length, crc, sequence, offset = (np.concatenate(x) for x in zip(*out))
    take = pa.array(rows)
    return pa.RecordBatch.from_arrays(
        [col["doc_id"].take(take), pa.array(start), pa.array(length), pa.array(crc), col["doc_tokens"].take(take),
         pa.array(sequence), pa.array(offset)],
        names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
