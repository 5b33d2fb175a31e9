"""Near-duplicate documents by Order MinHash, verified by banded alignment.

K-mers are five consecutive words, labelled with their occurrence number.
Each of 64 hash functions selects the two least labelled k-mers of a text and
keeps them in text order; each such pick is a band key.  Texts that share a
share J of their k-mers agree on a pick with probability about J squared, so
scattered edits of 20 % of the words (J 0.2) meet in a band with probability
0.92, of 15 % with 0.99, of 10 % practically always (measured in the tests).

A band's members first meet its representative (the member of least number,
which tells nothing of its text); a representative and a member are one row,
however many bands they share.  Then, for some rounds, every representative
that is still apart from a member elects another member, which meets all
members of other components that share a band with both; each round is linear
in the members.  What is then still apart meets in blocks of texts: every two
members of a band that are in different components.  Pairs whose word counts
alone put them over the distance bound (which loses no link) are not aligned,
the others are, in the task that holds both blocks, unless links found there
have joined their components; only the links that join leave the task.  So no
band holds two members that are neither compared nor in one group.  A pair
links if 1 - edit distance / longer length >= 0.8 in words, computed in the
diagonal band that threshold allows.  Groups are connected components.

Defined results: equal texts are one group whatever their length; null reads
as empty; texts under five words are one k-mer; texts without words group
only with equal texts; rows equal in doc_id and text are one document, kept
once; a group keeps its least (doc_id, content hash), nulls last; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import body, connected_components, fresh, materialize, null_safe, row_key
from linkloom.llm.words import WordHashes, mix, shingle_hashes, words

K = 5
PICKS = 64  # a band each; a power of two, and no more than the bits of a long
SIMILARITY = 0.8
ROUNDS = 3  # of further representatives, before what is left meets in blocks
BLOCK_BYTES = 1 << 20  # texts and word counts of the members of a block, about
BINS_A_WORD = 4
_CELLS = 500_000  # hash values held at once


def occurrence_labelled(h: np.ndarray) -> np.ndarray:
    """Hashes of (k-mer, how often it came before)."""
    ranked = np.sort(h)
    if not (ranked[1:] == ranked[:-1]).any():  # most texts repeat none
        return mix(h ^ mix(np.array([0x9E3779B97F4A7C15], dtype=np.uint64)))
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.r_[True, s[1:] != s[:-1]]
    starts = np.maximum.accumulate(np.where(first, np.arange(len(s)), 0))
    label = np.empty(len(h), dtype=np.uint64)
    label[order] = (np.arange(len(s)) - starts).astype(np.uint64)
    return mix(h ^ mix(label + np.uint64(0x9E3779B97F4A7C15)))


def pick_functions(picks: int = PICKS) -> tuple[np.ndarray, np.ndarray]:
    """Factors and shifts of the hash functions, one a pick."""
    rng = np.random.default_rng(20)
    factor = rng.integers(1, 1 << 63, picks, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factor, rng.integers(0, 1 << 63, picks, dtype=np.uint64)


def order_minhash(kmers: np.ndarray, picks: int = PICKS, functions: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """One value per pick: its two least k-mers, in text order (one k-mer counts twice)."""
    factor, shift = functions or pick_functions(picks)
    out = np.empty(picks, dtype=np.uint64)
    step = max(1, _CELLS // max(1, len(kmers)))
    for lo in range(0, picks, step):
        v = kmers[None, :] * factor[lo:lo + step, None] + shift[lo:lo + step, None]
        v ^= v >> np.uint64(32)
        rows = np.arange(len(v))
        a = v.argmin(axis=1)
        v[rows, a] = np.iinfo(np.uint64).max
        b = v.argmin(axis=1) if len(kmers) > 1 else a
        early, late = np.minimum(a, b), np.maximum(a, b)
        out[lo:lo + step] = mix(mix(kmers[early]) + kmers[late])
    return out


def edit_similarity(a: list, b: list, least: float = SIMILARITY) -> float:
    """1 - edit distance / longer length, or 0.0 where that is below ``least``.

    Bit-parallel dynamic programming over the diagonal band that a distance
    within the threshold cannot leave; equal ends are taken off first.
    """
    longer = max(len(a), len(b))
    if longer == 0:
        return 1.0
    bound = int((1 - least) * longer + 1e-9)
    shorter = min(len(a), len(b))
    lo = 0
    while lo < shorter and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < shorter - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    a, b = a[lo:len(a) - hi], b[lo:len(b) - hi]
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > bound:
        return 0.0
    distance = len(b) if not a else _banded(a, b, bound)
    return 1 - distance / longer if distance <= bound else 0.0


def _banded(a: list, b: list, bound: int) -> int:
    """Edit distance of ``a`` (not longer) and ``b``, or more than ``bound``.

    Column j of the matrix keeps rows j - bound .. j + bound as the bits of
    two integers (vertical steps up and down); the window slides by one row a
    column.  The tracked cell runs down the diagonal to the last row, then
    along it.
    """
    m, n = len(a), len(b)
    bound = min(bound, n)
    width = 2 * bound + 1
    full = (1 << width) - 1
    where: dict = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | (1 << (i + bound))  # row i sits at bit i + bound of an unshifted window
    up = full & ~((1 << bound) - 1) if bound else full   # rows from 0 on rise by one
    down = 0
    centre = 1 << bound
    distance = 0
    for j in range(n):
        # window of column j: bit t is row j - bound + t
        match = (where.get(b[j], 0) >> j) & full
        diagonal = ((((match & up) + up) ^ up) | match | down) & full
        plus = down | (full & ~(diagonal | up))
        minus = diagonal & up
        if j < m:
            distance += not diagonal & centre
        else:
            bit = 1 << (bound - (j - m) - 1)
            if plus & bit:
                distance += 1
            elif minus & bit:
                distance -= 1
        if distance - max(0, n - 1 - max(j, m - 1)) > bound:
            return bound + 1
        shifted = diagonal >> 1
        up = (minus | (full & ~(shifted | plus))) & full
        down = shifted & plus
    return distance


def word_bag(h: np.ndarray) -> np.ndarray:
    """Counts of a text's words by hash in 64 to 16384 bins (a power of two, four a word or more up to there), each at most 255."""
    bins = min(1 << 14, max(64, 1 << (BINS_A_WORD * len(h) - 1).bit_length()))
    return np.minimum(np.bincount((h % np.uint64(bins)).astype(np.int64), minlength=bins), 255).astype(np.uint8)


def _fold(bags: np.ndarray, bins: int) -> np.ndarray:
    """The same counts in fewer bins."""
    while bags.shape[-1] > bins:
        half = bags.shape[-1] // 2
        bags = np.minimum(bags[..., :half].astype(np.uint16) + bags[..., half:], 255).astype(np.uint8)
    return bags


def within_reach(n: int, bag: np.ndarray, lengths: np.ndarray, bags: np.ndarray) -> np.ndarray:
    """Whether word counts let a text of ``n`` words link with each of others; ``bags`` has one row a text.

    An edit takes away at most one word and adds at most one, so the distance
    is not below the words that either text has over the other; merged or cut
    off counts only lower that.
    """
    bins = min(len(bag), bags.shape[1])
    mine, theirs = _fold(bag, bins), _fold(bags, bins)
    both = np.maximum(mine, theirs).sum(axis=1, dtype=np.int64)
    least = both - np.minimum(mine.sum(dtype=np.int64), theirs.sum(axis=1, dtype=np.int64))
    longer = np.maximum(n, lengths)
    bound = ((1 - SIMILARITY) * longer + 1e-9).astype(np.int64)
    return np.maximum(least, np.abs(n - lengths)) <= bound


def sketches(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, key, second (content hashes), picks (empty without words), word count and word bag of every row."""
    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key long, second long, picks array<long>, "
              "n_words int, bag binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, functions = WordHashes(), pick_functions()
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                some = batch.slice(lo, 1000)
                picks, counts, bags = [], [], []
                for text in some.column(3).to_pylist():
                    h = hashes.array(words(text))
                    picks.append(order_minhash(occurrence_labelled(shingle_hashes(h, K)), functions=functions).view(np.int64).tolist()
                                 if len(h) else [])
                    counts.append(len(h))
                    bags.append(word_bag(h).tobytes() if len(h) else b"")
                yield pa.RecordBatch.from_arrays([*[some.column(i) for i in range(3)],
                                                  pa.array(picks, pa.list_(pa.int64())),
                                                  pa.array(counts, pa.int32()), pa.array(bags, pa.binary())],
                                                 names=["doc_id", "key", "second", "picks", "n_words", "bag"])

    return (docs.select("doc_id", F.col(key).alias("key"), F.xxhash64(F.lit(97), body()).alias("second"),
                        body().alias("text")).mapInArrow(run, schema))


def star_pairs(members: DataFrame) -> DataFrame:
    """(a, b, mask): a band's least member a meets every other, b; bit i of ``mask`` is set where they share band i.

    ``members``: bucket (its lowest bits are the band's number, so that a member is in a bucket once), cid.
    """
    heads = (members.groupBy("bucket").agg(F.min("cid").alias("a"), F.max("cid").alias("last"))
             .where("a < last").select("bucket", "a"))
    band = F.col("bucket").bitwiseAND(F.lit(PICKS - 1)).cast("int")
    return (members.join(heads, "bucket").where("cid != a").groupBy("a", F.col("cid").alias("b"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), band)).alias("mask")))


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, similarity) of distinct pairs that reach the threshold; ``texts``: cid, text."""
    wanted = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    side = {c: texts.join(wanted.select(F.col(c).alias("cid")).distinct(), "cid", "left_semi")
            .select(F.col("cid").alias(c), F.col("text").alias(f"t{c}")) for c in "ab"}
    both = wanted.join(side["a"], "a").join(side["b"], "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(lo, 500) for whole in batches for lo in range(0, whole.num_rows, 500)):
            score = [edit_similarity(words(s), words(t))
                     for s, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            keep = pa.array([x > 0 for x in score])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score, pa.float64())],
                                             names=["a", "b", "similarity"]).filter(keep)

    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long, similarity double")


def with_components(near: DataFrame, parts: DataFrame) -> DataFrame:
    """``near`` (a, b, mask) with of_a and of_b, the components of both."""
    of = {c: parts.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")) for c in "ab"}
    return (near.join(of["a"], "a", "left").join(of["b"], "b", "left")
            .select("a", "b", "mask", F.coalesce("of_a", "a").alias("of_a"), F.coalesce("of_b", "b").alias("of_b")))


def placed_stars(near: DataFrame, parts: DataFrame) -> DataFrame:
    return materialize(with_components(near.select("a", "b", "mask"), parts), "placed", compression="zstd")


def open_stars(placed: DataFrame) -> DataFrame:
    """Rows of ``placed`` (a, b, mask, of_a, of_b) whose b shares a band of a with a member of another component.

    A representative has met all its members, so members of one component
    have nothing left to compare, and components only ever grow together.
    """
    per_part = placed.groupBy("a", "of_b").agg(F.bit_or("mask").alias("mask"))
    parts_in = [F.count_if(F.getbit("mask", F.lit(i)) == 1).alias(f"n{i}") for i in range(PICKS)]
    bit = [F.when(F.col(f"n{i}") > 1, F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(i))).otherwise(F.lit(0).cast("long"))
           for i in range(PICKS)]
    live = materialize(per_part.groupBy("a").agg(F.count(F.lit(1)).alias("n"), *parts_in).where("n > 1")
                       .select("a", reduce(lambda x, y: x.bitwiseOR(y), bit).alias("live")).where("live != 0"), "live-bands")
    return materialize(placed.join(live, "a").where(F.col("mask").bitwiseAND(F.col("live")) != 0).select(*placed.columns),
                       "open-stars", compression="zstd")


def open_links(stars: DataFrame, bags: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b) that link members of one band in two components: as many as join all that link, found where the members meet.

    ``stars``: a (representative), b, mask, of_a, of_b, of ``open_stars``; ``bags``: cid, n_words,
    bag; ``texts``: cid, text.  Members outside their representative's
    component meet each other and the members inside it; the latter need no
    comparison among themselves, the representative has met all.  Members that
    share bands with several representatives meet at the least of them.  Two
    blocks that meet give no more links than they have components to join.
    """
    rest = F.col("of_b") != F.col("of_a")
    members = (stars.groupBy(F.col("b").alias("cid"))
               .agg(F.first("of_b").alias("component"), F.collect_list(F.struct("a", "mask", rest.alias("rest"))).alias("stars")))
    whole = materialize(members.join(bags, "cid").join(texts, "cid").withColumn("size", F.length("bag") + F.octet_length("text")),
                        "open-texts", compression="zstd")
    placed = whole.select("*", F.explode("stars").alias("at")).select("at.*", "cid", "component", "n_words", "bag", "text", "stars", "size")
    size = F.col("size").cast("long")
    sides = (whole.select("size", F.explode("stars").alias("at")).select("at.*", "size").groupBy("a")
             .agg(F.sum(F.when(F.col("rest"), size).otherwise(0)).alias("n_rest"),
                  F.sum(F.when(F.col("rest"), 0).otherwise(size)).alias("n_in"))
             .select("a", *[F.ceil(F.col(n) / BLOCK_BYTES).alias(n) for n in ("n_rest", "n_in")]))
    dealt = (placed.join(sides, "a")
             .withColumn("block", F.pmod(F.xxhash64("cid", "a"), F.when(F.col("rest"), F.col("n_rest")).otherwise(F.col("n_in"))))
             .groupBy("a", "rest", "block", "n_rest", "n_in")
             .agg(F.collect_list(F.struct("cid", "component", "mask", "n_words", "bag", "text", "stars")).alias("members")))
    blocks = materialize(dealt, "blocks", compression="zstd")

    def upto(first, n):
        return F.when(n > first, F.sequence(first, n - 1)).otherwise(F.array().cast("array<bigint>"))

    meets = F.concat(F.transform(upto(F.col("block"), F.col("n_rest")), lambda i: F.struct(F.lit(True).alias("rest"), i.alias("block"))),
                     F.transform(upto(F.lit(0).cast("long"), F.col("n_in")), lambda i: F.struct(F.lit(False).alias("rest"), i.alias("block"))))
    left = (blocks.where("rest").select("a", F.col("block").alias("own"), F.col("members").alias("mine"), F.explode(meets).alias("m"))
            .select("a", "own", "mine", "m.rest", "m.block"))
    both = (left.join(blocks.select("a", "rest", "block", "members"), ["a", "rest", "block"])
            .select("a", (F.col("rest") & (F.col("own") == F.col("block"))).alias("same"), "mine", "members"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found = block_links(*(batch.column(i)[k].as_py() for i in range(2)), *(batch.column(i)[k].values for i in (2, 3)))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long").distinct()


def block_links(head: int, same: bool, mine: pa.StructArray, theirs: pa.StructArray) -> list[tuple[int, int]]:
    """Links that join the components of two blocks of members of ``head``'s bands; ``same``: both are one block."""
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while c in parent:
            c = parent[c]
        return c

    sides = (mine, mine if same else theirs)
    cid, component, mask, lengths = ([x.field(c).to_numpy().astype(np.int64) for x in sides] for c in ("cid", "component", "mask", "n_words"))
    fits = ((component[0][:, None] != component[1]) & ((mask[0][:, None] & mask[1]) != 0)
            & (lengths[1] >= SIMILARITY * lengths[0][:, None] - 1) & (lengths[0][:, None] >= SIMILARITY * lengths[1] - 1))
    if same:
        fits &= cid[1] > cid[0][:, None]
    i, j = np.nonzero(fits)
    if not len(i):
        return []
    bags = [x.field("bag").to_pylist() for x in sides]
    near = pairs_within_reach(i, j, lengths, bags)
    split: tuple[dict[int, list[str]], ...] = ({}, {})

    def words_of(side: int, at: int) -> list[str]:
        if at not in split[side]:
            split[side][at] = words(sides[side].field("text")[at].as_py())
        return split[side][at]

    found = []
    for x, y in zip(i[near].tolist(), j[near].tolist()):
        u, v = root(int(component[0][x])), root(int(component[1][y]))
        one, other = int(cid[0][x]), int(cid[1][y])
        if u == v or _met_before(head, one, sides[0].field("stars")[x].as_py(), other, sides[1].field("stars")[y].as_py()):
            continue
        if edit_similarity(words_of(0, x), words_of(1, y)):
            parent[max(u, v)] = min(u, v)
            found.append((min(one, other), max(one, other)))
    return found


def pairs_within_reach(i: np.ndarray, j: np.ndarray, lengths: list[np.ndarray], bags: list[list[bytes]]) -> np.ndarray:
    """Which pairs (i of the first, j of the second texts) word counts let link (see ``within_reach``), a few bins first, then all."""
    keep = np.ones(len(i), dtype=bool)
    bound = ((1 - SIMILARITY) * np.maximum(lengths[0][i], lengths[1][j]) + 1e-9).astype(np.int64)
    sizes = [np.array([len(x) for x in side]) for side in bags]
    common = np.minimum(sizes[0][i], sizes[1][j])
    for bins in np.unique(common).tolist():
        held = []
        for side, size in zip(bags, sizes):
            folded = np.zeros((len(side), bins), dtype=np.uint8)
            for n in np.unique(size[size >= bins]).tolist():
                at = np.flatnonzero(size == n)
                folded[at] = _fold(np.frombuffer(b"".join(side[k] for k in at), dtype=np.uint8).reshape(len(at), n), bins)
            held.append(folded)
        for few in dict.fromkeys((max(64, bins // 8), bins)):
            first, second = (_fold(x, few) for x in held)
            totals = first.sum(axis=1, dtype=np.int64), second.sum(axis=1, dtype=np.int64)
            left = np.flatnonzero(keep & (common == bins))
            step = max(1, _CELLS // few)
            for lo in range(0, len(left), step):
                at = left[lo:lo + step]
                both = np.maximum(first[i[at]], second[j[at]]).sum(axis=1, dtype=np.int64)
                keep[at] = both - np.minimum(totals[0][i[at]], totals[1][j[at]]) <= bound[at]
    return keep


def _met_before(head: int, x: int, at_x: list[dict], y: int, at_y: list[dict]) -> bool:
    """Whether two members meet at a lesser representative than ``head``, or one of them is a representative the other has met."""
    masks = {s["a"]: s["mask"] for s in at_y}
    return x in masks or any(s["a"] == y or s["a"] < head and s["mask"] & masks.get(s["a"], 0) for s in at_x)


def merged_parts(parts: DataFrame, found: DataFrame) -> DataFrame:
    """Components (node, component) after further links; only the graph of the components is walked again."""
    of = {c: parts.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")) for c in "ab"}
    edges = (found.select("a", "b").join(of["a"], "a", "left").join(of["b"], "b", "left")
             .select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))
    up = materialize(connected_components(edges), "joined-parts").select(F.col("node").alias("old"), F.col("component").alias("new"))
    moved = (parts.join(up, F.col("component") == F.col("old"), "left")
             .select("node", F.coalesce("new", "component").alias("component")))
    alone = up.join(parts, F.col("old") == F.col("node"), "left_anti").select(F.col("old").alias("node"), F.col("new").alias("component"))
    return materialize(moved.unionByName(alone), "parts")


def elect_rounds(stars: DataFrame, parts: DataFrame, bags: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``stars`` still open, and components, after rounds in which another member meets those of its bands in other components.

    ``stars``: a, b, mask, of_a, of_b; each round elects one b of every a.  What a round closes is left out once, after the last.
    """
    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(lo, 500) for whole in batches for lo in range(0, whole.num_rows, 500)):
            n, m = (batch.column(c).to_numpy() for c in (2, 4))
            x, y = (batch.column(c).to_pylist() for c in (3, 5))
            keep = [SIMILARITY * max(n[k], m[k]) - 1 <= min(n[k], m[k]) and bool(within_reach(
                n[k], np.frombuffer(x[k], dtype=np.uint8), m[k:k + 1], np.frombuffer(y[k], dtype=np.uint8)[None, :])[0])
                for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = {c: bags.select(F.col("cid").alias(c), F.col("n_words").alias(f"n_{c}"), F.col("bag").alias(f"bag_{c}")) for c in "ab"}
    for k in range(ROUNDS):
        turn = F.struct(F.xxhash64("b", F.lit(k)).alias("h"), "b", "mask", "of_b")
        heads = (stars.groupBy("a").agg(F.min(turn).alias("head"))
                 .select("a", F.col("head.b").alias("elected"), F.col("head.mask").alias("shared"), F.col("head.of_b").alias("home")))
        pairs = (stars.join(heads, "a").where((F.col("of_b") != F.col("home")) & (F.col("mask").bitwiseAND(F.col("shared")) != 0))
                 .select(F.least("elected", "b").alias("a"), F.greatest("elected", "b").alias("b")).distinct())
        near = materialize(pairs.join(side["a"], "a").join(side["b"], "b").select("a", "b", "n_a", "bag_a", "n_b", "bag_b")
                           .mapInArrow(reach, "a long, b long"), "elected")
        found = materialize(verify(near, texts), "elected-links")
        if found.isEmpty():
            break
        parts = merged_parts(parts, found)
        stars = placed_stars(stars, parts)
    return open_stars(stars), parts


def link_rest(near: DataFrame, links: DataFrame, bags: DataFrame, texts: DataFrame) -> DataFrame:
    """Components by ``links`` and, among what the representatives left apart, by as many more as join all that link."""
    parts = materialize(connected_components(links), "parts")
    stars = open_stars(placed_stars(near, parts))
    ids = stars.select(F.col("b").alias("cid")).distinct()
    bags = materialize(bags.join(ids, "cid", "left_semi"), "open-bags", compression="zstd")
    stars, parts = elect_rounds(stars, parts, bags, texts)
    found = materialize(open_links(stars, bags, texts), "more-links")
    return parts if found.isEmpty() else merged_parts(parts, found)


def near_duplicate_groups(docs: DataFrame) -> DataFrame:
    """Per distinct (doc_id, content hash): group key (doc_id, content hash), kept, and rows of that key."""
    (key,) = fresh(docs, "key")
    keyed = row_key(docs.select("doc_id", "text"), key)
    rows = materialize(sketches(keyed, key), "sketches", compression="zstd")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    classes = materialize(rows.groupBy("key", "second").agg(least.alias("least"), F.first("picks").alias("picks"),
                                                             F.first("n_words").alias("n_words"), F.first("bag").alias("bag"))
                          .withColumn("cid", F.monotonically_increasing_id()), "classes", compression="zstd")
    sketched = classes.where(F.size("picks") > 0)
    # the lowest bits of a band's key are its number
    band = [F.xxhash64(F.lit(i), F.col("picks")[i]).bitwiseAND(F.lit(-PICKS)).bitwiseOR(F.lit(i)) for i in range(PICKS)]
    members = sketched.select("cid", F.explode(F.array(*band)).alias("bucket"))
    near = materialize(star_pairs(members), "candidates", compression="zstd")
    # one text per class that is in any pair, by the class's least row
    ids = near.select(F.col("a").alias("cid")).union(near.select(F.col("b").alias("cid"))).distinct()
    reps = classes.join(ids, "cid", "left_semi").select("cid", F.col("least.doc_id").alias("__d"),
                                                        F.col("least.key").alias("__k"))
    plain = keyed.select("doc_id", key, body().alias("text"))
    texts = materialize(plain.join(reps, null_safe(plain, reps, [("doc_id", "__d"), (key, "__k")]))
                        .select("cid", "text").dropDuplicates(["cid"]), "texts", compression="zstd")
    links = materialize(verify(near, texts), "links")
    parts = link_rest(near, links, classes.select("cid", "n_words", "bag"), texts)
    named = (classes.join(parts.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("component", F.coalesce("component", "cid")))
    groups = named.groupBy("component").agg(F.min("least").alias("g"))
    named = named.join(groups, "component").select("key", "second", "g")
    per_key = rows.groupBy("doc_id", "key", "second").agg(F.count(F.lit(1)).alias("n_rows"))
    return (per_key.join(named, ["key", "second"])
            .select("doc_id", "key", F.col("g.doc_id").alias("group_id"), F.col("g.key").alias("group_key"), "n_rows")
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("group_id")) & (F.col("key") == F.col("group_key"))))


def group_documents(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, group_id (least doc_id of its group), kept."""
    groups = near_duplicate_groups(docs)
    return groups.select("doc_id", "group_id", "kept", F.explode(F.expr("sequence(1L, n_rows)")).alias("copy")) \
        .select("doc_id", "group_id", (F.col("kept") & (F.col("copy") == 1)).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents with one of each group; all columns as they were."""
    key, d, k, n = fresh(docs, "key", "d", "k", "rows")
    kept = near_duplicate_groups(docs).where("kept").select(F.col("doc_id").alias(d), F.col("key").alias(k), F.col("n_rows").alias(n))
    keyed = row_key(docs, key)
    joined = keyed.join(kept, null_safe(keyed, kept, [("doc_id", d), (key, k)]))
    columns = [f"`{c}`" for c in docs.columns]
    once = joined.where(F.col(n) == 1).select(*columns)
    again = joined.where(F.col(n) > 1).dropDuplicates(["doc_id", key]).select(*columns)
    return once.unionByName(again)

