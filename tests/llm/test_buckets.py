"""Near dedup joins every two texts of a bucket that link, whatever its representative is."""

import random

import pytest

from linkloom.llm import line_dedup
from linkloom.llm import order_minhash as om
from linkloom.llm.words import WordHashes, shingle_hashes, words


def families(n, size, shared, own, edits, seed):
    """Texts of ``n`` families that share one long passage; family members differ by scattered edits."""
    rng = random.Random(seed)
    passage = [f"p{rng.randrange(400)}" for _ in range(shared)]
    out = []
    for f in range(n):
        base = [*passage, *(f"w{rng.randrange(5000)}" for _ in range(own))]
        for _ in range(size):
            text = list(base)
            for i in rng.sample(range(len(text)), edits):
                text[i] = f"e{rng.randrange(100000)}"
            out.append(" ".join(text))
    return out


def bucket_links(texts):
    """Pairs that share a band and reach the threshold, by brute force."""
    hashes, held = WordHashes(), {}
    for d, t in enumerate(texts):
        picks = om.order_minhash(om.occurrence_labelled(shingle_hashes(hashes.array(words(t)), om.K)))
        for i in range(om.PICKS):
            held.setdefault((i, picks[i]), set()).add(d)
    pairs = {(a, b) for m in held.values() for a in m for b in m if a < b}
    return {(a, b) for a, b in pairs if om.edit_similarity(words(texts[a]), words(texts[b]))}


def test_texts_of_a_bucket_that_link_are_one_group(spark):
    texts = families(60, 4, 60, 60, 8, 5)
    links = bucket_links(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    group = {r["doc_id"]: r["group_id"] for r in om.group_documents(docs).collect()}
    apart = [(a, b) for a, b in links if group[a] != group[b]]
    assert len(links) > 100 and not apart, (len(apart), len(links))


def test_word_counts_never_rule_out_a_link():
    rng, hashes = random.Random(8), WordHashes()
    for _ in range(300):
        a = [f"w{rng.randrange(60)}" for _ in range(rng.choice((1, 5, 40, 130, 400)))]
        b = list(a)
        for _ in range(rng.randrange(1 + len(a) // 4)):
            at = rng.randrange(len(b))
            b[at:at + 1] = rng.choice(([], ["x"], [b[at], f"y{rng.randrange(9)}"])) if len(b) > 1 else ["x"]
        if om.edit_similarity(a, b):
            bag, other = om.word_bag(hashes.array(a)), om.word_bag(hashes.array(b))
            assert om.within_reach(len(a), bag, om.np.array([len(b)]), other[None, :])[0]


@pytest.mark.parametrize("percent, least", [(0, 1.0), (5, 0.999), (10, 0.99), (15, 0.97), (20, 0.9)])
def test_bands_reach_edited_copies(percent, least):
    """Share of pairs that meet in a band, by scattered edits (replaced, dropped and added words) of 200-word texts."""
    rng, hashes, met = random.Random(percent), WordHashes(), 0
    picks = lambda ws: om.order_minhash(om.occurrence_labelled(shingle_hashes(hashes.array(ws), om.K)))
    for _ in range(300):
        a = [f"w{rng.randrange(3000)}" for _ in range(200)]
        b = list(a)
        for at in sorted(rng.sample(range(200), 2 * percent), reverse=True):
            b[at:at + 1] = rng.choice(([], [f"x{rng.randrange(9999)}"], [b[at], f"y{rng.randrange(9999)}"]))
        met += bool((picks(a) == picks(b)).any())
    assert met >= least * 300, met


def test_helper_names_do_not_clash(spark):
    rows = [(1, "one two three four five six", "d", "k", 1), (2, "one two three four five six", "d", "k", 2), (3, "other", "d", "k", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __d string, __k string, __rows int")
    assert sorted(r["doc_id"] for r in om.drop_near_duplicates(docs).collect()) == [1, 3]
    assert line_dedup.dedup_lines(docs).columns == docs.columns and line_dedup.dedup_lines(docs).count() == 3


def test_members_that_meet_in_blocks_are_compared_or_joined(spark, monkeypatch):
    """Without further representatives, and in blocks of a few texts, every two texts of a band that link are one group."""
    rng = random.Random(12)
    texts = [" ".join([*(f"w{i}" for i in range(40)), *(f"g{g}x{rng.randrange(60)}" for _ in range(60))]) for g in range(3) for _ in range(30)]
    texts += families(6, 12, 30, 60, 6, 3)
    monkeypatch.setattr(om, "ROUNDS", 0)
    monkeypatch.setattr(om, "BLOCK_BYTES", 1 << 13)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    group = {r["doc_id"]: r["group_id"] for r in om.group_documents(docs).collect()}
    links = bucket_links(texts)
    assert len(links) > 50 and all(group[a] == group[b] for a, b in links)


def test_blocks_that_meet_give_the_links_that_join():
    """100 texts of which all 4950 pairs link leave the task as 99 rows."""
    hashes, rows = WordHashes(), []
    for d in range(100):
        ws = [f"w{i}" for i in range(100)]
        ws[d] = f"y{d}"
        rows.append({"cid": d, "component": d, "mask": -1, "n_words": 100, "bag": om.word_bag(hashes.array(ws)).tobytes(),
                     "text": " ".join(ws), "stars": [{"a": -1, "mask": -1}]})
    assert len(om.block_links(-1, True, om.pa.array(rows), om.pa.array(rows))) == 99
    assert len(om.block_links(-1, False, om.pa.array(rows[:50]), om.pa.array(rows[50:]))) == 99
    for r in rows[50:]:
        r["mask"], r["stars"] = 0, [{"a": -1, "mask": 0}]  # in no band with the first
    assert not om.block_links(-1, False, om.pa.array(rows[:50]), om.pa.array(rows[50:]))


def test_a_member_meets_its_representative_in_one_row(spark):
    members = spark.createDataFrame([(b * om.PICKS + i, c) for b in (1, 2) for i in range(om.PICKS) for c in (b * 10, b * 10 + 1, b * 10 + 2)],
                                    "bucket long, cid long")
    got = sorted(tuple(r) for r in om.star_pairs(members).select("a", "b", "mask").collect())
    assert got == [(10, 11, -1), (10, 12, -1), (20, 21, -1), (20, 22, -1)]  # before: one row a band, 256 of them


def test_members_with_nothing_left_to_compare_are_no_open_rows(spark):
    """Rows of a star are open where a band of theirs holds members of two components."""
    rows = [(1, 2, 0b011, 1, 1), (1, 3, 0b100, 1, 1), (1, 4, 0b010, 1, 9),  # 3 shares no band with 4
            (5, 6, 0b1, 5, 6), (5, 7, 0b1, 5, 6),                           # one component, which 5 has met
            (8, 10, -1, 8, 10),                                             # alone
            (11, 12, -1 << 63, 11, 12), (11, 13, -1 << 63, 11, 13)]         # the last band, three components
    placed = spark.createDataFrame(rows, "a long, b long, mask long, of_a long, of_b long")
    got = sorted((r["a"], r["b"]) for r in om.open_stars(placed).collect())
    assert got == [(1, 2), (1, 4), (11, 12), (11, 13)]  # before: all eight
