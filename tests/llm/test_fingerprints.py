"""Syncmer fingerprints against a k-mer by k-mer definition, chains against dynamic programming, the query against plain Python."""

import hashlib
import random

import numpy as np
import pytest

from linkloom.llm import queries, syncmers


def is_anchor(kmer):
    """A k-mer judged alone."""
    code = np.array([ord(c) for c in kmer], dtype=np.uint64)
    inner = [int(syncmers._rolling(code[i:i + syncmers.S], None, syncmers.S)[0]) for i in range(syncmers.WINDOW)]
    return min(inner) in (inner[0], inner[-1])


def test_anchors_depend_on_their_kmer_alone(docs):
    k = syncmers.K
    for text in ["".join(random.Random(1).choices("abcé \U0001f600", k=300)), "x" * 40, *list(docs.values())[:20]]:
        text = (text or "")[:1500]
        want = [i for i in range(len(text) - k + 1) if is_anchor(text[i:i + k])]
        hashes, gaps = syncmers.anchors(text)
        if want:
            assert (np.cumsum(gaps) - 1).tolist() == want and max(np.diff(want), default=0) <= syncmers.WINDOW
            assert hashes.tolist() == [int(syncmers.anchors(text[i:i + k])[0][0]) for i in want]
        else:
            assert len(hashes) == bool(text)


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@pytest.mark.parametrize("seed", range(3))
def test_chain_is_a_longest_common_order(seed):
    rng = random.Random(seed)
    for _ in range(200):
        a = rng.sample(range(60), rng.randint(1, 40))
        b = [x for x in a if rng.random() > 0.3] + rng.sample(range(60, 90), rng.randint(1, 20))
        rng.random() < 0.5 and rng.shuffle(b)
        pa, pb = syncmers.chain(np.array(a), np.array(b))
        assert np.array_equal(np.array(a)[pa], np.array(b)[pb]) and (np.diff(pa) > 0).all() and (np.diff(pb) > 0).all()
        assert len(pa) == longest(a, b)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def expected(texts):
    """Rows in order from a list of (id, text) in order."""
    out = []
    for (d, t), (_, u) in zip(texts, texts[1:] + texts[:1]):
        half = len(t) // 2
        new = t[:len(t) - half] + u[:half]
        mark, new_mark = syncmers.fingerprint(t), syncmers.fingerprint(new)
        out.append((d, len(t), hashlib.sha256(new.encode()).hexdigest(), mark, new_mark, syncmers.likeness(mark, new_mark),
                    syncmers.likeness(mark, syncmers.fingerprint(u))))
    return out


def test_query_equals_plain_python(spark, sf_dir, docs):
    got = sorted(tuple(r) for r in queries.QUERIES["op13_syncmer_fingerprint"](spark, sf_dir).collect())
    want = expected([(d, docs[d] or "") for d in sorted(docs)])
    assert got == want
    long = [r for r in got if r[1] >= 200]
    assert np.median([r[5] for r in long]) > 0.45 and np.median([r[6] for r in long]) < 0.1


def test_likeness_follows_edits():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(3000)]
    text = " ".join(rng.choices(words, k=400)).split()
    near = []
    for edits in (0, 4, 20, 80, 400):
        other = list(text)
        for i in rng.sample(range(400), edits):
            other[i] = rng.choice(words)
        near.append(syncmers.likeness(syncmers.fingerprint(" ".join(text)), syncmers.fingerprint(" ".join(other))))
    assert near == sorted(near, reverse=True) and near[0] == 1 and near[1] > 0.9 and near[-1] < 0.05


def test_ties_repeats_and_odd_rows(spark):
    rows = [(3, "third text here, long enough for anchors. " * 3), (1, None), (2, "short"), (2, "short"), (2, "short"),
            (2, "another of the same id"), (None, "no id"), (7, "x" * 100000)]
    frame = spark.createDataFrame([(*r, 1, "g") for r in rows], "doc_id long, text string, `range` int, guest string")
    got = [tuple(r) for r in syncmers.fingerprint_documents(frame).collect()]
    key = {r: k for r, k in zip(rows, [x[0] for x in frame.selectExpr("xxhash64(13, coalesce(text, ''))").collect()])}
    texts = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, key[r]))
    want = expected([(d, t or "") for d, t in texts])
    order = lambda rs: sorted(rs, key=repr)
    assert order(got) == order(want)
    one = spark.createDataFrame([(1, "only one document, followed by itself")], "doc_id long, text string")
    assert syncmers.fingerprint_documents(one).first()["near_next"] == 1.0
    assert syncmers.fingerprint_documents(one.limit(0)).count() == 0
