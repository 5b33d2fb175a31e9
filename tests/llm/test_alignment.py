"""Token alignment against a plain double loop; merge-path pieces against a set of common ends."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from linkloom.llm import queries, token_alignment

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@pytest.mark.parametrize("piece", [1, 2, 7, 8192])
def test_pieces_find_every_common_end(piece):
    rng = random.Random(piece)
    for _ in range(200):
        last = rng.randint(1, 120)
        a, b = (np.array(sorted({*rng.sample(range(1, last + 1), rng.randint(0, last)), last})) for _ in range(2))
        cut_a, cut_b = token_alignment.diagonal_cuts(a, b, piece)
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        for i, j in zip(cut_a, cut_b):
            assert merged[:i + j] == sorted([(x, 0) for x in a[:i]] + [(x, 1) for x in b[:j]])
        assert (np.diff(cut_a + cut_b)[:-1] == piece).all()
        to_a, to_b = token_alignment.common_ends(a, b, piece)
        assert a[to_a - 1].tolist() == b[to_b - 1].tolist() == sorted(set(a) & set(b))


def token_bytes():
    a, b = Tokenizer.from_file(PATHS[0]), SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True

    def run(text):
        spelled = lambda ids: b"".join(x for _, x in ids)
        letters = token_alignment.byte_letters()
        xs = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        ys = [(i, bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
              for i in b.encode(text)]
        raw = (" " + text).encode()
        return (xs, ys) if text and spelled(xs) == raw == spelled(ys) else ([], [])
    return run


def expected(texts):
    tokens = token_bytes()
    groups = []
    for text in texts:
        out, at, ends = [], [0, 0], [[], []]
        for side, ids in enumerate(tokens(text or "")):
            for i, raw in ids:
                at[side] += len(raw)
                ends[side].append((at[side], i))
        left, right = [], []
        common = {e for e, _ in ends[0]} & {e for e, _ in ends[1]}
        b = iter(ends[1])
        for e, i in ends[0]:
            left.append(i)
            if e in common:
                for f, j in b:
                    right.append(j)
                    if f == e:
                        break
                out.append((left, right))
                left, right = [], []
        groups.append(out)
    held = collections.Counter()
    for out in groups:
        held.update({(x, y) for xs, ys in out for x in xs for y in ys})
    most = collections.Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    rows = []
    for out in groups:
        links = [(x, y) for xs, ys in out for x in xs for y in ys]
        line = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in out)
        rows.append((sum(len(x) for x, _ in out), sum(len(y) for _, y in out), len(out), len(links),
                     sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
                     hashlib.sha256(line.encode()).hexdigest() if out else ""))
    return rows


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("block", [2000, token_alignment.BLOCK])
def test_query_equals_plain_loops(spark, sf_dir, monkeypatch, block):
    monkeypatch.setattr(token_alignment, "BLOCK", block)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op12_token_alignment"](spark, sf_dir).collect()}
    assert got == dict(zip(docs, expected(docs.values())))


def test_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "WIDE", 6)
    rng = random.Random(2)
    texts = [None, "", " ", "a", "<s> hi </s> <unk><|endoftext|>", "under▁score", "x" * 5000, "\U0001f600中文́  " * 40,
             "same", "same", "tabs\t\tand\n\n\nlines\r\n", "\x00\x01", "".join(rng.choices("กขฃ́ aé-9", k=3000))]
    frame = spark.createDataFrame([(i, t, i, "x", True) for i, t in enumerate(texts)],
                                  "doc_id long, text string, block int, pairs string, doc boolean")
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in token_alignment.align_documents(frame, *PATHS).collect()}
    want = expected(texts)
    assert got == dict(enumerate(want))
    assert want[5] == (0, 0, 0, 0, 0, 0, "") and want[4][0] > 0 and max(w[3] / max(w[2], 1) for w in want) > 3
    nameless = frame.where("doc_id = 8").selectExpr("cast(null as long) AS doc_id", "text")
    assert token_alignment.align_documents(nameless, *PATHS).first()["doc_id"] is None
    assert token_alignment.align_documents(frame.limit(0), *PATHS).count() == 0


def test_stretches_equal_whole_texts(spark, sf_dir):
    """Encoding between spaces gives the ids of whole texts, on documents and on odd mixtures."""
    tok, rng = token_alignment.Tokenizers(*PATHS), random.Random(7)
    assert tok.splits
    texts = [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect() if r[0]]
    texts += ["".join(rng.choices(["a", "Zé", " ", "  ", "\n", "\t", "'s", "9", "12", ".", "中", "́", "\u00a0", "\u3000", "\u2028", "\x1c", "\x85",
                                   "\u180e", "\U0001f600", "▁", "'", "ﬁ", "_", "\u200b", "\ufeff", "<s>"], k=rng.randint(1, 40)))
              for _ in range(6000)]
    plain = token_bytes()
    got_a, got_b = tok.encode(texts)
    for text, x, y in zip(texts, got_a, got_b):
        want = plain(text)
        assert (x.tolist(), y.tolist()) == tuple([i for i, _ in side] for side in want), text
