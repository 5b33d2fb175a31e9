"""Decontamination against whole alignment of every document with every item, and on edited copies."""

import random

import numpy as np
import pytest

from linkloom.llm import decontamination as dc
from linkloom.llm.words import words


def truth(docs, items):
    number = {}
    code = lambda t: np.array([number.setdefault(w, len(number)) for w in words(t)])
    return {(d, k) for d, t in docs for k, i in items if t and i and words(i) and words(t)
            and dc.align(code(i), code(t))[0] >= 0.8 * 2 * len(words(i)) - 1e-9}


def found(spark, docs, items, id_type="long"):
    frames = (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, f"item_id {id_type}, text string"))
    return {(r["doc_id"], r["item_id"]) for r in dc.find_leaks(*frames).collect()}


@pytest.mark.parametrize("seed", range(3))
def test_equals_whole_alignment_on_few_words(spark, seed):
    """Few different words, so chance alignments near the threshold abound."""
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choices("abcdefgh", k=n))
    items = [(k, text(rng.randint(1, 14))) for k in range(12)]
    docs = [(d, text(rng.randint(0, 60))) for d in range(60)]
    want = truth(docs, items)
    assert found(spark, docs, items) == want and want


def edited(rng, ws, kind, fresh):
    out = list(ws)
    if kind == "inserts":  # a word after every k words, as many as the threshold allows
        room = dc.losable(len(ws))
        step = max(1, len(ws) // max(1, room))
        for at in range(len(ws) - 1, 0, -1):
            if at % step == 0 and room:
                out.insert(at, fresh())
                room -= 1
    else:
        for at in rng.sample(range(len(ws)), dc.losable(len(ws)) // 3):
            out[at:at + 1] = [] if kind == "drops" else [fresh()]
    return out


def test_edited_copies_are_found_whatever_surrounds_them(spark):
    """Copies at the threshold by inserted, dropped and changed words, in a corpus full of the items' own words."""
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(40)]
    count = iter(range(10**9))
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([2, 3, 4, 5, 10, 18, 40, 90])))) for k in range(30)]
    noise = lambda n: rng.choices(vocabulary, k=n)
    docs, want = [], set()
    for k, item in items:
        for kind in ("inserts", "drops", "changes"):
            d = len(docs)
            docs.append((d, " ".join([*noise(30), *edited(rng, item.split(), kind, lambda: f"new{next(count)}"), *noise(30)])))
            want.add((d, k))
    docs += [(len(docs) + i, " ".join(noise(200))) for i in range(40)]
    got = found(spark, docs, [(k, t) for k, t in items])
    assert want <= got and got == truth(docs, items)


def test_ids_of_any_type_and_repeated_rows(spark):
    docs = [(1, "some words before the test item is here and more"), (1, "some words before the test item is here and more"), (2, None), (3, "")]
    items = [(7, "the test item is here"), (8, "the test item is here"), (9, None), (10, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for kind in ("smallint", "int", "long"):
        rows = dc.find_leaks(frame, spark.createDataFrame(items, f"item_id {kind}, text string")).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in rows) == [(1, 7), (1, 7), (1, 8), (1, 8)]
        assert all((r["similarity"], r["first_word"], r["end_word"]) == (1.0, 3, 8) for r in rows)
    named = spark.createDataFrame([("x", "the test item is here")], "item_id string, text string")
    assert dc.drop_leaks(frame.withColumn("__key", frame.doc_id), named).columns == ["doc_id", "text", "__key"]
    assert dc.drop_leaks(frame, named).count() == 2


def test_places_are_written_once_and_give_counts_and_seeds(spark):
    """The one table that seeds are counted and found in: every item pair of every text, repeated rows included."""
    rng = random.Random(9)
    text = lambda n: " ".join(rng.choices("abcdefghij", k=n))
    items = [(k, text(rng.randint(1, 9))) for k in range(8)]
    docs = [(d % 30, text(rng.randint(0, 40))) for d in range(40)]
    docs += docs[:5]
    pairs = dc.item_pairs(spark.createDataFrame(items, "item_id long, text string"))
    places = dc.item_places(pairs, spark.createDataFrame(docs, "key long, text string"))
    hashes = dc.WordHashes()
    wanted = {p.pair for p in pairs.select("pair").collect()}
    want = []
    for key, t in docs:
        h = hashes.array(words(t))
        sets = ([dc.pair_hashes(h)] if len(h) > 1 else []) + ([dc.mix(h + np.uint64(77))] if any(len(words(i)) == 1 for _, i in items) and len(h) else [])
        want += [(key, int(p), at) for s in sets for at, p in enumerate(s.view(np.int64)) if int(p) in wanted]
    got = [(r.key, p, at) for r in places.collect() for p, at in zip(r.pair, r.place)]
    assert sorted(x for x in got if x[1] in wanted) == sorted(want) and want
    seeds = dc.rare_seeds(pairs, places).collect()
    per_item = {}
    for s in seeds:
        per_item.setdefault((s["item"], s["n_words"]), []).append(s["pair"])
    assert all(len(v) == min(dc.losable(n) + 1, max(1, n - 1)) for (_, n), v in per_item.items())
