"""The registered queries on whole tables against brute force, exact round trips or held-out accuracy."""

import collections
import hashlib
import html as html_lib
import re
import zlib

import duckdb
import numpy as np
import pytest

from linkloom.llm import collision_dedup, decontamination, order_minhash, queries, suffix_dedup, words

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def rows(spark, sf_dir, name):
    return queries.QUERIES[name](spark, sf_dir).collect()


def test_reshard_is_whole_even_and_moves_least(spark, sf_dir, docs):
    got = rows(spark, sf_dir, "op1_reshard")
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    slots = collections.defaultdict(list)
    held, old = collections.Counter(), collections.Counter()
    moved = 0
    for r in got:
        raw = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        slots[r["shard"]].append(r["slot"])
        held[r["shard"]] += r["size"]
        old[r["old_shard"]] += r["size"]
        moved += r["size"] * (r["shard"] != r["old_shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(held.values()) / 16
    assert set(held) == set(range(16)) and max(abs(v - mean) for v in held.values()) < 0.02 * mean
    least = sum(max(0, v - mean) for v in old.values())
    assert moved <= least + 16 * 0.02 * mean


def test_line_dedup_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.execute(queries.ORACLE_SQL["op2_line_dedup"]).fetchall()
    got = [tuple(r) for r in rows(spark, sf_dir, "op2_line_dedup")]
    assert sorted(got) == sorted(want)
    assert sum(r[3] for r in got) > 0


def test_secret_patterns_equal_brute_force(spark, sf_dir, docs):
    assign = re.compile(r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
                        r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    got = rows(spark, sf_dir, "op3_secret_scan")
    assert len(got) == len(docs)
    for r in got:
        text = docs[r["doc_id"]] or ""
        spans = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 8]
        spans += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
        spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 32]
        base = ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(spans))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(x[1] == k for x in spans) for k in range(3)]
        assert ",".join(x for x in r["spans"].split(",") if x and not x.startswith("crf")) == base
    assert sum(r["n_assign"] for r in got) > 0


def _components(nodes, pairs):
    root = {n: n for n in nodes}

    def find(u):
        while root[u] != u:
            u = root[u]
        return u

    for a, b in pairs:
        ra, rb = find(a), find(b)
        root[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}


def test_order_minhash_groups_equal_brute_force(spark, sf_dir, docs):
    got = {r["doc_id"]: r for r in rows(spark, sf_dir, "op4_order_minhash")}
    assert set(got) == set(docs)
    ws = {d: words.words(t) for d, t in docs.items()}
    index, pairs = collections.defaultdict(set), set()
    for d, w in ws.items():
        for s in {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}:
            index[s].add(d)
    shared = collections.Counter()
    for members in index.values():
        if len(members) < 60:
            for a in members:
                shared.update((a, b) for b in members if a < b)
    for (a, b), n in shared.items():
        if ws[a] and ws[b] and n >= 0.3 * min(len(ws[a]), len(ws[b])) and order_minhash.edit_similarity(ws[a], ws[b]):
            pairs.add((a, b))
    by_text = collections.defaultdict(list)
    for d, t in docs.items():
        by_text[t].append(d)
    pairs |= {(min(m), d) for m in by_text.values() for d in m if d != min(m)}
    want = _components(sorted(docs), pairs)
    wrong = [d for d in docs if got[d]["group_id"] != want[d]]
    assert len(wrong) <= 0.002 * len(docs), wrong
    assert all(r["kept"] == (r["group_id"] == d) for d, r in got.items())


def test_main_text_equals_article_blocks(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in rows(spark, sf_dir, "op5_main_text"):
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S).group(1)
        blocks = [" ".join(html_lib.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = rows(spark, sf, "op6_toxicity")
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    test = [r for r in got if r["held_out"] and r["doc_id"] in toxic]
    hit = sum(r["predicted"] and toxic[r["doc_id"]] for r in test)
    assert hit >= 0.9 * sum(toxic[r["doc_id"]] for r in test)
    assert hit >= 0.95 * sum(r["predicted"] for r in test)


def _vector_truth(ids, x, label):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    i, j = np.nonzero(near)
    return near.sum(axis=1), _components(ids.tolist(), zip(ids[i].tolist(), ids[j].tolist()))


def _same_links(got, ids, links, parts):
    got = {r["vec_id"]: r for r in got}
    assert len(got) == len(ids)
    for v, n in zip(ids.tolist(), links.tolist()):
        assert (got[v]["n_links"], got[v]["component_id"], got[v]["kept"]) == (n, parts[v], parts[v] == v)


def test_vector_links_equal_brute_force(spark):
    """The whole table, and the table with chains of near copies and exact copies of its vectors."""
    sf = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in table])
    x = np.array([r["embedding"] for r in table], dtype=np.float32)
    label = np.array([r["label"] for r in table])
    _same_links(rows(spark, sf, "op7_collision_dedup"), ids, *_vector_truth(ids, x.astype(float), label))
    rng = np.random.default_rng(1)
    parts = [x]
    for step in range(4):  # each copy differs from the copy before it: cosine about 0.93 to the neighbour
        parts.append((parts[-1][:300] + rng.normal(0, (0.03, 0.045, 0.05, 0.0)[step], (300, x.shape[1]))).astype(np.float32))
    y = np.concatenate(parts)
    names, kinds = np.arange(len(y)), np.concatenate([label, np.tile(label[:300], 4)])
    frame = spark.createDataFrame([(int(k), v.tolist(), int(c)) for k, v, c in zip(names, y, kinds)],
                                  "vec_id long, embedding array<float>, label int")
    links, parts = _vector_truth(names, y.astype(float), kinds)
    assert links.sum() > 1000
    _same_links(collision_dedup.near_duplicate_vectors(frame).collect(), names, links, parts)


@pytest.mark.parametrize("crowd", [3, suffix_dedup.CROWD])  # 3: nearly every lead is refined, and many runs are split
def test_suffix_dedup_equals_brute_force(spark, sf_dir, docs, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    count = collections.Counter()
    for t in docs.values():
        raw = (t or "").encode()
        count.update(hash(raw[i:i + 400]) for i in range(len(raw) - 399))
    got = {r["doc_id"]: r for r in rows(spark, sf_dir, "op8_suffix_dedup")}
    assert set(got) == set(docs)
    for d, t in docs.items():
        raw = (t or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        end = 0
        for i in range(len(raw) - 399):
            if count[hash(raw[i:i + 400])] > 1:
                gone[max(i, end):i + 400] = True
                end = i + 400
        kept = bytes(np.frombuffer(raw, dtype=np.uint8)[~gone])
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        r = got[d]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(raw), int(gone.sum()), spans), d
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_leaks_equal_whole_alignment(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    items = [(r["item_id"], words.words(r["text"])) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    number = collections.defaultdict(lambda: len(number))
    want = set()
    for r in docs:
        text = np.array([number[w] for w in words.words(r["text"])])
        for k, ws in items:
            if len(text) and decontamination.align(np.array([number[w] for w in ws]), text)[0] >= 0.8 * 2 * len(ws):
                want.add((r["doc_id"], k))
    got = {(r["doc_id"], r["item_id"]) for r in rows(spark, SMALL, "op9_decontamination")}
    assert got == want and want


def test_packing_round_trip(spark, sf_dir, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4") for d, t in docs.items()}
    cover, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows(spark, sf_dir, "op10_packing"):
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and r["length"] > 0
        assert r["ids_crc32"] == zlib.crc32(own[r["start"]:r["start"] + r["length"]].tobytes())
        cover[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for d, own in ids.items():
        at = 0
        for start, length in sorted(cover[d]):
            assert start == at
            at += length
        assert at == len(own)
    short = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
        short += at < 4096
    assert short <= 1 and sorted(sequences) == list(range(len(sequences)))


def test_a_full_word_cache_keeps_the_words_met_again(monkeypatch):
    """A small cache gives the same ids, stays small, and does not encode common words again."""
    import pyarrow as pa
    import public_tokenizers
    from tokenizers import Tokenizer

    from linkloom.llm import packing
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    monkeypatch.setattr(packing, "CACHE_WORDS", 100)
    cache, encoded = packing.WordCache(path), []
    add = cache._add
    monkeypatch.setattr(cache, "_add", lambda ws: (encoded.extend(ws), add(ws))[1])
    for k in range(12):
        texts = ["the common words stay", *[f"single{k}x{j} \x1d odd" if j == 3 else f"The single{k}x{j}  words" for j in range(40)], ""]
        got = cache.batch(pa.array(texts))
        assert [x.tolist() for x in got] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(cache.number) <= 100 + 50
    assert encoded.count("common") == encoded.count("words") == 1 and encoded.count("single0x1") == 1
