"""The field on secrets under names the patterns lack: precision and recall on planted configurations, stretches, odd texts."""

import random
import string

import numpy as np
import pytest

from linkloom.llm import secret_scan as sc


def value(rng):
    return "".join(rng.choices(string.ascii_letters + string.digits, k=rng.randint(16, 32)))


def prose(rng, n):
    return " ".join("".join(rng.choices("aeioulnrst", k=rng.randint(2, 8))) for _ in range(n))


def corpus(seed, n=900):
    """(texts, planted spans no pattern has): a third with listed names, a third with other names, a third without secrets."""
    rng, texts, planted = random.Random(seed), [], []
    for k in range(n):
        text, spans = prose(rng, rng.randint(5, 60)) + "\n", []
        for _ in range(rng.randint(1, 3)):
            sign = rng.choice([" = ", ": ", "=", ": \"", " = '"])
            if k % 3 == 0:
                text += rng.choice(["password", "api_key", "db_secret", "auth_token"]) + sign + value(rng) + "\n"
            elif k % 3 == 1:
                text += rng.choice(["pwd", "credential", "private_code", "login_pin", "signature"]) + sign
                v = value(rng)
                spans.append((len(text), len(text) + len(v)))
                text += v + "\n"
            else:
                text += rng.choice([f"size{sign}{rng.randint(1, 10**6)}\n", f"name{sign}{prose(rng, 2)}\n", f"call {rng.randint(10**11, 10**12)} now\n",
                                    f"see https://{prose(rng, 1)}.example/{prose(rng, 1)}/{rng.randint(1, 999)}\n"])
            text += prose(rng, rng.randint(3, 30)) + ".\n"
        texts.append(text)
        planted.append(spans)
    return texts, planted


@pytest.mark.parametrize("seed", range(2))
def test_finds_secrets_the_patterns_lack(spark, seed):
    texts, planted = corpus(seed)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: [tuple(map(int, s.split(":")[1:])) for s in r["spans"].split(",") if s.startswith("crf")]
             for r in sc.scan_documents(frame).collect()}
    hit = sum(any(a < e and s < b for a, b in found[d]) for d, spans in enumerate(planted) for s, e in spans)
    right = sum(any(a < e and s < b for s, e in planted[d]) for d, spans in found.items() for a, b in spans)
    n_planted, n_found = sum(map(len, planted)), sum(map(len, found.values()))
    print(f"recall {hit / n_planted:.3f}, precision {right / max(1, n_found):.3f} of {n_found}")
    assert hit >= 0.9 * n_planted and right >= 0.9 * n_found


def test_stretches_decode_as_whole_texts():
    rng = np.random.default_rng(0)
    field = sc.Field(rng.normal(size=(1 << sc.BITS, 3)), np.array([[0.5, 0, -9], [-1, -1, 0.7], [-0.5, -0.5, 0.6]]), np.array([0, 0, -9.0]))
    scores = [rng.normal(size=(n, 3)) for n in (0, 1, 5, 191, 192, 193, 1500)]
    for s, path in zip(scores, field.decode(scores)):
        best, back = field.start + s[0] if len(s) else None, []
        for x in s[1:]:
            step = best[:, None] + field.transition
            back.append(step.argmax(axis=0))
            best = step.max(axis=0) + x
        want = [int(best.argmax())] if len(s) else []
        for b in reversed(back):
            want.append(int(b[want[-1]]))
        assert path.tolist() == want[::-1]


def test_features_of_training_and_scanning_agree():
    text = "intro words here\npassword = 'abcDEF123456789' and more\nfinal text"
    reader = sc.Reader()
    ((features, labels), (hidden, _)) = sc.training_stretches(text, reader)
    tokens = sc.TOKEN.findall(text)
    rng = np.random.default_rng(1)
    field = sc.Field(rng.normal(size=(1 << sc.BITS, 3)), np.zeros((3, 3)), np.zeros(3))
    assert np.allclose([field.emission[f].sum(axis=0) for f in features], sc.Tagger(field).scores(tokens, sc.file_features(text)))
    assert [t for t, y in zip(tokens, labels) if y] == ["abcDEF123456789"] and features != hidden


def test_decoding_equals_a_plain_viterbi_and_scores_equal_their_sums():
    """Paths of texts decoded side by side, ties to the first label; features of the whole text are summed once a description."""
    import numpy as np

    from linkloom.llm import secret_scan as ss
    rng = np.random.default_rng(4)
    field = ss.Field(rng.integers(-3, 4, (1 << ss.BITS, 3)).astype(float), rng.integers(-2, 3, (3, 3)).astype(float), np.zeros(3))
    scores = [rng.integers(-2, 3, (n, 3)).astype(float) for n in (1, 7, 60, 150)]
    for s, got in zip(scores, field.decode(scores)):
        best, back = s[0] + field.start, []
        for row in s[1:]:
            step = best[:, None] + field.transition
            back.append(step.argmax(axis=0))
            best = step.max(axis=0) + row
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        assert got.tolist() == path[::-1]
    tagger = ss.Tagger(field)
    for text in ("key = a1b2c3d4e5;", "key = a1b2c3d4e5; " * 90, "Other_Words here: Zz99-xx", "key = a1b2c3d4e5;"):
        tokens, file = ss.TOKEN.findall(text), ss.file_features(text)
        reader = ss.Reader()
        looks, near = reader.read(tokens)
        shape = np.array(reader.shape, dtype=np.uint64)
        around = ss.neighbour_features(looks, near, shape)
        want = [sum(field.emission[f] for f in [*reader.own[look], *around[i], *[int(ss._mixed(shape[look:look + 1] ^ np.uint64(ss._feature(x)), 200 + k)[0])
                                                                               for k, x in enumerate(file)]]) for i, look in enumerate(looks)]
        assert np.array_equal(tagger.scores(tokens, file), np.array(want))
    assert len(tagger.whole) == len({(k, x) for text in ("key = a1b2c3d4e5;", "key = a1b2c3d4e5; " * 90, "Other_Words here: Zz99-xx")
                                     for k, x in enumerate(ss.file_features(text))})


def test_the_choice_of_documents_with_matches_is_that_of_the_patterns(spark):
    """Spark's mark (key words first, then the patterns) chooses what the patterns choose."""
    from pyspark.sql import functions as F

    from linkloom.llm import secret_scan as ss
    texts = ["PassWord: abcdefgh", "pass word: abcdefgh", "api_KEY=12345678", "apikey = '12345678'", "token abc", "secret=short", "AKIA" + "A" * 12,
             "akia" + "a" * 12, "f" * 32, "F" * 32, "", "toKen: abcdefgh", "passwd:\"abcdefgh", "the secret word"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id for r in df.where(ss.may_match(F.col("text"))).collect()}
    assert got == {i for i, t in enumerate(texts) if ss.pattern_spans(t)}


def test_known_words_are_summed_once(monkeypatch):
    """Token scores equal the plain sum over all features, also when the reader begins anew; known words are not hashed again."""
    rng = np.random.default_rng(3)
    field = sc.Field(rng.normal(size=(1 << sc.BITS, 3)), rng.normal(size=(3, 3)), rng.normal(size=3))
    texts = [" ".join(f"Word{i * k % 97}x = {'ab' * (k % 5)} {i}" for i in range(60)) for k in range(1, 40)] + ["", "one"]
    monkeypatch.setattr(sc, "KNOWN", 150)
    tagger = sc.Tagger(field)
    for text in texts:
        tokens, file = sc.TOKEN.findall(text), sc.file_features(text)
        reader = sc.Reader()
        looks, words = reader.read(tokens)
        shape = np.array(reader.shape, dtype=np.uint64)
        near = sc.neighbour_features(looks, words, shape)
        whole = [sc._mixed(shape[looks] ^ np.uint64(sc._feature(x)), 200 + k) for k, x in enumerate(file)]
        plain = np.array([field.emission[[*reader.own[x], *near[i], *(w[i] for w in whole)]].sum(axis=0) for i, x in enumerate(looks)])
        assert np.allclose(tagger.scores(tokens, file), plain.reshape(-1, 3))
    monkeypatch.setattr(sc, "KNOWN", 10_000)
    hashed, mixed = [], sc._mixed
    monkeypatch.setattr(sc, "_mixed", lambda h, salt: hashed.append(len(h)) or mixed(h, salt))
    for again in range(2):
        hashed.clear()
        for text in texts:
            tagger.scores(sc.TOKEN.findall(text), sc.file_features(text))
    assert sum(hashed) <= len(texts)  # before: six for every token
