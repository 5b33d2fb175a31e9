"""Secret scan: fixed patterns, plus a linear-chain conditional random field over tokens.

The field tags every token of every text as secret begin, inside or outside,
from its shape, the words around it and features of the whole text.  Texts are
decoded by Viterbi in stretches of 192 tokens with 32 more on either side,
many stretches at once.  Tagged runs are reported where they are no part of a
pattern's span and could be a value at all (8 key characters or more, not of
letters alone or of digits alone).

It learns from the patterns' matches: stretches of text around matches in at
most ``HITS`` documents, and stretches from anywhere in at most ``PLAIN``
others (least hashes of doc_id; the bounds of the sample).  Matches teach
twice, once as they stand and once with their key word hidden, so that the
field has to go by the value and the signs around it and finds secrets under
names the patterns lack.  Values that look like a secret in the place of one,
but that no pattern matches, are unknown: stretches that hold one are not
taught as outside.

A pattern's span is its whole match (code points, end exclusive).  Defined
results: null reads as empty; repeated rows repeat; without a pattern match in
the sample there are pattern spans only; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import string
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import Shared, body, materialize
from linkloom.llm.words import hash64, mix

HITS, PLAIN = 1200, 600  # documents the field is fitted on
STRETCHES = 3            # of one document, spread over it
AROUND = 25              # tokens on either side of what a training stretch is about
BITS = 14
CORE, MARGIN = 192, 32   # tokens decoded at once, and beside them
OUTSIDE, BEGIN, INSIDE = 0, 1, 2
NEAR = (-3, -2, -1, 1, 2)
KNOWN = 300_000          # tokens a task remembers the description of

# fixed values: the patterns every secret scan of this package must report
ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs of 32 and more: the same as all runs with the short ones dropped
KINDS = ("assign", "access", "hex", "crf")

TOKEN = re.compile(r"[A-Za-z0-9+/_\-]+|\w+|[^\s\w]")
_DIGIT, _LETTER, _VALUE = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]"), re.compile(r"[A-Za-z0-9+/_.=\-]{8,}")
# what Spark selects documents with matches by, before the patterns themselves are run
KEY_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")  # one of them, in either case, is in every assignment
ANY_ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?[A-Za-z0-9+/_.=-]{8}"
ANY_OTHER = r"AKIA[A-Z0-9]{12}|[0-9a-f]{32}"


def pattern_spans(text: str) -> list[tuple[int, str, int, int]]:
    """(start, kind, end, start of the value) of the fixed patterns, by start, then kind as listed."""
    lower = text.lower()
    out = []
    if any(word in lower for word in KEY_WORDS):
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return [(s, KINDS[k], e, v) for s, k, e, v in sorted(out)]


_CLASS = {**{ord(c): "x" for c in string.ascii_lowercase}, **{ord(c): "X" for c in string.ascii_uppercase},
          **{ord(c): "0" for c in string.digits}}
_LENGTHS, _VARIETIES = (2, 4, 8, 12, 16, 20, 24, 32, 41, 64), (3, 6, 9, 12, 15, 20)
_RUN = re.compile(r"([xX0])\1+")
_HEX = re.compile(r"[0-9a-fA-F]+")


def _bucket(x: float, steps: tuple) -> int:
    return bisect_right(steps, x)


def look_of(token: str) -> tuple:
    """What a token looks like: shape (runs of lower case, upper case and digits), then buckets and kinds."""
    n = len(token)
    if token.isascii() and token.isalpha() and token[n > 1:].islower():  # most words, capitalised or not
        return ("x" if n == 1 or token.islower() else "Xx", bisect_right(_LENGTHS, n), 0, bisect_right(_VARIETIES, len(set(token))),
                _HEX.fullmatch(token) is not None, False)
    classes = token.translate(_CLASS)
    shape = _RUN.sub(r"\1", classes)
    if len(shape) > 6:
        shape = f"{shape[:2]}~{min(len(shape) // 4, 6)}"
    return (shape, _bucket(n, _LENGTHS), _bucket(classes.count("0") / n, (0.01, 0.2, 0.5, 1.0)), _bucket(len(set(token)), _VARIETIES), _HEX.fullmatch(token) is not None, token.isupper())


def describe(look: tuple) -> list[str]:
    """Feature names of a look."""
    names = [f"{k}={v}" for k, v in zip(("shape", "length", "digits", "variety", "hex", "upper"), look)]
    return [*names, f"{names[1]}&{names[4]}&{names[2]}", f"{names[0]}&{names[3]}"]


def file_features(text: str) -> list[str]:
    return [f"file-length={_bucket(len(text), (200, 1000, 5000, 20000))}", f"assigns={_bucket(text.count('='), (1, 3, 10))}",
            f"braces={_bucket(text.count('{') + text.count(';'), (1, 10))}"]


def _feature(name: str) -> int:
    return hash64(name.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


def _plain(token: str) -> str:
    """A token as its neighbours see it: short words themselves, all else alike."""
    return token.lower() if len(token) <= 10 and not _DIGIT.search(token) else "*"


class Rows:
    """An array that grows by rows at its end, copied whenever it has doubled only."""

    def __init__(self, *shape: int, dtype: type = np.float64) -> None:
        self.n, self.data = 0, np.zeros((1024, *shape), dtype=dtype)

    def add(self, rows: np.ndarray) -> None:
        while self.n + len(rows) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        self.data[self.n:self.n + len(rows)] = rows
        self.n += len(rows)


class Known(dict):
    """Tokens' rows; a new token gets its row when it is first asked for."""

    def __init__(self, new) -> None:
        super().__init__()
        self.new = new

    def __missing__(self, token: str) -> int:
        return self.new(token)


class Reader:
    """Feature numbers of token sequences; remembers what tokens look like."""

    def __init__(self) -> None:
        self.looks: dict[tuple, int] = {}
        self.own: list[list[int]] = []                # features of a description by itself
        self.shape: list[int] = []                    # hash of its shape
        self.forget()

    def forget(self) -> None:
        self.known = Known(self.new)                  # token -> its row in the two lists below
        self.look: list[int] = []                     # number of its description
        self.word: list[int] = []                     # number of its hash as a neighbour
        self.words: dict[str, int] = {}
        self.hashes: list[int] = [0]                  # of neighbours; 0 stands beyond the ends
        self.arrays = Rows(2, dtype=np.int64)         # the two lists

    def new(self, token: str) -> int:
        look = look_of(token)
        if look not in self.looks:
            self.looks[look] = len(self.own)
            self.own.append([_feature(x) for x in describe(look)])
            self.shape.append(hash64(f"shape={look[0]}".encode("utf-8", "surrogatepass")))
        word = _plain(token)
        if word not in self.words:
            self.words[word] = len(self.hashes)
            self.hashes.append(hash64(word.encode("utf-8", "surrogatepass")))
        self.known[token] = at = len(self.look)
        self.look.append(self.looks[look])
        self.word.append(self.words[word])
        return at

    def places(self, tokens: list[str], hidden: frozenset[int] = frozenset()) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of descriptions and of neighbours; words at ``hidden`` places are read as any long token."""
        if len(self.known) > KNOWN:
            self.forget()
        row = self.known.__getitem__
        star = row("*" * 12)
        at = np.fromiter(map(row, tokens), np.int64, len(tokens))
        if hidden:
            masked = at.copy()
            masked[list(hidden)] = star
        held = self.arrays.n
        if held < len(self.look):
            self.arrays.add(np.array([self.look[held:], self.word[held:]], dtype=np.int64).T)
        return self.arrays.data[at, 0], self.arrays.data[masked if hidden else at, 1]

    def read(self, tokens: list[str], hidden: frozenset[int] = frozenset()) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of descriptions and neighbour hashes."""
        looks, words = self.places(tokens, hidden)
        return looks, np.array([self.hashes[w] for w in words.tolist()], dtype=np.uint64)


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    return (mix(h + np.uint64(salt * 0x9E37 + 1)) & np.uint64((1 << BITS) - 1)).astype(np.int64)


def neighbour_features(looks: np.ndarray, words: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """(tokens x 6): the words around every token, by their distance, and the shape before it; 0 stands beyond the ends."""
    n, reach = len(words), max(map(abs, NEAR))
    padded = np.concatenate([np.zeros(reach, dtype=np.uint64), words, np.zeros(reach, dtype=np.uint64)])
    columns = [_mixed(padded[reach + d:reach + d + n], 50 + d) for d in NEAR]
    before = np.concatenate([np.zeros(1, dtype=np.uint64), shape[looks[:-1]]]) if n else np.zeros(0, dtype=np.uint64)
    return np.stack([*columns, _mixed(before, 99)], axis=1)


@dataclass
class Field:
    """Weights of the chain: emission (features x 3), transition (3 x 3), start (3)."""

    emission: np.ndarray
    transition: np.ndarray
    start: np.ndarray

    def decode(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        """Viterbi paths of token scores, texts cut into overlapping stretches that are decoded side by side."""
        cuts = [(k, lo) for k, s in enumerate(scores) for lo in range(0, len(s), CORE)]
        out = [np.zeros(len(s), dtype=np.int8) for s in scores]
        for at in range(0, len(cuts), 2000):
            some = cuts[at:at + 2000]
            spans = [(k, max(0, lo - MARGIN), min(len(scores[k]), lo + CORE + MARGIN)) for k, lo in some]
            length = max(b - a for _, a, b in spans)
            # padding stays outside at no cost, whatever came before
            score = np.full((len(some), length, 3), -1e6)
            score[:, :, OUTSIDE] = 0.0
            live = np.zeros((len(some), length), dtype=bool)
            for r, (k, a, b) in enumerate(spans):
                score[r, :b - a] = scores[k][a:b]
                live[r, :b - a] = True
            best, back = self.start + score[:, 0], np.zeros((length, len(some), 3), dtype=np.int8)
            whole = live.all(axis=0).tolist()
            for t in range(1, length):
                move = self.transition[:, None, :] if whole[t] else np.where(live[:, t, None], self.transition[:, None, :], 0.0)
                outside, begin, inside = (best[:, k:k + 1] + move[k] for k in (OUTSIDE, BEGIN, INSIDE))
                top = np.maximum(outside, begin)
                back[t] = np.where(inside > top, INSIDE, begin > outside)
                best = np.maximum(top, inside) + score[:, t]
            path = np.zeros((len(some), length), dtype=np.int8)
            path[:, -1] = best.argmax(axis=1)
            rows = np.arange(len(some))
            for t in range(length - 1, 0, -1):
                path[:, t - 1] = back[t, rows, path[:, t]]
            for r, ((k, lo), (_, a, b)) in enumerate(zip(some, spans)):
                hi = min(lo + CORE, len(scores[k]))
                out[k][lo:hi] = path[r, lo - a:hi - a]
        return out


class Tagger:
    """A field at work: token scores from the weights, summed once per description and per neighbour."""

    def __init__(self, field: Field):
        self.field, self.reader = field, Reader()
        self.sums = np.zeros((0, 3))
        self.shape = np.zeros(0, dtype=np.uint64)
        self.before = np.zeros((0, 3))                      # what a description adds to the token after it
        self.held = self.reader.hashes
        self.near = Rows(len(NEAR), 3)                      # what a neighbour adds, by its distance
        self.whole: dict[tuple[int, str], np.ndarray] = {}  # what a feature of the whole text adds to every description
        self.both: dict[tuple[str, ...], np.ndarray] = {}   # descriptions' sums with all features of the whole text

    def _look_up(self) -> None:
        """Sums of the descriptions and neighbours that are new."""
        emission, reader = self.field.emission, self.reader
        if len(self.sums) < len(reader.own):
            new = reader.own[len(self.sums):]
            self.sums = np.concatenate([self.sums, [emission[f].sum(axis=0) for f in new]])
            self.shape = np.array(reader.shape, dtype=np.uint64)
            self.before = emission[_mixed(self.shape, 99)]
        hashes = reader.hashes
        if hashes is not self.held:  # the reader has begun anew
            self.held, self.near = hashes, Rows(len(NEAR), 3)
        if self.near.n < len(hashes):
            new = np.array(hashes[self.near.n:], dtype=np.uint64)
            self.near.add(np.stack([emission[_mixed(new, 50 + d)] for d in NEAR], axis=1))

    def _own(self, file: list[str]) -> np.ndarray:
        key = tuple(file)
        if len(self.both.get(key, self.sums[:0])) < len(self.sums):
            self.both[key] = self.sums
            for k, name in enumerate(file):
                adds = self.whole.get((k, name), self.sums[:0])
                if len(adds) < len(self.shape):
                    new = _mixed(self.shape[len(adds):] ^ np.uint64(_feature(name)), 200 + k)
                    self.whole[k, name] = adds = np.concatenate([adds, self.field.emission[new]])
                self.both[key] = self.both[key] + adds
        return self.both.get(key, self.sums)

    def scores(self, tokens: list[str], file: list[str]) -> np.ndarray:
        looks, words = self.reader.places(tokens)
        self._look_up()
        n = len(looks)
        if not n:
            return np.zeros((0, 3))
        out = self._own(file)[looks]
        for k, d in enumerate(NEAR):  # beyond the ends stands word 0
            at = np.zeros(n, dtype=np.int64)
            at[max(0, -d):n - max(0, d)] = words[max(0, d):n - max(0, -d)]
            out += self.near.data[at, k]
        out[1:] += self.before[looks[:-1]]
        out[0] += self.field.emission[_mixed(np.zeros(1, dtype=np.uint64), 99)[0]]
        return out

    def spans(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """Tagged runs (start, end) of every text."""
        paths = self.field.decode([self.scores(TOKEN.findall(t), file_features(t)) for t in texts])
        out = []
        for text, path in zip(texts, paths):
            found: list[list[int]] = []
            if path.any():
                inside = False
                for m, tag in zip(TOKEN.finditer(text), path.tolist()):
                    if tag == INSIDE and inside:
                        found[-1][1] = m.end()
                    elif tag != OUTSIDE:
                        found.append([m.start(), m.end()])
                    inside = tag != OUTSIDE
            out.append([(a, b) for a, b in found if _could_be_value(text[a:b])])
        return out


def _could_be_value(run: str) -> bool:
    return bool(any(_DIGIT.search(v) and _LETTER.search(v) for v in _VALUE.findall(run)))


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit_field(windows: list[tuple[list[list[int]], list[int]]], rounds: int = 60, decay: float = 1e-3) -> Field:
    """Maximum likelihood with a ridge, by Adam over all windows; windows of like length run together."""
    groups: dict[int, list[int]] = {}
    for i, (f, _) in enumerate(windows):
        groups.setdefault(-(-len(f) // 8) * 8, []).append(i)
    packs = []
    for length, members in groups.items():
        token, feature, n = [], [], np.array([len(windows[i][0]) for i in members])
        y = np.zeros((len(members), length), dtype=int)
        for r, i in enumerate(members):
            y[r, :n[r]] = windows[i][1]
            for t, f in enumerate(windows[i][0]):
                feature.extend(f)
                token.extend([r * length + t] * len(f))
        packs.append((np.array(token), np.array(feature), n, y, np.arange(length)[None, :] < n[:, None]))
    width = 1 << BITS
    theta = np.zeros(width * 3 + 9 + 3)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    total = max(1, len(windows))
    for t in range(1, rounds + 1):
        emission, transition, start = theta[:width * 3].reshape(width, 3), theta[width * 3:width * 3 + 9].reshape(3, 3), theta[-3:]
        g_e, g_t, g_s = np.zeros_like(emission), np.zeros((3, 3)), np.zeros(3)
        for token, feature, n, y, live in packs:
            rows, length = y.shape
            score = np.stack([np.bincount(token, weights=emission[feature, c], minlength=rows * length) for c in range(3)],
                             axis=1).reshape(rows, length, 3)
            alpha = np.empty_like(score)
            alpha[:, 0] = start + score[:, 0]
            for k in range(1, length):
                step = _lse(alpha[:, k - 1, :, None] + transition, 1) + score[:, k]
                alpha[:, k] = np.where(live[:, k, None], step, alpha[:, k - 1])
            z = _lse(alpha[:, -1], 1)
            beta = np.zeros_like(score)
            pair = np.zeros((3, 3))
            for k in range(length - 2, -1, -1):
                ahead = transition + (score[:, k + 1] + beta[:, k + 1])[:, None, :]
                on = live[:, k + 1]
                pair += np.exp(alpha[on, k, :, None] + ahead[on] - z[on, None, None]).sum(axis=0)
                beta[:, k] = np.where(on[:, None], _lse(ahead, 2), 0.0)
            p = np.exp(alpha + beta - z[:, None, None]) * live[:, :, None]
            truth = np.eye(3)[y] * live[:, :, None]
            diff = (p - truth).reshape(-1, 3)
            for c in range(3):
                g_e[:, c] += np.bincount(feature, weights=diff[token, c], minlength=width)
            on = live[:, 1:]
            g_t += pair - np.bincount((y[:, :-1] * 3 + y[:, 1:])[on], minlength=9).reshape(3, 3)
            g_s += diff.reshape(rows, length, 3)[:, 0].sum(axis=0)
        grad = np.concatenate([g_e.ravel(), g_t.ravel(), g_s]) / total + decay * theta
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        theta = theta - 0.1 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-9)
    return Field(theta[:width * 3].reshape(width, 3).copy(), theta[width * 3:width * 3 + 9].reshape(3, 3).copy(), theta[-3:].copy())


def training_stretches(text: str, reader: Reader) -> list[tuple[list[list[int]], list[int]]]:
    """Feature numbers and labels of a document's training stretches: around matches, or anywhere without unknown values."""
    found = list(TOKEN.finditer(text))
    if not found:
        return []
    spans = [(s, v, e) for s, _, e, v in pattern_spans(text)]
    starts = np.array([m.start() for m in found])
    labels = np.zeros(len(found), dtype=np.int8)
    keys: set[int] = set()
    for s, v, e in spans:
        a, b = np.searchsorted(starts, [v, e])
        labels[a:b] = INSIDE
        labels[a:a + 1] = BEGIN
        keys.update(i for i in range(int(np.searchsorted(starts, s)), int(a)) if _LETTER.search(found[i].group()))
    tokens = [m.group() for m in found]
    unknown = [i for i, t in enumerate(tokens) if not labels[i] and len(t) >= 8 and _DIGIT.search(t) and _LETTER.search(t)
               and any(x in "=:\"'" for x in tokens[max(0, i - 3):i])]
    about = [int(np.searchsorted(starts, v)) for _, v, _ in spans] or [hash64(f"{k} {text[:200]}".encode("utf-8", "surrogatepass")) % len(found)
                                                                       for k in range(STRETCHES)]
    about = [about[k * len(about) // min(STRETCHES, len(about))] for k in range(min(STRETCHES, len(about)))]
    out, file = [], file_features(text)
    for at in about:
        a, b = max(0, at - AROUND), min(len(found), at + AROUND)
        if any(a <= i < b for i in unknown):
            continue
        for hidden in ([frozenset()] + ([frozenset(i - a for i in keys if a <= i < b)] if labels[a:b].any() else [])):
            looks, words = reader.read(tokens[a:b], hidden)
            shape = np.array(reader.shape, dtype=np.uint64)
            near = neighbour_features(looks, words, shape)
            names = [_mixed(shape[looks] ^ np.uint64(_feature(x)), 200 + k) for k, x in enumerate(file)]
            out.append(([[*reader.own[look], *near[i].tolist(), *[int(x[i]) for x in names]] for i, look in enumerate(looks.tolist())],
                        labels[a:b].tolist()))
    return out


def scan(texts: list[str], tagger: Tagger | None) -> list[list[tuple[int, str, int]]]:
    """Per text all spans (start, kind, end): the fixed patterns and what the field adds."""
    base = [[(s, k, e) for s, k, e, _ in pattern_spans(t)] for t in texts]
    if tagger is None:
        return base
    out = []
    for mine, added in zip(base, tagger.spans(texts)):
        new = [(a, "crf", b) for a, b in added if not any(a < e and s < b for s, _, e in mine)]
        out.append(sorted([*mine, *new], key=lambda x: (x[0], KINDS.index(x[1]))))
    return out


def may_match(text: Column) -> Column:
    """Whether a text has a match of the fixed patterns; a plain search for the key words spares most texts theirs."""
    lower = F.lower(text)
    named = reduce(or_, [lower.contains(word) for word in KEY_WORDS])
    return (named & text.rlike(ANY_ASSIGN)) | text.rlike(ANY_OTHER)


def fit_on_sample(docs: DataFrame, hits: int = HITS, plain: int = PLAIN) -> Field | None:
    """The field from at most ``hits`` documents with matches and ``plain`` others; their stretches (bounded each) come to the driver."""
    marked = materialize(docs.where("text is not null and doc_id is not null").select("doc_id", may_match(F.col("text")).alias("hit")), "secret-marks")
    ids = [marked.where(F.col("hit") == hit).select("doc_id").distinct().orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(n)
           for hit, n in ((True, hits), (False, plain))]
    sample = materialize(ids[0].unionByName(ids[1]).distinct(), "secret-sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            features, sizes, labels = [], [], []
            for text in batch.column(0).to_pylist():
                for f, y in training_stretches(text, reader):
                    features.append(np.array([x for t in f for x in t], dtype=np.int16).tobytes())
                    sizes.append(np.array([len(t) for t in f], dtype=np.int16).tobytes())
                    labels.append(np.array(y, dtype=np.int8).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in (features, sizes, labels)],
                                             names=["features", "sizes", "labels"])

    got = (docs.select("doc_id", "text").where("text is not null").join(F.broadcast(sample), "doc_id", "left_semi")
           .select("text").mapInArrow(run, "features binary, sizes binary, labels binary").toArrow())
    windows = []
    for f, s, y in zip(*(got.column(c).to_pylist() for c in ("features", "sizes", "labels"))):
        cuts = np.cumsum(np.frombuffer(s, dtype=np.int16).astype(int))[:-1]
        windows.append(([x.astype(int).tolist() for x in np.split(np.frombuffer(f, dtype=np.int16), cuts)],
                        np.frombuffer(y, dtype=np.int8).tolist()))
    windows.sort(key=lambda w: hash64(repr(w).encode()))  # the order of arrival must not matter
    return fit_field(windows[:2 * (hits + plain)]) if any(any(y) for _, y in windows) else None


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_crf, base_sha256, spans per row."""
    field = Shared(docs.sparkSession, fit_on_sample(docs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_assign", "n_access", "n_hex", "n_crf", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(field.value) if field.value is not None else None
        for batch in (b.slice(lo, 200) for whole in batches for lo in range(0, whole.num_rows, 200) for b in [whole]):
            counts, digest, all_spans = [[], [], [], []], [], []
            for spans in scan(batch.column(1).to_pylist(), tagger):
                for c, k in zip(counts, KINDS):
                    c.append(sum(x[1] == k for x in spans))
                digest.append(hashlib.sha256(joined([x for x in spans if x[1] != "crf"]).encode()).hexdigest())
                all_spans.append(joined(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digest, pa.string()),
                 pa.array(all_spans, pa.string())], names=names)

    return docs.select("doc_id", body().alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_crf long, base_sha256 string, spans string")
