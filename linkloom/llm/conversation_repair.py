"""Conversation structure repair: Viterbi over edits with coalescing survivors.

The rows of a conversation, by turn, are kept (0), reroled (2) or deleted (3),
and empty user or assistant rows are inserted (2), so that the initials of the
roles read ``(s?(ua)+)?``.  Four states say what was put out last (nothing, s,
u, a).  One survivor per state is kept in a tree of back pointers with
reference counts: paths that lose are freed, and what all survivors share is
put out at once, so memory holds the unresolved rest alone.  Equal costs are
settled by comparing the complete unresolved paths from the common ancestor
on (ASCII order of D, I, K, R).  A survivor goes as soon as another one could
imitate any future of it for strictly less.

One conversation may be larger than a task.  Rows without their texts are
sorted by range over (conversation, turn, role, text hash), so a conversation
is cut into as many pieces as it has partitions.  A piece that may continue an
earlier one is solved from each of the four states; the pieces are then put
together by the same tree, whose labels are now whole pieces.  Texts take no
part until the edits are known; they are joined to the rows that stay.

Rows equal in conversation, turn, role and text are one row with a count: the
first of them can stay, the others are duplicates.

Defined results: a null role, text, turn or conversation reads as one space in
the damage rule; null turns come first; rows of one turn are ordered by role,
then text hash; a null conv_id is a conversation; texts are equal if two
64-bit hashes are; a conversation without rows has zeros, an empty audit and
the hash of the empty string; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import materialize, null_safe

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
KEEPS = {NOTHING: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
PUTS = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # state after a reroled or inserted row
ROLE = {USER: "user", ASSISTANT: "assistant"}
CLOSING = {NOTHING: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}  # inserts that end a conversation in this state
REROLE = INSERT = 2
DELETE = 3
TRUNCATED = 1
# What any future of the column's state costs more, at most, from the row's state.
IMITATE = {NOTHING: {SYSTEM: 0, USER: 2, ASSISTANT: 0}, SYSTEM: {NOTHING: 4, USER: 2, ASSISTANT: 4},
           USER: {NOTHING: 5, SYSTEM: 2, ASSISTANT: 2}, ASSISTANT: {NOTHING: 3, SYSTEM: 0, USER: 2}}
SPACE = r"\x20\x09-\x0D"
LEGAL = {"su", "ua", "au"}


# ---------------------------------------------------------------- survivors

class Node:
    __slots__ = ("parent", "label", "origin", "refs", "kids")

    def __init__(self, parent, label, origin):
        self.parent, self.label, self.origin, self.refs, self.kids = parent, label, origin, 0, []


def earlier(a: Node, label_a: str, b: Node, label_b: str) -> bool:
    """Whether the path to ``a`` and on by ``label_a`` sorts before the other; both have as many steps."""
    while a is not b:
        label_a, label_b = a.label, b.label
        a, b = a.parent, b.parent
    return label_a < label_b


class Survivors:
    """The cheapest path to each state, least label on ties, as one tree."""

    def __init__(self, state: int):
        self.root = Node(None, "", None)
        self.root.refs = 1
        self.heads: dict[int, tuple[int, Node]] = {state: (0, self.root)}

    def advance(self, options: dict[int, list[tuple[int, int, str]]], where=None) -> None:
        """``options``: per new state (cost, old state, label); ``where`` is noted in the tree with the old state."""
        chosen = {}
        for state, ways in options.items():
            best = ways[0]
            for way in ways[1:]:
                if way[0] < best[0] or way[0] == best[0] and earlier(self.heads[way[1]][1], way[2],
                                                                    self.heads[best[1]][1], best[2]):
                    best = way
            chosen[state] = best
        old, self.heads = self.heads, {}
        for state, (cost, source, label) in chosen.items():
            if any(other[0] + IMITATE[s][state] < cost for s, other in chosen.items() if s != state):
                continue
            parent = old[source][1]
            node = Node(parent, label, (where, source))
            parent.kids.append(node)
            parent.refs += 1
            node.refs = 1
            self.heads[state] = (cost, node)
        for _, node in old.values():
            self.release(node)

    def release(self, node: Node) -> None:
        node.refs -= 1
        while not node.refs and node.parent is not None:
            parent = node.parent
            parent.kids.remove(node)
            parent.refs -= 1
            node = parent

    def settled(self) -> Iterator[Node]:
        """Steps that all survivors share, freed as they are given out."""
        while self.root.refs == 1 and self.root.kids:
            child = self.root.kids.pop()
            child.parent = None
            self.root = child
            yield child

    def close(self) -> tuple[int, str]:
        """Keep the path that ends cheapest; its cost and closing inserts."""
        best = None
        for state, (cost, node) in self.heads.items():
            way = (cost + INSERT * CLOSING[state], node, "I" * CLOSING[state])
            if best is None or way[0] < best[0] or way[0] == best[0] and earlier(way[1], way[2], best[1], best[2]):
                best = way
        for _, node in list(self.heads.values()):
            if node is not best[1]:
                self.release(node)
        return best[0], best[2]

    def tail(self, node: Node) -> str:
        """Labels from the last settled step to ``node``."""
        out = []
        while node is not self.root:
            out.append(node.label)
            node = node.parent
        return "".join(reversed(out))


def row_options(heads: dict[int, tuple[int, Node]], initial: str, gone: bool, truncated: bool,
                copies: int) -> dict[int, list[tuple[int, int, str]]]:
    """Ways over one row and its later copies; inserts go before a row that stays (after a deleted one they sort first)."""
    options: dict[int, list[tuple[int, int, str]]] = {}
    rest, after = DELETE * (copies - 1), "D" * (copies - 1)
    for state, (cost, _) in heads.items():
        options.setdefault(state, []).append((cost + DELETE + rest, state, "D" + after))
        if gone:
            continue
        at, label, paid = state, "", cost + rest + (TRUNCATED if truncated else 0)
        for _ in range(2 if state in (USER, ASSISTANT) else 3):
            keep = KEEPS[at].get(initial)
            if keep is not None:
                options.setdefault(keep, []).append((paid, state, f"{label}K{after}"))
            if keep != PUTS[at]:
                options.setdefault(PUTS[at], []).append((paid + REROLE, state, f"{label}R{after}"))
            at, label, paid = PUTS[at], label + "I", paid + INSERT
    return options


# ---------------------------------------------------------------- rows

def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies after the damage rule; copies 0: the row is dropped."""
    def plain(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    return (conversations.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), code.alias("code"))
            .select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.when(F.col("code") == 0, 0).when(F.col("code") == 3, 2).otherwise(1).cast("long").alias("copies")))


def _hashes() -> list[Column]:
    return [F.xxhash64(F.lit(k), F.col("text")).alias(c) for k, c in ((1, "a"), (2, "b"))]


def ordered_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows without texts, in order (part, idx), with counts and faults."""
    marks = rows.select("conv_id", "turn", "role", *_hashes(), "copies",
                        (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
                        (~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")).alias("cut"))
    marks = marks.groupBy("conv_id", "turn", "role", "a", "b", "blank", "cut").agg(F.sum("copies").alias("n"))
    place = F.struct(F.col("turn").isNotNull().alias("has"), "turn")
    first = (marks.where("n > 0").groupBy("conv_id", "role", "a", "b")
             .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("places")).where("places > 1")
             .select(F.col("conv_id").alias("c_"), F.col("role").alias("r_"), F.col("a").alias("a_"), F.col("b").alias("b_"), "first"))
    on = null_safe(marks, first, [("conv_id", "c_"), ("role", "r_"), ("a", "a_"), ("b", "b_")])
    known = materialize(marks.join(first, on, "left")
                        .select("conv_id", "turn", "role", "a", "b", "n", "blank", "cut",
                                F.coalesce(place > F.col("first"), F.lit(False)).alias("again")), "turns")
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "a", "b"]
    return materialize(known.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("part", F.spark_partition_id()).withColumn("idx", F.monotonically_increasing_id()), "ordered")


# ---------------------------------------------------------------- pieces

def _stats_type() -> pa.DataType:
    return pa.struct([(c, pa.int64()) for c in ("blank", "again", "cut", "illegal", "turns", "low", "high")]
                     + [("head", pa.string()), ("last", pa.string())])


class Piece:
    """The rows of one conversation in one partition, solved from every state they may start in."""

    def __init__(self, conv, part, idx, turn_free: bool):
        self.conv, self.part, self.idx = conv, part, idx
        self.runs = {s: (Survivors(s), []) for s in (range(4) if turn_free else (NOTHING,))}
        self.blank = self.again = self.cut = self.illegal = self.turns = 0
        self.low = self.high = self.head = self.last = None

    def add(self, turn, role, n, blank, cut, again) -> None:
        if not n:
            return
        initial = role[:1]
        self.blank += n if blank else 0
        self.again += 0 if blank else n if again else n - 1
        self.cut += not blank and not again and cut
        if self.head is None:
            self.head = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.illegal += n - 1  # two equal initials never follow each other
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        for paths, done in self.runs.values():
            paths.advance(row_options(paths.heads, initial, blank or again, cut, n))
            done.extend(node.label for node in paths.settled())

    def row(self) -> dict:
        entries = [{"entry": s, "prefix": "".join(done),
                    "exits": [{"state": t, "cost": c, "tail": p.tail(n)} for t, (c, n) in p.heads.items()]}
                   for s, (p, done) in self.runs.items()]
        stats = {c: getattr(self, c) for c in ("blank", "again", "cut", "illegal", "turns", "low", "high", "head", "last")}
        return {"conv_id": self.conv, "part": self.part, "idx": self.idx, "entries": entries, "stats": stats}


def _arrow(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def solve_pieces(ordered: DataFrame) -> DataFrame:
    """One row per conversation and partition: where it lies, its solutions by entry state, its counts."""
    conv = ordered.schema["conv_id"].dataType.simpleString()
    exits = "array<struct<state:int,cost:bigint,tail:string>>"
    counts = ",".join(f"{c}:bigint" for c in ("blank", "again", "cut", "illegal", "turns", "low", "high"))
    schema = (f"conv_id {conv}, part int, idx long, entries array<struct<entry:int,prefix:string,exits:{exits}>>, "
              f"stats struct<{counts},head:string,last:string>")
    exit_type = pa.list_(pa.struct([("state", pa.int32()), ("cost", pa.int64()), ("tail", pa.string())]))
    arrow = pa.schema([("conv_id", _arrow(ordered, "conv_id")), ("part", pa.int32()), ("idx", pa.int64()),
                       ("entries", pa.list_(pa.struct([("entry", pa.int32()), ("prefix", pa.string()), ("exits", exit_type)]))),
                       ("stats", _stats_type())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = None
        for batch in batches:
            out = []
            for part, idx, conv_id, turn, role, n, blank, cut, again in zip(*[c.to_pylist() for c in batch.columns]):
                if piece is None or part != piece.part or conv_id != piece.conv:
                    if piece is not None:
                        out.append(piece.row())
                    piece = Piece(conv_id, part, idx, piece is None or part != piece.part)
                piece.add(turn, role, n, blank, cut, again)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if piece is not None:
            yield pa.RecordBatch.from_pylist([piece.row()], schema=arrow)

    rows = ordered.select("part", "idx", "conv_id", "turn", "role", "n", "blank", "cut", "again")
    return materialize(rows.repartition("part").sortWithinPartitions("part", "idx").mapInArrow(run, schema), "pieces")


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def join_pieces(pieces: DataFrame) -> DataFrame:
    """Per piece its entry state and letters; per conversation one row with its counts, cost, audit and closing inserts."""
    conv = pieces.schema["conv_id"].dataType.simpleString()
    schema = (f"conv_id {conv}, part int, idx long, entry int, letters string, audit string, closing int, "
              + ", ".join(f"{c} long" for c in REPORT))
    arrow = pa.schema([("conv_id", _arrow(pieces, "conv_id")), ("part", pa.int32()), ("idx", pa.int64()), ("entry", pa.int32()),
                       ("letters", pa.string()), ("audit", pa.string()), ("closing", pa.int32()),
                       *[(c, pa.int64()) for c in REPORT]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict | None = None

        def give(out, nodes):
            for node in nodes:
                (part, idx), entry = node.origin
                out.append({"conv_id": state["conv"], "part": part, "idx": idx, "entry": entry, "letters": node.label})
                state["audit"].append(node.label)

        def finish(out):
            cost, closing = state["paths"].close()
            give(out, state["paths"].settled())
            low, high = state["low"], state["high"]
            out.append({"conv_id": state["conv"], "audit": "".join(state["audit"]) + closing, "closing": len(closing),
                        "gaps": 0 if low is None else high - low + 1 - state["turns"], "blank": state["blank"],
                        "duplicate": state["again"], "truncated": state["cut"], "illegal": state["illegal"], "cost": cost})

        def put(part, idx, entries, s):
            if s["head"] is not None:
                if state["last"] is not None:
                    state["illegal"] += state["last"] + s["head"] not in LEGAL
                state["last"] = s["last"]
            if s["low"] is not None:
                state["turns"] += s["turns"] - (s["low"] == state["high"])
                state["low"] = s["low"] if state["low"] is None else state["low"]
                state["high"] = s["high"]
            for c in ("blank", "again", "cut", "illegal"):
                state[c] += s[c]
            known = {e["entry"]: e for e in entries}
            options: dict[int, list] = {}
            for at, (cost, _) in state["paths"].heads.items():
                for x in known[at]["exits"]:
                    options.setdefault(x["state"], []).append((cost + x["cost"], at, known[at]["prefix"] + x["tail"]))
            state["paths"].advance(options, (part, idx))

        for batch in batches:
            out: list[dict] = []
            for conv_id, part, idx, entries, stats in zip(*[c.to_pylist() for c in batch.columns]):
                if state is None or conv_id != state["conv"]:
                    if state is not None:
                        finish(out)
                    state = {"conv": conv_id, "paths": Survivors(NOTHING), "audit": [], "low": None, "high": None, "last": None,
                             "blank": 0, "again": 0, "cut": 0, "illegal": 0, "turns": 0}
                put(part, idx, entries, stats)
                give(out, state["paths"].settled())
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if state is not None:
            out = []
            finish(out)
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    rows = pieces.select("conv_id", "part", "idx", "entries", "stats")
    return materialize(rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "idx").mapInArrow(run, schema), "solved")


# ---------------------------------------------------------------- edits

def row_edits(ordered: DataFrame, solved: DataFrame) -> DataFrame:
    """The rows that stay: their place, role after the edit, and the roles inserted before them."""
    fields = ["conv_id", "part", "idx", "turn", "role", "a", "b"]
    schema = ", ".join(f"{c} {ordered.schema[c].dataType.simpleString()}" for c in fields) + \
        ", audit string, out_role string, before array<string>"
    arrow = pa.schema([*[(c, _arrow(ordered, c)) for c in fields], ("audit", pa.string()), ("out_role", pa.string()),
                       ("before", pa.list_(pa.string()))])
    paths = solved.where("letters is not null").select(
        "conv_id", "part", "idx", F.lit(0).alias("kind"), "entry", "letters",
        *[F.lit(None).cast(ordered.schema[c].dataType).alias(c) for c in ("turn", "role", "a", "b", "n")])
    rows = ordered.where("n > 0").select("conv_id", "part", "idx", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("entry"),
                                         F.lit(None).cast("string").alias("letters"), "turn", "role", "a", "b", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, at, state = "", 0, NOTHING
        for batch in batches:
            out = []
            for conv_id, part, idx, kind, entry, path, turn, role, a, b, n in zip(*[c.to_pylist() for c in batch.columns]):
                if not kind:
                    letters, at, state = path, 0, entry
                    continue
                before = []
                while letters[at] == "I":
                    state = PUTS[state]
                    before.append(ROLE[state])
                    at += 1
                edit = letters[at]
                at += n
                if edit == "D":
                    continue
                state = KEEPS[state][role[:1]] if edit == "K" else PUTS[state]
                out.append({"conv_id": conv_id, "part": part, "idx": idx, "turn": turn, "role": role, "a": a, "b": b,
                            "audit": edit, "out_role": role if edit == "K" else ROLE[state], "before": before})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return paths.unionByName(rows).repartition("part").sortWithinPartitions("part", "idx", "kind").mapInArrow(run, schema)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept rows with their texts and edits, and one report row per conversation.

    ``rows``: conv_id, turn, role, text, copies (0: the conversation is only
    named).  Kept rows: conv_id, part, idx (their order), turn, role, out_role,
    text, audit, before (roles of empty rows inserted ahead).  The report's
    ``closing`` says how many empty rows (user, assistant) end the conversation.
    """
    ordered = ordered_rows(rows)
    solved = join_pieces(solve_pieces(ordered))
    edits = row_edits(ordered, solved)
    keys = ["conv_id", "turn", "role", "a", "b"]
    texts = (rows.where("copies > 0").select("conv_id", "turn", "role", "text", *_hashes())
             .groupBy(*keys).agg(F.first("text").alias("text"))
             .select(*[F.col(c).alias(f"{c}_") for c in keys], "text"))
    kept = edits.join(texts, null_safe(edits, texts, [(c, f"{c}_") for c in keys]))
    report = solved.where("audit is not null").select("conv_id", *REPORT, "audit", "closing")
    return kept.select("conv_id", "part", "idx", "turn", "role", "out_role", "text", "audit", "before"), report


def repair_report(rows: DataFrame) -> DataFrame:
    """The report with the hash of each repaired conversation, read in order by one hash state."""
    kept, report = repair(rows)
    conv = report.schema["conv_id"].dataType
    schema = f"conv_id {conv.simpleString()}, " + ", ".join(f"{c} long" for c in REPORT) + ", audit string, repaired_sha256 string"
    arrow = pa.schema([("conv_id", _arrow(report, "conv_id")), *[(c, pa.int64()) for c in REPORT], ("audit", pa.string()),
                       ("repaired_sha256", pa.string())])
    null = {c: F.lit(None).cast(t).alias(c) for c, t in
            [*[(c, "long") for c in REPORT], ("audit", "string"), ("closing", "int"), ("part", "int"), ("idx", "long"),
             ("out_role", "string"), ("text", "string"), ("before", "array<string>")]}
    lines = kept.select("conv_id", F.lit(1).alias("kind"), "part", "idx", "out_role", "text", "before",
                        *[null[c] for c in (*REPORT, "audit", "closing")])
    heads = report.select("conv_id", F.lit(0).alias("kind"), *[null[c] for c in ("part", "idx", "out_role", "text", "before")],
                          *REPORT, "audit", "closing")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, digest, first = None, None, True

        def line(text: str) -> None:
            nonlocal first
            digest.update((text if first else "\n" + text).encode("utf-8", "surrogatepass"))
            first = False

        def finish() -> dict:
            for role in ("user", "assistant")[2 - head["closing"]:]:
                line(f"{role}:")
            return {**{c: head[c] for c in ("conv_id", *REPORT, "audit")}, "repaired_sha256": digest.hexdigest()}

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if not row["kind"]:
                    if head is not None:
                        out.append(finish())
                    head, digest, first = row, hashlib.sha256(), True
                    continue
                for role in row["before"]:
                    line(f"{role}:")
                line(f"{row['out_role']}:{row['text']}")
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if head is not None:
            yield pa.RecordBatch.from_pylist([finish()], schema=arrow)

    both = heads.unionByName(lines)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "part", "idx").mapInArrow(run, schema)
