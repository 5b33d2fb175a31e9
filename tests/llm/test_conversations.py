"""Conversation repair against a plain search over whole audits, and pieces against whole conversations."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest

from linkloom.llm import conversation_repair as cr
from linkloom.llm import queries

SPACE = " \t\n\v\f\r"
FORM = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    """Rows by conversation after the damage rule, in order."""
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        name = lambda v: " " if v is None else str(v)
        code = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = name(role), name(text)
        if code == 1:
            text = ""
        elif code == 2:
            text = re.sub("[.!?]", "", text)
        elif code == 4:
            role = "user"
        out[conv].extend([(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1))
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0)) for c, v in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def moves(role):
    """Initial -> states of the target form, by state."""
    return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get(role)


def solve(rows):
    """(cost, audit, lines): dynamic programming over (row, state) that keeps whole audits."""
    bad = faults(rows)
    best = {"": (0, "", ())}

    def offer(table, state, way):
        if state not in table or way[:2] < table[state][:2]:
            table[state] = way

    def inserts(table):
        for _ in range(3):
            for state, (cost, audit, lines) in list(table.items()):
                for role in ("user", "assistant"):
                    if (to := moves((state, role[0]))) and role[0] != "s":
                        offer(table, to, (cost + 2, audit + "I", (*lines, f"{role}:")))
        return table

    for (_, role, text), fault in zip(rows, bad):
        now = {}
        for state, (cost, audit, lines) in inserts(best).items():
            offer(now, state, (cost + 3, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = fault == "truncated"
            if to := moves((state, role[:1])):
                offer(now, to, (cost + extra, audit + "K", (*lines, f"{role}:{text}")))
            for new in ("user", "assistant"):
                if to := moves((state, new[0])):
                    offer(now, to, (cost + 2 + extra, audit + "R", (*lines, f"{new}:{text}")))
        best = now
    return min(inserts(best)[s] for s in ("", "a") if s in best)


def expected(rows):
    """The contract's row of every conversation."""
    out = {}
    for conv, turns in damaged(rows).items():
        bad = collections.Counter(faults(turns))
        numbers = {t for t, _, _ in turns if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        cost, audit, lines = solve(turns)
        assert FORM.fullmatch("".join(x[0] for x in lines))
        out[conv] = (gaps, bad["blank"], bad["duplicate"], bad["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def results(frame):
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in frame.collect()}


def test_query_equals_plain_search(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = results(queries.QUERIES["op11_conversation_repair"](spark, sf_dir))
    assert got == expected(rows)
    assert {x for r in got.values() for x in r[6]} == set("DIKR")


def random_rows(n_conv, longest, seed):
    rng = random.Random(seed)
    rows = []
    for c in range(n_conv):
        for t in range(rng.randint(0, longest)):
            rows.append((c, t if rng.random() > 0.1 else None if t == 0 else t,
                         rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "u", None]),
                         rng.choice([f"t{c}.{t}.", f"t{c}.{t}", f"x{t}?", "same.", "  \t", "", None, "end. ", "ok! \n"])))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed", range(2))
def test_random_rows_equal_plain_search(spark, seed):
    rows = random_rows(400, 14, seed)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert results(cr.repair_report(cr.damage(frame))) == expected(rows)


def test_one_conversation_over_all_partitions(spark):
    rows = [(5, t, r, x) for _, t, r, x in random_rows(1, 1, 0)] + [(4, 0, "user", "a."), (6, 0, "assistant", "b.")]
    rng = random.Random(9)
    rows += [(5, 10 + t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice([f"t{t}.", f"t{t}", "", "again."]))
             for t in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = cr.ordered_rows(cr.damage(spark.createDataFrame(rows, SCHEMA)))
        assert ordered.where("conv_id = 5").select("part").distinct().count() > 3
        assert results(cr.repair_report(cr.damage(spark.createDataFrame(rows, SCHEMA)))) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.repair_report(cr.damage(empty)).count() == 0
    rows = [(None, None, None, None), (None, 3, "user", "hi."), (1, 1, "user", "x" * 200000), (2, 7, "system", "s.")]
    more = spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA + ", part int, idx string")
    assert results(cr.repair_report(cr.damage(more))) == expected(rows)
    dropped = next(t for t in range(1000) if zlib.crc32(f"8:{t}".encode()) % 20 == 0)
    got = results(cr.repair_report(cr.damage(spark.createDataFrame([(8, dropped, "user", "hi.")], SCHEMA))))
    assert got == {8: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_tree_is_freed_as_survivors_meet():
    """On a long alternating conversation the unresolved tree stays small, and the emitted path is the whole path."""
    rng, paths, out, most = random.Random(1), cr.Survivors(cr.NOTHING), [], 0
    for t in range(20000):
        paths.advance(cr.row_options(paths.heads, "ua"[t % 2] if rng.random() > 0.05 else rng.choice("sua"), rng.random() < 0.05,
                                     rng.random() < 0.1, 1))
        out.extend(n.label for n in paths.settled())
        most = max(most, t + 1 - len(out))
    paths.close()
    out.extend(n.label for n in paths.settled())
    assert len(out) == 20000 and most < 200
