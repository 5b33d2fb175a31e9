"""Rule-based URL classification (C1..C3, C5, D4).

An ordered rule list compiles on the driver into one ``CASE WHEN .. RLIKE``
column: the first matching rule wins, no match gives ``other``.  Rules are
configuration on the driver; the data never
leaves the executors and the CASE runs inside whole-stage codegen.

Regex dialect: Java regex with ``(?d)`` (only ``\\n`` ends a line, as in
Python), plus ``(?i)`` for IGNORECASE rules.  ``RLIKE`` searches, like the
set-oriented original; all shipped rules start with ``^``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Sequence
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import py_strip
from ..sources.tables import ensure_column

Rule = tuple[str, str, Sequence[str]]
RULES_PER_CASE = 200  # longer lists become several CASEs


def compile_flags(flags: Iterable[str] | None, honor_all: bool = False,
                  force_ignorecase: bool = False, unicode_case: bool = False) -> str:
    """Inline-flag prefix for one rule (flag names in any case)."""
    names = {str(f).upper() for f in (flags or [])}
    out = "d"
    if force_ignorecase or "IGNORECASE" in names:
        out += "iu" if unicode_case else "i"
    if honor_all and "MULTILINE" in names:
        out += "m"
    if honor_all and "DOTALL" in names:
        out += "s"
    return f"(?{out})"


def rule_case(url: Column, rules: Sequence[Rule], honor_all_flags: bool = False,
              force_ignorecase: bool = False, unicode_case: bool = False,
              default: str = "other") -> Column:
    """The first matching rule's label, else ``default``."""
    rules = list(rules)
    cases = []
    for at in range(0, len(rules), RULES_PER_CASE):
        case = F
        for label, pattern, flags in rules[at:at + RULES_PER_CASE]:
            case = case.when(url.rlike(compile_flags(flags, honor_all_flags, force_ignorecase, unicode_case) + pattern),
                             F.lit(label))
        cases.append(case)
    return F.coalesce(*cases, F.lit(default))  # a later CASE is only tried where no earlier one matched


def pattern_literals(pattern: str) -> list[str]:
    """The runs of plain ASCII characters every match of the pattern must hold, in lower case (none if none is sure).

    Read from the pattern's text: runs outside groups, classes and
    alternatives; a character that a quantifier may drop ends the run before it.
    """
    runs, run, depth, at = [], "", 0, 0
    while at < len(pattern):
        c = pattern[at]
        plain = ""
        if c == "\\":
            at += 1
            c = pattern[at:at + 1]
            if c.isalnum() and c not in "dDwWsSbBAZ":
                return []  # a character by its number or name, or a group again
            if c and not c.isalnum():
                plain = c
        elif c == "[":  # a class, closed by the first ] that is neither its first member nor escaped
            at += 2 if pattern[at + 1:at + 2] == "^" else 1
            at += pattern[at:at + 1] == "]"
            while pattern[at:at + 1] not in ("]", ""):
                at += 2 if pattern[at] == "\\" else 1
            if at >= len(pattern):
                return []
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "|" and not depth:
            return []
        elif c not in "|.^$*+?{}":
            plain = c
        elif c == "{":
            at = max(at, pattern.find("}", at))
        follows = pattern[at + 1:at + 2]
        if plain and plain.isascii() and not depth and follows not in ("*", "?", "{"):
            run += plain.lower()
            if follows == "+":
                runs.append(run)
                run = ""
        else:
            runs.append(run)
            run = ""
        at += 1
    return [r for r in (*runs, run) if r]


def pattern_literal(pattern: str) -> str:
    """The longest of :func:`pattern_literals` ('' if there is none)."""
    return max(pattern_literals(pattern), key=len, default="")


class RuleIndex:
    """Many rules as one automaton over their literals: a URL meets only the patterns whose literal it holds, in order.

    Of a rule's literals the one that fewest rules hold is taken, the longest
    of several: a host that all rules name tells none of them apart.
    """

    def __init__(self, rules: Sequence[Rule], honor_all_flags: bool = False, force_ignorecase: bool = False, default: str = "other"):
        self.rules = [(label, pattern, {str(f).upper() for f in flags or []}) for label, pattern, flags in rules]
        self.honor_all, self.force, self.default = honor_all_flags, force_ignorecase, default
        self.made = None

    def __getstate__(self):
        return {**vars(self), "made": None}  # tasks build the automaton once each

    def _make(self):
        import ahocorasick

        literals = [set(pattern_literals(pattern)) for _, pattern, _ in self.rules]
        shared = Counter(chain.from_iterable(literals))
        by_literal: dict[str, list[int]] = {}
        tests = []
        for k, ((_, pattern, flags), own) in enumerate(zip(self.rules, literals)):
            options = re.ASCII
            if self.force or "IGNORECASE" in flags:
                options |= re.IGNORECASE
            if self.honor_all:
                options |= (re.MULTILINE if "MULTILINE" in flags else 0) | (re.DOTALL if "DOTALL" in flags else 0)
            tests.append(re.compile(pattern, options).search)
            by_literal.setdefault(min(own, key=lambda x: (shared[x], -len(x), x), default=""), []).append(k)
        always = by_literal.pop("", [])
        found = ahocorasick.Automaton()
        for literal, members in by_literal.items():
            found.add_word(literal, members)
        if by_literal:
            found.make_automaton()
        return tests, always, found if by_literal else None

    def label(self, url: str) -> str:
        if self.made is None:
            self.made = self._make()
        tests, always, found = self.made
        some = set(always)
        if found is not None:
            for _, members in found.iter(url.lower()):
                some.update(members)
        for k in sorted(some):
            if tests[k](url):
                return self.rules[k][0]
        return self.default


def rule_lookup(url: Column, rules: Sequence[Rule], **kw) -> Column:
    """C2/C3 for rule lists of thousands: the label :func:`rule_case` gives, by a :class:`RuleIndex` over Arrow batches.

    Patterns are read by Python's ``re`` with ASCII classes, which agrees with
    the compiled form for the syntax both share.  NULL stays NULL.
    """
    index = RuleIndex(rules, **kw)

    @F.arrow_udf("string")
    def label(urls: pa.Array) -> pa.Array:
        known: dict[str, str] = {}
        out = []
        for u in urls.to_pylist():
            if u is not None and u not in known:
                known[u] = index.label(u)
            out.append(None if u is None else known[u])
        return pa.array(out, pa.string())

    return label(url)


def classify_url(url: Column, rules: Sequence[Rule], **kw) -> Column:
    """Row-wise label; the URL is stripped first and NULL counts as ''."""
    return rule_case(F.coalesce(py_strip(url), F.lit("")), rules, **kw)


def classify_links(df: DataFrame, rules: Sequence[Rule], url_col: str = "url",
                   only_nulls: bool = True, out_col: str = "pred_category", lookup: bool = False, **kw) -> DataFrame:
    """Set ``out_col`` from the rules on rows with a URL (and, with
    ``only_nulls``, no label yet); other rows keep their value (F2, F3, K8).

    ``lookup`` finds the rules to try by their literals (:func:`rule_lookup`),
    for lists too long for one compiled CASE."""
    df = ensure_column(df, out_col)
    guard = F.col(url_col).isNotNull()
    if only_nulls:
        guard = guard & F.col(out_col).isNull()
    if lookup:  # a Python column is computed for every row: rows that keep their label pass NULL
        label = rule_lookup(F.when(guard, F.col(url_col)), rules, **kw)
    else:
        label = rule_case(F.col(url_col), rules, **kw)
    return df.withColumn(out_col, F.when(guard, label).otherwise(F.col(out_col)))


def category_profile(df: DataFrame, category_col: str = "pred_category",
                     url_col: str | None = None) -> DataFrame:
    """Links per category, with internal/external split and, with ``url_col``, distinct URLs.

    Links that are one row per URL already (after D2) need no ``url_col``:
    the distinct count shuffles every (category, URL) pair once.
    """
    ext = F.coalesce(F.col("is_external"), F.lit(False))
    distinct = [F.countDistinct(url_col).alias("n_distinct")] if url_col else []
    return df.groupBy(F.col(category_col).alias("pred_category")).agg(
        F.count(F.lit(1)).alias("n_links"),
        F.sum(F.when(ext, 1).otherwise(0)).alias("n_external"),
        F.sum(F.when(ext, 0).otherwise(1)).alias("n_internal"),
        *distinct,
    )


def profile_partial(df: DataFrame, category_col: str = "pred_category", url_col: str = "url") -> DataFrame:
    """D4 of one batch in a form that merges: counts per category and a sketch of its URLs.

    The sketch is HyperLogLog with 2^12 registers; its estimate has a relative
    standard error of about 1.6 % however many batches are merged.
    """
    ext = F.coalesce(F.col("is_external"), F.lit(False))
    return df.groupBy(F.col(category_col).alias("pred_category")).agg(
        F.count(F.lit(1)).alias("n_links"),
        F.sum(F.when(ext, 1).otherwise(0)).alias("n_external"),
        F.sum(F.when(ext, 0).otherwise(1)).alias("n_internal"),
        F.hll_sketch_agg(url_col, F.lit(12)).alias("urls"))


def merge_profiles(partials: DataFrame) -> DataFrame:
    """Partial profiles (of any number of batches, or merged ones) as one: still mergeable."""
    return partials.groupBy("pred_category").agg(
        *[F.sum(c).alias(c) for c in ("n_links", "n_external", "n_internal")], F.hll_union_agg("urls").alias("urls"))


def profile_counts(merged: DataFrame) -> DataFrame:
    """The counts of a (merged) profile, with ``n_distinct_estimate`` read from the sketch."""
    return merged.select("pred_category", "n_links", "n_external", "n_internal",
                         F.hll_sketch_estimate("urls").alias("n_distinct_estimate"))
