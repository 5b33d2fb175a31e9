"""Named column stages bound once each ("let" expressions).

A long expression built in Python repeats every sub-expression it reuses;
nesting such expressions grows the plan exponentially, and a filter on the
result gets pushed below plain projections and inlined again.  A stage names
its results and later stages refer to them by name.  Each stage is bound once
with a "let": ``element_at(transform(array(struct(stage fields)), v -> rest), 1)``,
so every named result is computed once per row and the plan grows linearly
with the number of stages.  Only a stage's own fields are put in its struct;
nothing is copied forward.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Getter = Callable[[str], Column]
Stage = dict[str, Callable[[Getter], Column]]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def chain(stages: list[Stage], env: dict[str, Column], outputs: list[str]) -> Column:
    """A struct of ``outputs`` computed by the stages from the columns in ``env``.

    Works on plain columns and inside lambdas (for example per array element).
    """
    def build(i: int, env: dict[str, Column]) -> Column:
        if i == len(stages):
            return F.struct(*[env[o].alias(o) for o in outputs])
        st = stages[i]
        g: Getter = lambda n: env[n]
        fields = F.struct(*[fn(g).alias(name) for name, fn in st.items()])

        def body(v: Column) -> Column:
            return build(i + 1, {**env, **{name: v[name] for name in st}})
        return let(fields, body)
    return build(0, dict(env))
