"""Second-pass labelling of left-over links.

The residue (no label, or ``other``) is read with a pruned scan, turned into
prompts with native columns, labelled by a pluggable ``complete`` callable
inside ``mapInPandas`` (many tasks in parallel, one call per chunk of
``batch_size`` prompts, retried with doubling waits), parsed against the
closed label set, checkpointed (model answers are costly and must not be
recomputed after an executor loss), and joined back onto the links by id.

Rows with equal prompts are one class: the prompt is asked once and its answer
goes to all of them.  Each residue row is asked once per run; the original
loop could pick the same ``other`` rows again and again.  Capped passes go on
from a stored cursor (``relabel_pass``), so that rows answered ``other`` do not
keep later ones from being asked.  A prompt that fails alone is ``other``; a
service that fails prompt after prompt fails the job instead.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import (RELABEL_BATCH_SIZE, RELABEL_MAX_BATCHES, RETRY_FIRST_WAIT, RETRY_MAX_WAIT,
                      RETRY_TRIES, TAXONOMY)
from ..functions.prompts import parse_label, system_prompt, user_prompt
from ..session import path_exists, reliable_checkpoint
from ..sources.tables import RELABEL_SCAN_COLUMNS, ensure_column
from .ids import dense_rank_rows

Complete = Callable[[str, list[str]], list[str]]
OUTAGE = 10  # prompts in a row that fail alone before the service counts as down
OUTAGE_SHARE = 0.5
CURSOR = "pass int, after long"


def residue_predicate(category_col: str = "pred_category"):
    """not labelled yet, or labelled ``other`` (an OR form Parquet can push down)."""
    c = F.col(category_col)
    return c.isNull() | (c == "other")


def residue(links: DataFrame, where: str | None = None, category_col: str = "pred_category") -> DataFrame:
    """the rows a relabel pass looks at; F5: a predicate given as SQL text takes the default's place."""
    links = ensure_column(links, category_col)
    return links.where(F.expr(where) if where else residue_predicate(category_col))


def next_batch(links: DataFrame, n: int = RELABEL_BATCH_SIZE, where: str | None = None) -> DataFrame:
    """The ``n`` lowest ids of the residue (a top-k, not a full sort)."""
    return residue(links, where).select(*RELABEL_SCAN_COLUMNS).orderBy("id").limit(n)


class LabellerDown(RuntimeError):
    """The outside service answers nothing; its rows keep their labels and the job can be run again."""


def _labeller(complete: Complete, system: str, taxonomy: list[str], chunk: int,
              tries: int, first_wait: float, max_wait: float,
              sleep: Callable[[float], None], outage: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    alone = 0  # prompts that failed alone since the last answer

    def call(prompts: list[str], tries: int) -> list[str] | None:
        nonlocal alone
        wait = first_wait
        for attempt in range(tries):
            try:
                out = list(complete(system, prompts))
                if len(out) != len(prompts):
                    raise ValueError("labeller returned a different number of answers")
                alone = 0
                return out
            except Exception:  # noqa: BLE001 - any failure of the outside service is retried
                if attempt + 1 < tries:
                    sleep(min(wait, max_wait))
                    wait *= 2.0
        return None

    def ask(prompts: list[str], tries_now: int) -> list[str | None]:
        """Answers; a group that keeps failing is halved, so only prompts that fail alone go without."""
        out = call(prompts, tries_now)
        if out is not None:
            return out
        if len(prompts) == 1:
            nonlocal alone
            alone += 1
            if alone >= outage:
                raise LabellerDown(f"{alone} prompts in a row got no answer")
            return [None]
        half = len(prompts) // 2
        return [a for part in (prompts[:half], prompts[half:]) for a in ask(part, tries if len(part) == 1 else 1)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for start in range(0, len(pdf), chunk):
                part = pdf.iloc[start:start + chunk]
                raws = ask(part["prompt"].tolist(), tries)
                labels = [parse_label(r, taxonomy) if r is not None else "other" for r in raws]
                yield pd.DataFrame({"lead": part["lead"].to_numpy(), "raw": raws, "label": labels})
    return run


def label_residue(links: DataFrame, complete: Complete, taxonomy: Sequence[str] = TAXONOMY,
                  batch_size: int = RELABEL_BATCH_SIZE, max_batches: int = RELABEL_MAX_BATCHES,
                  where: str | None = None, tries: int = RETRY_TRIES,
                  first_wait: float = RETRY_FIRST_WAIT, max_wait: float = RETRY_MAX_WAIT,
                  sleep: Callable[[float], None] = time.sleep, checkpoint: bool = True,
                  max_parallel_calls: int | None = None, after: int | None = None,
                  outage: int = OUTAGE) -> DataFrame:
    """U2 over the residue: ``id, raw, label, asked, batch_no`` for every row covered.

    Equal prompts are asked once; ``asked`` marks the row (least id) whose
    prompt was sent for its class.  ``max_batches`` > 0 caps the pass at that
    many batches of the lowest ids (T3), as the original's option does; 0 means
    all rows (:func:`unasked` counts what a cap left out); ``after`` leaves out
    ids up to it.  ``batch_no`` numbers the rows in id order, ``batch_size``
    per batch (D3).  ``max_parallel_calls`` bounds how many tasks call the
    service at once (the prompts, not the links, are redistributed into that
    many partitions).  ``outage`` prompts in a row that fail alone in a task, or
    as many in all if they are half of those sent, fail the job
    (:class:`LabellerDown`).
    """
    res = residue(links, where).select(*RELABEL_SCAN_COLUMNS)
    if after is not None:
        res = res.where(F.col("id") > after)
    tasks = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if max_batches:
        tasks = min(max_batches, tasks)
        res = res.orderBy("id").limit(batch_size * max_batches)
    prompt = user_prompt(F.col("url"), F.col("anchor_text"), F.col("rel"), F.col("is_external"))
    # a class is known by two hashes of its prompt; the prompts themselves are kept once a class
    rows = reliable_checkpoint(res.select("id", F.xxhash64(F.lit(1), prompt).alias("h1"), F.xxhash64(F.lit(2), prompt).alias("h2"))) \
        if checkpoint else res.select("id", F.xxhash64(F.lit(1), prompt).alias("h1"), F.xxhash64(F.lit(2), prompt).alias("h2"))
    leads = rows.groupBy("h1", "h2").agg(F.min("id").alias("lead"))
    prompts = (res.select(F.col("id").alias("lead"), prompt.alias("prompt")).join(leads.select("lead"), "lead", "left_semi")
               .repartitionByRange(max_parallel_calls or tasks, "lead"))
    fn = _labeller(complete, system_prompt(taxonomy), list(taxonomy), batch_size, tries,
                   first_wait, max_wait, sleep, outage)
    answers = prompts.mapInPandas(fn, "lead long, raw string, label string")
    if checkpoint:
        answers = reliable_checkpoint(answers)
        sent = answers.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("raw").isNull()).alias("failed")).first()
        if sent["n"] >= outage and sent["failed"] >= OUTAGE_SHARE * sent["n"]:
            raise LabellerDown(f"{sent['failed']} of {sent['n']} prompts got no answer")
    named = (rows.join(leads, ["h1", "h2"]).join(answers, "lead")
             .select("id", "raw", "label", (F.col("id") == F.col("lead")).alias("asked")))
    ranked = dense_rank_rows(named, ["id"], out="rn", start=0)
    return ranked.withColumn("batch_no", (F.floor(F.col("rn") / batch_size) + 1).cast("int")).drop("rn")


def unasked(links: DataFrame, labels: DataFrame, where: str | None = None) -> DataFrame:
    """One row, ``n_unasked``: residue rows that a capped pass (T3) did not ask."""
    return (residue(links, where).select("id").join(labels.select("id"), "id", "left_anti")
            .agg(F.count(F.lit(1)).alias("n_unasked")))


def read_cursor(spark: SparkSession, path: str) -> int | None:
    """The largest id that capped passes have covered (None: start over)."""
    if not path_exists(spark, path):
        return None
    row = spark.read.schema(CURSOR).parquet(path).orderBy(F.col("pass").desc()).first()
    return row["after"] if row else None


def relabel_pass(links: DataFrame, complete: Complete, cursor_path: str, **kw) -> tuple[DataFrame, DataFrame]:
    """One capped pass over the residue, from where the last one ended: (labels, report).

    The cursor at ``cursor_path`` (a row per pass) is written when the answers
    are in; once no residue row lies beyond it, the next pass starts over with
    the lowest ids.  The report has one row: ``pass``, ``n_rows`` (covered),
    ``n_asked`` (prompts sent), ``n_unasked`` (residue rows beyond the cursor),
    ``after`` (the new cursor, NULL to start over).
    """
    spark = links.sparkSession
    number = spark.read.schema(CURSOR).parquet(cursor_path).count() + 1 if path_exists(spark, cursor_path) else 1
    after = read_cursor(spark, cursor_path)
    labels = reliable_checkpoint(label_residue(links, complete, after=after, **kw))
    done = labels.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("asked").alias("n_asked"), F.max("id").alias("top")).first()
    top = done["top"] if done["top"] is not None else after
    left = residue(links, kw.get("where")).where(F.col("id") > (top if top is not None else -1)).count() if done["n_rows"] else 0
    report = spark.createDataFrame([(number, done["n_rows"], done["n_asked"], left, top if left else None)],
                                   "pass int, n_rows long, n_asked long, n_unasked long, after long")
    report.select("pass", "after").coalesce(1).write.mode("append").parquet(cursor_path)
    return labels, report


def apply_labels(links: DataFrame, labels: DataFrame, category_col: str = "pred_category") -> DataFrame:
    """Write labels back onto the links by id (rows not asked keep theirs)."""
    links = ensure_column(links, category_col)
    lab = labels.select("id", F.col("label").alias("__new"))
    return (links.join(lab, "id", "left")
            .withColumn(category_col, F.coalesce(F.col("__new"), F.col(category_col)))
            .drop("__new"))


def relabel_counts(labels: DataFrame) -> DataFrame:
    """D3: rows updated per batch (every asked row is written, as in the original)."""
    return labels.groupBy("batch_no").agg(F.count(F.lit(1)).alias("n_updated"))
