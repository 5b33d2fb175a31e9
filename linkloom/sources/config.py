"""Reading the tool's JSON config (db, columns, classification, relabel sections).

The config is a small driver-side document; it is read through Spark's file
system layer (so any cluster path works) and parsed with ``json`` to keep the
key order of the column map, which sets the output column order.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from ..config import (DEFAULT_COLUMN_MAP, DEFAULT_UNIQUE_KEY, RELABEL_BATCH_SIZE, RELABEL_MAX_BATCHES,
                      RESIDUE_PREDICATE, TAXONOMY)


@dataclass
class Settings:
    unique_key: str = DEFAULT_UNIQUE_KEY
    column_map: list[tuple[str, str]] = field(default_factory=lambda: list(DEFAULT_COLUMN_MAP))
    url_col: str = "url"
    only_update_nulls: bool = True
    rules: list[tuple[str, str, list[str]]] = field(default_factory=list)
    where_other_sql: str = RESIDUE_PREDICATE
    batch_size: int = RELABEL_BATCH_SIZE
    max_batches: int = RELABEL_MAX_BATCHES
    taxonomy: list[str] = field(default_factory=lambda: list(TAXONOMY))


def read_config_text(spark: SparkSession, path: str) -> str:
    """The text of the one file at ``path`` (a config is a driver-side document, held whole)."""
    texts = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(texts) != 1:
        raise ValueError(f"{path}: {'no' if not texts else 'more than one'} config file")
    return texts[0][0]


def parse_settings(text: str) -> Settings:
    """Settings from config text; missing sections keep the defaults."""
    cfg = json.loads(text)
    s = Settings()
    db = cfg.get("db", {})
    s.unique_key = db.get("unique_key", s.unique_key)
    if "columns" in cfg:
        s.column_map = list(cfg["columns"].items())
    cl = cfg.get("classification", {})
    s.url_col = cl.get("url_col", s.url_col)
    s.only_update_nulls = bool(cl.get("only_update_nulls", True))
    s.rules = [(p["label"], p["pattern"], list(p.get("flags", []) or [])) for p in cl.get("patterns", [])]
    rl = cfg.get("relabel", {})
    s.where_other_sql = rl.get("select_where_other_sql", s.where_other_sql)
    s.batch_size = int(rl.get("batch_size", s.batch_size))
    s.max_batches = int(rl.get("max_batches", s.max_batches))
    s.taxonomy = list(rl.get("taxonomy") or s.taxonomy)
    return s


def read_settings(spark: SparkSession, path: str) -> Settings:
    return parse_settings(read_config_text(spark, path))
