"""Rule source (K2, C6): ordered (priority, label, pattern, flags) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_ROOT_DOMAIN, rule_pack
from ..schemas import RULE_SCHEMA


def default_rules(spark: SparkSession, host: str = DEFAULT_ROOT_DOMAIN) -> DataFrame:
    """The shipped rule pack for ``host`` as a rules DataFrame."""
    rows = [(i, label, pat, flags) for i, (label, pat, flags) in enumerate(rule_pack(host))]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def read_rules(spark: SparkSession, config_path: str) -> DataFrame:
    """K2: rules from a JSON config (``classification.patterns``); list order is priority."""
    cfg = spark.read.option("multiLine", True).json(config_path)
    return (cfg.select(F.posexplode("classification.patterns").alias("priority", "p"))
            .select(F.col("priority").cast("int").alias("priority"),
                    F.col("p.label").alias("label"), F.col("p.pattern").alias("pattern"),
                    F.coalesce(F.col("p.flags"), F.array().cast("array<string>")).alias("flags")))


def rules_as_list(rules: DataFrame) -> list[tuple[str, str, list[str]]]:
    """The rules of one config document, in priority order, on the driver."""
    rows = rules.orderBy("priority").collect()
    return [(r["label"], r["pattern"], list(r["flags"] or [])) for r in rows]
