"""First-sighting-wins distinct (D1 over rows, D2 over a whole run).

``first_wins`` keeps, for every key, the row that comes first in a total
order given by ``order_cols``.  It is ``row_number() = 1`` over a window on
the key: Catalyst turns that into a partial ``WindowGroupLimit`` before the
shuffle, so even a key that holds a third of all rows sends at most one row
per map task across the network.  It never uses ``dropDuplicates`` in batch,
whose survivor is arbitrary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: Sequence[str] | str, order_cols: Sequence[str] | str,
               keep_null_keys: bool = False, descending: bool = False) -> DataFrame:
    """Keep the first row per key by ``order_cols`` (the last one with ``descending``).

    ``order_cols`` should be a total order.  Rows whose key is NULL are never
    folded together when ``keep_null_keys`` is set (a unique key lets NULLs
    through): such a row is partitioned on its own order tuple, so it stays
    alone, and the input is still read once.  Otherwise they are dropped.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in order_cols]
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    if keep_null_keys:
        alone = F.when(any_null, F.struct(*[F.col(c) for c in order_cols]))
        w = Window.partitionBy(*keys, alone.alias("__alone")).orderBy(*order)
        src = df
    else:
        w = Window.partitionBy(*keys).orderBy(*order)
        src = df.where(~any_null)
    return (src.withColumn("__rn", F.row_number().over(w))
            .where(F.col("__rn") == 1).drop("__rn"))


def run_distinct_links(links: DataFrame, key: str = "normalized_url",
                       order_cols: Sequence[str] = ("page_id", "pos")) -> DataFrame:
    """One row per normalised URL over the whole run, first sighting wins."""
    return first_wins(links, key, list(order_cols))
