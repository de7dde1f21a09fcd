"""Per-key results over keys of very uneven size.

Everything is an algebraic aggregate, so each task folds its rows into a hash table of partial
states (which spills when full) and only those states are shuffled: a key that holds a third of
all rows contributes one state per task. Distinct counts, which have no small state, run as two
such steps: first over (key, value), then over the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_totals(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows of each stored, non-null value of each field: field_name, key_value, n_rows.

    The fields are first counted together, so that one pass and one small shuffle serve them all.
    Values are compared as stored (case and blanks count). No rows give no result.
    """
    together = rows.groupBy(*fields).agg(F.count("*").alias("n"))
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("key_value")) for f in fields]))
    return (
        together.select(pairs.alias("k"), "n")
        .where("k.key_value is not null")
        .groupBy("k.field_name", "k.key_value")
        .agg(F.sum("n").alias("n_rows"))
    )


def heavy_keys(rows: DataFrame, fields: Sequence[str], share: float = 0.04) -> DataFrame:
    """Values that stand in more than ``share`` of all rows (at most 1/share per field)."""
    total = rows.select(F.count("*").alias("n")).scalar()
    return key_totals(rows, fields).where(F.col("n_rows") > F.lit(share) * total)


def per_key(
    rows: DataFrame,
    key: str,
    measures: dict[str, Column],
    distinct: dict[str, str] | None = None,
) -> DataFrame:
    """One row per non-null ``key`` with algebraic ``measures`` and exact distinct counts.

    ``measures`` are named aggregate columns (count, sum, min, max, avg and the like). ``distinct``
    names result columns and the columns whose distinct non-null values they count. A key whose
    counted values are all null has the count 0.
    """
    keyed = rows.where(F.col(key).isNotNull())
    result = keyed.groupBy(key).agg(*[c.alias(n) for n, c in measures.items()])
    if not distinct:
        return result
    # All distinct counts in one pass: first every (key, column, value) once, then their numbers by key.
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).cast("string").alias("value")) for n, c in distinct.items()]))
    once = keyed.select(key, each.alias("__d")).where("__d.value is not null").groupBy(key, "__d.name", "__d.value").agg(F.lit(1).alias("__one"))
    counts = once.groupBy(key).agg(*[F.count(F.when(F.col("name") == n, 1)).alias(n) for n in distinct])
    return result.join(counts, key, "left").withColumns({n: F.coalesce(n, F.lit(0)) for n in distinct})
