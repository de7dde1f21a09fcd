"""Small relational operators: comparison of two sets, documents to columns and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_comparison(left: DataFrame, right: DataFrame, names: tuple[str, str, str, str] = ("both", "left only", "right only", "any")) -> DataFrame:
    """Rows of two tables of the same columns as sets: ``kind`` and the columns.

    A row that stands in both is ``both``, in one is ``left only`` or ``right only``, and each row is
    once more under ``any``. Nulls equal each other and repeated rows count once. One aggregate over
    both tables tells all four, so a row that is repeated often is one partial state a task.
    """
    marked = left.select("*", F.lit(1).alias("__side")).unionByName(right.select("*", F.lit(2).alias("__side")))
    sides = marked.groupBy(*left.columns).agg(F.bit_or("__side").alias("__sides"))
    own = F.when(F.col("__sides") == 3, names[0]).when(F.col("__sides") == 1, names[1]).otherwise(names[2])
    return sides.select(F.explode(F.array(own, F.lit(names[3]))).alias("kind"), *left.columns)


def from_documents(rows: DataFrame, column: str, schema: str) -> DataFrame:
    """Rows with the fields that ``schema`` names in place of a column of JSON objects.

    Text that is no object, and fields that are missing or of another type, give nulls.
    """
    kept = [c for c in rows.columns if c != column]
    return rows.select(*kept, F.from_json(column, schema).alias("__document")).select(*kept, "__document.*")


def to_documents(rows: DataFrame, fields: Sequence[str], name: str) -> DataFrame:
    """Rows with ``fields`` as one JSON object, nulls kept, keys in the order given."""
    kept = [c for c in rows.columns if c not in fields]
    return rows.select(*kept, F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(name))
