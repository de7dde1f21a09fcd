"""Session helpers shared by all operators: table loading, size-checked broadcasts, checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Largest side, in rows and in bytes of text, that may be sent to every executor. Larger sides are shuffled.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20

#: Copies of a small side in a salted join; a hot key's rows spread over as many tasks.
SALTS = 16


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir`` (a file or a folder of files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores if its files give fewer partitions than there are cores.

    A large table has splits enough and stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def work_partitions(df: DataFrame) -> int:
    """Partitions for rows that are few bytes but much work: no fewer than cores or shuffle partitions."""
    spark = df.sparkSession
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written as a table to the shared checkpoint folder and read back.

    This cuts the lineage, survives lost executors, and lets later steps read only the columns
    they need. Tables are deleted when the application ends.
    """
    path = shared_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset and all tasks run on this machine, as in tests, a local folder is set. On a
    cluster an unset folder is an error: each executor would write to its own disk.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="curata-checkpoint-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    path = f"{checkpoint_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def fits(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` may be broadcast: within ``rows`` rows and ``size`` bytes, written as text.

    Reads no further than the bound on rows.
    """
    n, held = df.limit(rows + 1).agg(F.count("*"), F.sum(F.octet_length(F.to_json(F.struct(*[df[c] for c in df.columns]))))).first()
    return n <= rows and (held or 0) <= size


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``big`` to ``small``, which holds at most one row per key.

    ``small`` is broadcast if it has at most ``max_rows`` rows and BROADCAST_BYTES (measured first). Beyond that both
    sides are shuffled on the key and a salt, with ``small`` repeated once per salt, so that a key
    that holds a third of ``big`` is spread over ``salts`` tasks. Spark takes the copies for as few
    bytes as the file they come from and would gather them in the driver, hence the hint. Null keys
    match nothing.
    """
    if fits(small, max_rows):
        return big.join(F.broadcast(small), on, how)
    salted = big.withColumn("__salt", F.pmod(F.xxhash64(*big.columns), F.lit(salts)).cast("int"))
    copies = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies.hint("merge"), [*on, "__salt"], how).drop("__salt")


def row_key(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes, __k1 and __k2, over columns in which null differs from every text."""
    text = F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in columns])
    return [F.xxhash64(text).alias("__k1"), F.xxhash64(F.lit("second"), F.reverse(text)).alias("__k2")]


def hot_split_join(big: DataFrame, small: DataFrame, on: list[str], weight: str, parts: int = 2000, how: str = "inner") -> DataFrame:
    """Join of ``big`` to ``small``, which holds one row per key and, in ``weight``, how many rows of
    ``big`` that key has at most.

    ``small`` is written once to the checkpoint folder. A key of more than a ``parts``-th of the
    total weight, of which there can be no more than ``parts``, is split: its rows are spread over
    as many salts as it has such parts, and its one row of ``small`` is repeated for each. So no
    join task is large, and ``big`` is read once. Without such keys it is one plain join.
    """
    kept = checkpointed(small)
    total, most = kept.agg(F.sum(weight), F.max(weight)).first()
    least = (total or 0) // parts + 1
    if (most or 0) <= least:
        return big.join(kept, on, how)
    salts = F.ceil(F.col(weight) / F.lit(least)).cast("int")
    hot = F.broadcast(kept.where(F.col(weight) > least).select(*on, salts.alias("__salts")))  # at most ``parts`` rows
    plain = [f.name for f in big.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    salt = F.pmod(F.xxhash64(*plain), F.coalesce("__salts", F.lit(1))).cast("int")
    salted = big.join(hot, on, "left").withColumn("__salt", salt).drop("__salts")
    copies = kept.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.greatest(salts, F.lit(1)) - 1)))
    return salted.join(copies, [*on, "__salt"], how).drop("__salt")


def blank_to_null(c: Column) -> Column:
    """Trimmed text, null if nothing is left."""
    trimmed = F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")
    return F.when(trimmed != "", trimmed)
