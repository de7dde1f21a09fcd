"""Duplicates hidden by formatting: collapse, count copies, and keep the earliest.

Incremental ledger: one row per canonical key (a 128-bit hash) with its count and its earliest
representative, spread over buckets of the key. Each batch is aggregated first, then joined to the
buckets it touches by a full outer join that adds counts and keeps the earlier representative.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.session import checkpointed, hot_split_join, shared_path

#: Buckets of a new ledger, and rows a bucket holds on average before their number doubles.
BUCKETS = 8
BUCKET_ROWS = 4_000_000

_QUOTED = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def letters_and_digits(c: Column) -> Column:
    """Letters and digits of a text in order, lower case; null as blank."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", "")


def canonical_fields(c: Column) -> Column:
    """Named fields of a text in a canonical order, each as name=value of letters and digits.

    Fields stand as name=value or name:value between semicolons, bars or line ends, or as the
    members of one JSON object. A piece without a name goes on the value before it; at the start of
    a text it has the empty name. Fields without a value are left out (null equals blank).
    """
    text = F.trim(F.coalesce(c, F.lit("")))
    pieces = F.split(text, r"[;|\n\r]+(?=[^;|\n\r:=]*[:=])")
    broken = F.split(F.regexp_replace(text, r"^\{\s*|\s*\}$", ""), rf",\s*(?={_QUOTED}\s*[:=])")  # braces, but no JSON

    def named(piece: Column) -> Column:
        parts = F.split(piece, "[:=]", 2)
        return F.when(F.size(parts) > 1, _field(parts[0], parts[1])).otherwise(_field(F.lit(""), piece))

    # Numbers are quoted, for the reader would round them. In a list, text behind the object is an
    # error and not passed over.
    marked = F.regexp_replace(F.translate(text, "\u0001", ""), rf"({_QUOTED})|(-?\d[\d.eE+\-]*+)", "$1\u0001$2\u0001")
    quoted = F.translate(F.replace(marked, F.lit("\u0001\u0001"), F.lit("")), "\u0001", '"')
    objects = F.from_json(F.concat(F.lit("["), quoted, F.lit("]")), "array<map<string,string>>")
    members = F.transform(F.flatten(F.transform(objects, lambda m: F.map_entries(m))), lambda e: _field(e["key"], e["value"]))
    flat = F.transform(F.when(text.startswith("{"), broken).otherwise(pieces), named)
    canonical = F.coalesce(F.when(text.startswith("{"), members), flat)
    return F.array_join(F.array_sort(F.filter(canonical, lambda p: ~p.endswith("="))), ";")


def _field(name: Column, value: Column) -> Column:
    return F.concat(letters_and_digits(name), F.lit("="), letters_and_digits(value))


def composed(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with their text ``columns`` in composed form (NFC), so that a letter and its accent are one."""

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in columns:
                k = batch.schema.get_field_index(c)
                batch = batch.set_column(k, c, pc.utf8_normalize(batch.column(k), form="NFC"))
            yield batch

    return rows.mapInArrow(compose, rows.schema)


def keyed(rows: DataFrame, plain: Sequence[str], named: Sequence[str], id_column: str, batch_column: str | None = None) -> DataFrame:
    """id, k1, k2, batch: the canonical key of each row over plain columns and columns of named fields.

    Keys are compared in composed form; only rows with other than ASCII characters need that step.
    """
    texts = [*plain, *named]
    batch = F.col(batch_column) if batch_column else F.lit(None).cast("string")
    key = F.concat_ws("\u0001", *[letters_and_digits(F.col(c)) for c in plain], *[canonical_fields(F.col(c)) for c in named])
    foreign = F.concat_ws("", *texts).rlike(r"[^\x00-\x7f]|\\u")  # or written as a JSON escape

    def keys(chosen: Column) -> DataFrame:
        return rows.where(chosen).select(F.col(id_column).alias("id"), batch.alias("batch"), key.alias("key"))

    whole = keys(~foreign).unionByName(composed(keys(foreign), ["key"]))
    return whole.select("id", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit("second"), F.reverse("key")).alias("k2"), "batch")


def counted(keys: DataFrame) -> DataFrame:
    """A batch as ledger rows: k1, k2, n_copies, first_id. Partial counts combine before the shuffle."""
    return keys.groupBy("k1", "k2").agg(F.count("*").alias("n_copies"), F.min("id").alias("first_id"))


def merged(ledger: DataFrame, batch: DataFrame) -> DataFrame:
    """Ledger with a counted batch added: counts add up, the earlier representative stays."""
    b = batch.select("k1", "k2", F.col("n_copies").alias("more"), F.col("first_id").alias("other"))
    both = ledger.join(b, ["k1", "k2"], "full_outer")
    return both.select(
        "k1",
        "k2",
        (F.coalesce("n_copies", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_copies"),
        F.least("first_id", "other").alias("first_id"),  # least passes over nulls
    )


LEDGER = "k1 bigint, k2 bigint, n_copies bigint, first_id bigint"


class Ledger:
    """A ledger kept as Parquet at ``path`` in buckets of the key, rewritten bucket by bucket.

    Each update writes the buckets it touches to a new folder and then one small version file that
    names every bucket's current folder, so readers never see half an update, and an update that
    fails leaves the last version in force. Folders that no bucket uses any more are deleted one
    update later. Buckets are a power of two and double as soon as one holds more than
    ``bucket_rows`` rows on average, so a bucket stays one task's work however long the ledger.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS) -> None:
        self.spark, self.path, self.bucket_rows = spark, path.rstrip("/"), bucket_rows
        self.state: dict = self._stored() or {"version": 0, "buckets": buckets, "rows": 0, "folders": {}, "unused": []}

    def _fs(self, name: str):  # noqa: ANN202
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _stored(self) -> dict | None:
        fs, place = self._fs("versions")
        if not fs.exists(place):
            return None
        names = [s.getPath().getName() for s in fs.listStatus(place) if s.getPath().getName().endswith(".json")]
        if not names:
            return None
        text = self.spark.read.text(f"{self.path}/versions/{max(names)}", wholetext=True).first()[0]
        return json.loads(text)

    def _commit(self, state: dict) -> None:
        """Write the version file under another name and rename it, which is one step; then drop old folders."""
        fs, place = self._fs(f"versions/v{state['version']:012d}.json.new")
        out = fs.create(place, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        fs.rename(place, self._fs(f"versions/v{state['version']:012d}.json")[1])
        for folder in self.state["unused"]:
            fs.delete(self._fs(folder)[1], True)
        fs.delete(self._fs(f"versions/v{state['version'] - 2:012d}.json")[1], True)
        self.state = state

    def bucket(self, buckets: int) -> Column:
        return F.pmod("k1", F.lit(buckets)).cast("int")

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows of the ledger, of all buckets or of some."""
        wanted = [b for b in self.state["folders"] if buckets is None or int(b) in set(buckets)]
        folders = sorted({f"{self.path}/{self.state['folders'][b]}/bucket={b}" for b in wanted})
        return self.spark.read.schema(LEDGER).parquet(*folders) if folders else self.spark.createDataFrame([], LEDGER)

    def add(self, keys: DataFrame) -> None:
        """Count a batch of keyed rows and merge it into the buckets that it touches."""
        state, version = self.state, self.state["version"] + 1
        counts = checkpointed(counted(keys).withColumn("bucket", self.bucket(state["buckets"])))
        touched = [r[0] for r in counts.select("bucket").distinct().collect()]  # at most one row per bucket
        self._write(merged(self.read(touched), counts), version, state["buckets"], set(touched))
        if self.state["rows"] > self.bucket_rows * self.state["buckets"]:
            self._write(self.read(), self.state["version"] + 1, self.state["buckets"] * 2, None)

    def _write(self, rows: DataFrame, version: int, buckets: int, touched: set[int] | None) -> None:
        """Write new folders of the touched buckets (None: of all) and make them current."""
        folder = f"v{version}"
        rows.withColumn("bucket", self.bucket(buckets)).repartition(F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{folder}")
        written = self.spark.read.schema(f"{LEDGER}, bucket int").parquet(f"{self.path}/{folder}").groupBy("bucket").agg(F.count("*")).collect()  # from Parquet footers
        kept = {} if touched is None else {b: f for b, f in self.state["folders"].items() if int(b) not in touched}
        sizes = dict(self.state.get("sizes", {})) if touched is not None else {}
        sizes |= {str(b): n for b, n in written}
        folders = kept | {str(b): folder for b, _ in written}
        before = {f"{f}/bucket={b}" for b, f in self.state["folders"].items()} - {f"{f}/bucket={b}" for b, f in folders.items()}
        self._commit({"version": version, "buckets": buckets, "rows": sum(sizes.values()), "sizes": sizes, "folders": folders, "unused": sorted(before)})


def ledger_of(keys: DataFrame, most: int = 4, buckets: int = BUCKETS) -> DataFrame:
    """Ledger of all keyed rows, kept in the shared folder and built batch by batch.

    Each batch is read once. More than ``most`` batches are added in groups by a hash of the batch:
    counts and minima are the same in any grouping, and so any number of batches costs ``most``
    updates here, where all are at hand at once.
    """
    ledger = Ledger(keys.sparkSession, shared_path(keys.sparkSession, "ledger"), buckets)
    found = [r[0] for r in keys.select("batch").distinct().limit(most + 1).collect()]
    if len(found) > most:
        keys, found = keys.withColumn("batch", F.pmod(F.xxhash64("batch"), F.lit(most))), list(range(most))
    for b in sorted(found, key=lambda b: (b is None, str(b))):
        ledger.add(keys.where(F.col("batch").eqNullSafe(F.lit(b))))
    return ledger.read()


def copies(keys: DataFrame, ledger: DataFrame) -> DataFrame:
    """Every row that repeats an earlier one: first_id (the group's smallest id) and copy_id.

    The few keys that hold much of all rows are joined by broadcast, all others by a shuffle in
    which no key is large; a group of copies is never gathered in one task. Rows in which all
    columns are null or blank are copies of one another. An empty table gives no rows. Of rows
    that share the smallest id of their group none is reported.
    """
    repeated = ledger.where("n_copies > 1")
    found = hot_split_join(keys.select("id", "k1", "k2"), repeated, ["k1", "k2"], "n_copies")
    return found.where("id <> first_id").select("first_id", F.col("id").alias("copy_id"))


def collapsed(rows: DataFrame, ledger: DataFrame, id_column: str = "line_id") -> DataFrame:
    """The earliest row of each group with the number of its copies."""
    return rows.join(ledger.select(F.col("first_id").alias(id_column), "n_copies"), id_column)
