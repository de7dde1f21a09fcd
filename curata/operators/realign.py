"""Second-stage realignment: the segment whose codons explain most of a CDR3 end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.functions import seq
from curata.session import checkpointed, hot_split_join, lookup_join, row_key, work_partitions

# Least agreeing nucleotides, and residues a changed segment must gain.
LEAST_NUCLEOTIDES = 5
LEAST_GAIN = 2


def best_segments(sequences: DataFrame, segments: DataFrame) -> DataFrame:
    """Best V and J of each distinct (species, gene, cdr3): v_id, v_size, j_id, j_size (residues; -1 if none).

    ``segments`` holds species, gene, segment, id, ref, seq and ord, its order: among equally good
    segments the first holds. Only segments that agree in five nucleotides count.
    """
    distinct = sequences.where("cdr3 is not null").select("species", "gene", "cdr3").distinct()
    kind = F.upper(F.substring("segment", 1, 1))
    each = segments.where(F.lower("segment").rlike("^[vj]")).groupBy(F.lower("species").alias("__species"), "gene").agg(
        F.sort_array(F.collect_list(F.struct("ord", kind.alias("kind"), "id", "ref", "seq"))).alias("all")
    )  # the germline list of one species and gene
    own = distinct.repartition(work_partitions(distinct), "species", "gene", "cdr3").withColumn("__species", F.lower("species"))
    pairs = lookup_join(own, each, ["__species", "gene"]).withColumn("s", F.explode_outer("all")).drop("all", "__species")
    score = F.when(
        F.col("s.kind") == "V", seq.codon_score(F.col("cdr3"), seq.germline_v(F.col("s.seq"), F.col("s.ref")))
    ).otherwise(seq.codon_score(F.col("cdr3"), seq.germline_j(F.col("s.seq"), F.col("s.ref")), backwards=True))
    scored = pairs.withColumn("score", score)

    def best(k: str) -> list[F.Column]:
        fits = (F.col("s.kind") == k) & (F.col("score") >= LEAST_NUCLEOTIDES)
        top = F.max(F.when(fits, F.struct("score", -F.col("s.ord"), "s.id")))
        low = k.lower()
        return [top["id"].alias(f"{low}_id"), F.coalesce(F.floor(top["score"] / 3), F.lit(-1)).cast("int").alias(f"{low}_size")]

    return scored.groupBy("species", "gene", "cdr3").agg(*best("V"), *best("J"))


def updated(fixes: DataFrame, best: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Repairs updated by the best segments of their CDR3.

    ``fixes`` holds species, gene, cdr3 and the repair's v_id, v_end, v_fix_type, j_id, j_start and
    j_fix_type. A longer end of the same segment is a Realign, another segment that gains two
    residues a ChangeSegment; what was replaced stays in old_ columns.
    """
    b = best.select("species", "gene", "cdr3", *[F.col(c).alias(f"b_{c}") for c in ("v_id", "v_size", "j_id", "j_size")])
    rows = fixes.join(b, ["species", "gene", "cdr3"], "left")
    v_found, j_found = F.coalesce(F.col("b_v_size") != -1, F.lit(False)), F.coalesce(F.col("b_j_size") != -1, F.lit(False))
    v_same, j_same = F.col("b_v_id").eqNullSafe(F.col("v_id")), F.col("b_j_id").eqNullSafe(F.col("j_id"))
    start = F.length("cdr3") - F.col("b_j_size")
    v_kind = F.when(v_found & v_same & (F.col("b_v_size") > F.col("v_end")), "Realign").when(
        v_found & ~v_same & (F.col("b_v_size") - F.col("v_end") >= LEAST_GAIN), "ChangeSegment"
    )
    j_kind = F.when(j_found & j_same & (F.col("j_start") > start), "Realign").when(
        j_found & ~j_same & (F.col("j_start") - start >= LEAST_GAIN), "ChangeSegment"
    )
    marked = rows.withColumn("v_new", v_kind).withColumn("j_new", j_kind)
    v_new, j_new = F.col("v_new").isNotNull(), F.col("j_new").isNotNull()
    v_end = F.when(v_new, F.col("b_v_size")).otherwise(F.col("v_end"))
    j_start = F.when(j_new, start).otherwise(F.col("j_start"))
    return marked.select(
        *keep, "species", "gene", "cdr3",
        F.when(F.col("v_new") == "ChangeSegment", F.col("b_v_id")).otherwise(F.col("v_id")).alias("v_id"),
        v_end.alias("v_end"),
        F.coalesce("v_new", "v_fix_type").alias("v_fix_type"),
        F.when(F.col("j_new") == "ChangeSegment", F.col("b_j_id")).otherwise(F.col("j_id")).alias("j_id"),
        j_start.alias("j_start"),
        F.coalesce("j_new", "j_fix_type").alias("j_fix_type"),
        F.when(F.col("v_new") == "ChangeSegment", F.col("v_id")).alias("old_v_id"),
        F.when(v_new, F.col("v_end")).alias("old_v_end"),
        F.when(v_new, F.col("v_fix_type")).alias("old_v_fix_type"),
        F.when(F.col("j_new") == "ChangeSegment", F.col("j_id")).alias("old_j_id"),
        F.when(j_new, F.col("j_start")).alias("old_j_start"),
        F.when(j_new, F.col("j_fix_type")).alias("old_j_fix_type"),
        ((v_end != -1) & (j_start != -1)).alias("good"),
    )


def realigned(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """Repaired records with both chains realigned: cdr3fix_alpha, cdr3fix_beta and V and J updated.

    Each distinct repair is realigned once and joined back; repairs that many records share are split.
    """
    result = rows
    for chain, gene in (("alpha", "TRA"), ("beta", "TRB")):
        fix = f"cdr3fix_{chain}"
        fields = rows.schema[fix].dataType.fieldNames()
        keyed = result.withColumn("__fix", F.to_json(F.struct("species", fix))).select("*", *row_key(["__fix"])).drop("__fix")
        inputs = checkpointed(keyed.groupBy("__k1", "__k2").agg(F.first("species").alias("species"), F.first(fix).alias(fix), F.count("*").alias("__n")))
        flat = inputs.where(F.col(fix).isNotNull()).select("__k1", "__k2", "species", F.lit(gene).alias("gene"), f"{fix}.*")
        best = best_segments(flat.select("species", "gene", "cdr3"), segments)
        new = updated(flat, best, keep=["__k1", "__k2"])
        both = flat.select("__k1", "__k2", *[F.col(f).alias(f"own_{f}") for f in fields]).join(new, ["__k1", "__k2"])
        struct = F.struct(*[(F.col(f) if f in new.columns else F.col(f"own_{f}")).alias(f) for f in fields]).alias("__new")
        table = inputs.select("__k1", "__k2", "__n").join(both.select("__k1", "__k2", struct), ["__k1", "__k2"], "left")
        joined = hot_split_join(keyed, table, ["__k1", "__k2"], "__n").drop("__k1", "__k2", "__n", fix).withColumnRenamed("__new", fix)
        result = joined.withColumns({f"v_{chain}": F.nullif(F.col(f"{fix}.v_id"), F.lit("")), f"j_{chain}": F.nullif(F.col(f"{fix}.j_id"), F.lit(""))}).select(*rows.columns)
    return result


def change_counts(updates: DataFrame) -> DataFrame:
    """How often each kind of change was made, most frequent first."""
    kinds = F.explode(F.array(F.struct(F.lit("V").alias("end"), F.col("v_fix_type").alias("kind")), F.struct(F.lit("J").alias("end"), F.col("j_fix_type").alias("kind"))))
    return updates.select(kinds.alias("k")).where("k.kind in ('Realign', 'ChangeSegment')").groupBy("k.end", "k.kind").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "end", "kind")
