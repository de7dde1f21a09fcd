"""Repair of CDR3 ends against germline segments, and guesses of missing segments.

Inputs repeat a lot, so everything runs over the distinct inputs and is joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curata.functions import seq
from curata.operators.patch import converted_names
from curata.session import checkpointed, hot_split_join, lookup_join, row_key, work_partitions


def germline(segments: DataFrame) -> DataFrame:
    """Amino acids of V and J segments: species, id, kind (V or J), seq_aa."""
    kind = F.upper(F.substring("segment", 1, 1))
    amino = F.when(kind == "V", seq.translated(seq.germline_v(F.col("seq"), F.col("ref")))).otherwise(
        seq.translated(seq.germline_j(F.col("seq"), F.col("ref")), backwards=True)
    )
    return segments.where(F.lower("segment").rlike("^[vj]")).select("species", "id", kind.alias("kind"), amino.alias("seq_aa"))


def closest_segments(names: DataFrame, segments: DataFrame, conversions: DataFrame | None = None) -> DataFrame:
    """The listed segment closest to each distinct (species, segment_id); the name itself if none is.

    Species are compared in any letter case.
    """
    distinct = names.where("segment_id is not null").select("species", "segment_id").distinct()
    named = distinct.withColumn("name", F.col("segment_id"))
    if conversions is not None:
        named = converted_names(named, conversions, "name")
    tried = named.select("species", F.lower("species").alias("__species"), "segment_id", F.posexplode(seq.segment_candidates(F.col("name"))).alias("pos", "id"))
    listed = segments.select(F.lower("species").alias("__species"), "id").distinct()
    found = lookup_join(tried, listed, ["__species", "id"], "inner").groupBy("species", "segment_id").agg(F.min_by("id", "pos").alias("found"))
    # A null species has no listed segment, so the plain join gives it its own name.
    return named.join(found, ["species", "segment_id"], "left").select("species", "segment_id", F.coalesce("found", "name").alias("closest_id"))


def guessed_segments(sequences: DataFrame, parts: DataFrame, five_prime: bool) -> DataFrame:
    """Segment whose part is the longest prefix (or suffix) of each distinct (species, gene, cdr3).

    ``parts`` holds species, gene, part and segment. Prefixes run from four residues before the end
    down to two, suffixes from the third residue on; sequences without a match get no row.
    """
    distinct = sequences.where("cdr3 is not null").select("species", "gene", "cdr3").distinct()
    n = F.length("cdr3")
    if five_prime:
        lengths = F.when(n >= 6, F.sequence(F.lit(2), n - 4))
        tried = distinct.withColumn("size", F.explode(lengths)).withColumn("part", F.substring("cdr3", F.lit(1), F.col("size")))
    else:
        starts = F.when(n >= 6, F.sequence(F.lit(2), n - 4))
        tried = distinct.withColumn("start", F.explode(starts)).withColumn("part", F.substring("cdr3", F.col("start") + 1, n)).withColumn("size", n - F.col("start"))
    found = lookup_join(tried, parts.groupBy("species", "gene", "part").agg(F.min("segment").alias("segment")), ["species", "gene", "part"], "inner")
    return found.groupBy("species", "gene", "cdr3").agg(F.max_by("segment", "size").alias("segment_id"))


def _one_side(inputs: DataFrame, listed: str, segments: DataFrame, closest: DataFrame, five_prime: bool) -> DataFrame:
    """Best repair of one end over a comma list of segments; ties go to the first of the list."""
    cdr3 = F.col("text") if five_prime else F.reverse("text")
    each = inputs.select("*", F.posexplode(F.split(F.coalesce(listed, F.lit("")), ",")).alias("pos", "segment_id"))
    named = lookup_join(each, closest, ["species", "segment_id"]).withColumn("id", F.coalesce("closest_id", "segment_id"))
    listed = segments.select(F.lower("species").alias("__species"), "id", "seq_aa").dropDuplicates(["__species", "id"])
    sought = lookup_join(named.withColumn("__species", F.lower("species")), listed, ["__species", "id"]).drop("__species")
    segment = F.col("seq_aa") if five_prime else F.reverse("seq_aa")
    fixed = sought.withColumn("hit", seq.kmer_hit(segment, cdr3)).withColumn("fix", seq.one_sided_fix(segment, cdr3, F.col("hit")))
    best = F.min_by(F.struct("id", "fix"), F.struct("fix.rank", "pos")).alias("best")
    return fixed.groupBy(*inputs.columns).agg(best)


def fixed_both(inputs: DataFrame, segments: DataFrame, conversions: DataFrame | None = None) -> DataFrame:
    """Repair of both ends of each distinct (species, cdr3, v, j): the V end first, then the J end.

    ``segments`` is the germline table. Result: the inputs and ``fix``, a struct of cdr3, cdr3_old,
    fix_needed, good, v_end, j_start (-1 where that end failed), v_id, v_fix_type, v_canonical,
    j_id, j_fix_type, j_canonical. v and j may be comma lists; a null one is a bad segment.
    """
    keys = ["species", "cdr3", "v", "j"]
    distinct = checkpointed(inputs.where("cdr3 is not null").select(*keys).distinct())
    names = distinct.select("species", F.explode(F.split(F.concat_ws(",", "v", "j"), ",")).alias("segment_id")).where("segment_id <> ''")
    closest = checkpointed(closest_segments(names, segments, conversions))
    # Few bytes but much work a row: spread by number, not by size. Both ends then work in place.
    spread = distinct.repartition(work_partitions(distinct), *keys).withColumn("text", F.col("cdr3"))
    v = _one_side(spread, "v", segments, closest, five_prime=True).select(*keys, F.col("best").alias("v_best"), F.col("best.fix.cdr3").alias("text"))
    both = _one_side(v, "j", segments, closest, five_prime=False).withColumnRenamed("best", "j_best")
    cdr3, vx, jx = F.reverse("j_best.fix.cdr3"), F.col("v_best.fix.x"), F.col("j_best.fix.x")
    j_start = F.when(jx < 0, jx).otherwise(F.length(cdr3) - jx)
    good = (F.col("v_best.fix.rank") < seq.GOOD_FIXES) & (F.col("j_best.fix.rank") < seq.GOOD_FIXES)
    return both.select(
        *keys,
        F.struct(
            cdr3.alias("cdr3"),
            F.col("cdr3").alias("cdr3_old"),
            (cdr3 != F.col("cdr3")).alias("fix_needed"),
            good.alias("good"),
            cdr3.rlike("[FW]$").alias("j_canonical"),
            F.col("j_best.fix.fix_type").alias("j_fix_type"),
            F.col("j_best.id").alias("j_id"),
            j_start.alias("j_start"),
            cdr3.startswith("C").alias("v_canonical"),
            vx.alias("v_end"),
            F.col("v_best.fix.fix_type").alias("v_fix_type"),
            F.col("v_best.id").alias("v_id"),
        ).alias("fix"),
    )


def fix_json(fix: str) -> F.Column:
    """A repair as JSON, keys in alphabetical order."""
    names = {"cdr3": "cdr3", "cdr3_old": "cdr3_old", "fixNeeded": "fix_needed", "good": "good", "jCanonical": "j_canonical", "jFixType": "j_fix_type", "jId": "j_id", "jStart": "j_start", "vCanonical": "v_canonical", "vEnd": "v_end", "vFixType": "v_fix_type", "vId": "v_id"}
    document = F.to_json(F.struct(*[F.col(f"{fix}.{c}").alias(n) for n, c in names.items()]), {"ignoreNullFields": "false"})
    return F.when(F.col(fix).isNotNull(), document)


def repaired(rows: DataFrame, segments: DataFrame, parts: DataFrame, conversions: DataFrame | None = None) -> DataFrame:
    """Records with missing segments guessed, both chains repaired and cdr3fix_alpha, cdr3fix_beta added.

    V and J become the closest listed names; chains without CDR3 lose theirs. Guesses and repairs
    are made once per distinct (species, CDR3, V, J) and joined back once per chain, with inputs
    that many records share split.
    """
    rows = checkpointed(rows)  # read for the inputs of either chain and once more for the records
    tables = {}
    for chain, gene in (("alpha", "TRA"), ("beta", "TRB")):
        columns = {"species": "species", "cdr3": f"cdr3_{chain}", "v": f"v_{chain}", "j": f"j_{chain}"}
        keyed = rows.select(*[F.col(c).alias(n) for n, c in columns.items()]).select("*", *row_key(["species", "cdr3", "v", "j"]))
        inputs = checkpointed(keyed.groupBy("__k1", "__k2").agg(*[F.first(c).alias(c) for c in columns], F.count("*").alias("__n")))
        filled = inputs.where("cdr3 is not null").drop("__n")
        for end, five_prime in (("v", True), ("j", False)):
            missing = inputs.where(F.col("cdr3").isNotNull() & F.col(end).isNull()).select("species", F.lit(gene).alias("gene"), "cdr3")
            guesses = guessed_segments(missing, parts, five_prime).select("species", "cdr3", F.col("segment_id").alias("__guess"))
            filled = filled.join(guesses, ["species", "cdr3"], "left").withColumn(end, F.coalesce(end, "__guess")).drop("__guess")
        filled = checkpointed(filled)
        fixes = fixed_both(filled, segments, conversions)
        same = [fixes[c].eqNullSafe(filled[c]) for c in ("species", "cdr3", "v", "j")]
        fixed = filled.join(fixes, same).select("__k1", "__k2", F.col("fix").alias(f"cdr3fix_{chain}"))
        tables[chain] = inputs.select("__k1", "__k2", "__n").join(fixed, ["__k1", "__k2"], "left")
    result = rows
    for chain, table in tables.items():
        fix = f"cdr3fix_{chain}"
        keyed = result.select("*", *row_key(["species", f"cdr3_{chain}", f"v_{chain}", f"j_{chain}"]))
        result = (
            hot_split_join(keyed, table, ["__k1", "__k2"], "__n")
            .drop("__k1", "__k2", "__n")
            .withColumns({f"cdr3_{chain}": F.col(f"{fix}.cdr3"), f"v_{chain}": F.nullif(F.col(f"{fix}.v_id"), F.lit("")), f"j_{chain}": F.nullif(F.col(f"{fix}.j_id"), F.lit(""))})
        )
    return result


def in_parts(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows in parts of consecutive ranges of ``order``, sorted, with the number of their part."""
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())


def in_order(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows numbered 1..n in a total order without gathering them in one task.

    One exchange sorts the rows by range and they are written in that order. A row's place in its
    part is the low end of ``monotonically_increasing_id``; the rows before a part come from one
    count per part, which is all that the last step needs besides the written rows.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    fixed = checkpointed(ranged)
    part, place = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    counts = fixed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = counts.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    # One row per part.
    numbered = fixed.withColumn("__part", part).join(F.broadcast(before), "__part")
    return numbered.withColumn(name, place + 1 + F.col("__before")).drop("__part", "__id", "__before")
