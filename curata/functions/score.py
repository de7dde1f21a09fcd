"""Confidence of records: frequencies, methods, scores and hashes, as column builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that mark a method, and score cutoffs (medium, high, very high) by species and chain.
SORTING = ["sort", "beads", "separation", "stain"]
CULTURE = ["culture", "cloning"]
PGEN_CUTOFFS = {
    ("HomoSapiens", "TRB"): (-15.6, -12.1, -7.3),
    ("HomoSapiens", "TRA"): (-15.1, -10.1, -5.7),
    ("MusMusculus", "TRB"): (-8.2, -6.6, -5.4),
    ("MusMusculus", "TRA"): (-15.1, -10.1, -5.7),
}
HASHED = ["cdr3_alpha", "v_alpha", "j_alpha", "cdr3_beta", "v_beta", "j_beta", "mhc_a", "mhc_b", "antigen_epitope"]


def _contains_any(c: Column, words: list[str]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | c.contains(w)
    return found


def _fraction(c: Column) -> tuple[Column, Column]:
    """Texts before and after the first run of slashes."""
    single = F.when(c.contains("//"), F.regexp_replace(c, "/+", "/")).otherwise(c)
    return F.split_part(c, F.lit("/"), F.lit(1)), F.split_part(single, F.lit("/"), F.lit(2))


def frequency(c: Column) -> Column:
    """Number behind a/b, a//b, a% or a decimal; 0 for null; null for text that is none of these."""
    part, whole = _fraction(c)
    ratio = F.try_divide(part.try_cast("double"), whole.try_cast("double"))
    percent = F.substring(c, F.lit(1), F.length(c) - 1).try_cast("double") / 100
    return F.when(c.isNull(), 0.0).when(c.contains("/"), ratio).when(c.endswith("%") & (F.length(c) > 1), percent).otherwise(c.try_cast("double"))


def cell_count(c: Column) -> Column:
    """Numerator of a/b or a//b; 0 for anything else."""
    return F.when(c.contains("/"), F.coalesce(_fraction(c)[0].try_cast("int"), F.lit(0))).otherwise(0)


def is_sorting(c: Column) -> Column:
    return F.coalesce(_contains_any(F.lower(c), SORTING), F.lit(False))


def is_stimulation(c: Column) -> Column:
    return F.coalesce(F.lower(c).contains("targets"), F.lit(False))


def is_culture(c: Column) -> Column:
    return F.coalesce(_contains_any(F.lower(c), CULTURE), F.lit(False))


def is_direct(c: Column) -> Column:
    return F.coalesce(F.lower(c).contains("direct"), F.lit(False))


def with_record_score(rows: DataFrame, name: str = "record_score") -> DataFrame:
    """Rows with the confidence 0 to 3 of each record by itself.

    The score is the lesser of the sequencing score and the sum of the specificity scores; a
    structure gives 3. Shared parts are columns of their own, so each is computed once a row.
    """
    identification, verification, singlecell = F.col("method_identification"), F.col("method_verification"), F.trim("method_singlecell")
    parts = rows.withColumns(
        {
            "__f": F.coalesce(frequency(F.col("method_frequency")), F.lit(0.0)),
            "__cells": cell_count(F.col("method_frequency")),
            "__id": F.coalesce(F.lower(identification), F.lit("")),
            "__ver": F.coalesce(F.lower(verification), F.lit("")),
            "__seq": F.coalesce(F.lower(F.trim("method_sequencing")), F.lit("")),
            "__single": F.coalesce(singlecell != "", F.lit(False)) & (F.lower(singlecell) != "no"),
        }
    )
    f, cells, found_by, verified_by, method = (F.col(c) for c in ("__f", "__cells", "__id", "__ver", "__seq"))
    read = (
        F.when(F.col("__single"), 3)
        .when(method == "sanger", F.when(cells >= 2, 3).otherwise(2))
        .when(method == "amplicon-seq", F.when(f >= 0.01, 3).otherwise(1))
        .otherwise(1)
    )
    enriched = (
        F.when(_contains_any(found_by, CULTURE), (f >= 0.5).cast("int"))
        .when(_contains_any(found_by, SORTING), (f >= 0.05).cast("int"))
        .when(found_by.contains("targets"), (f >= 0.25).cast("int"))
        .otherwise(0)
    )
    verified = F.when(verified_by.contains("direct"), 3).when(verified_by.contains("targets"), 2).when(_contains_any(verified_by, SORTING), 1).otherwise(0)
    staged = parts.withColumns({"__read": read, "__enriched": enriched, "__verified": verified})
    sequenced = F.when(F.col("__verified").isin(1, 2), 3).otherwise(F.col("__read"))
    structure = F.coalesce(F.trim("meta_structure_id") != "", F.lit(False))
    result = F.when(structure, 3).otherwise(F.least(sequenced, F.col("__enriched") + F.col("__verified")))
    return staged.select(*rows.columns, result.alias(name))


def web_method(c: Column) -> Column:
    """Display group of an identification method."""
    m = F.lower(F.coalesce(c, F.lit("")))
    return F.when(m.contains("sort"), "sort").when(m.rlike("culture|cloning|targets"), "culture").otherwise("other")


def web_method_seq(singlecell: Column, sequencing: Column) -> Column:
    """Display group of a sequencing method; any single-cell entry counts, even "no"."""
    m = F.lower(F.coalesce(sequencing, F.lit("")))
    return F.when(F.coalesce(singlecell != "", F.lit(False)), "singlecell").when(m.contains("sanger"), "sanger").when(m.contains("-seq"), "amplicon").otherwise("other")


def pgen_bin(log10_pgen: Column, species: Column, gene: Column) -> Column:
    """Score 0 to 3 from the log10 generation probability; intervals are closed on the right."""
    result = F.lit(0)
    for (name, chain), (medium, high, very_high) in PGEN_CUTOFFS.items():
        bins = F.when(log10_pgen > 0, 0).when(log10_pgen > very_high, 3).when(log10_pgen > high, 2).when(log10_pgen > medium, 1).otherwise(0)
        result = F.when((species == name) & (gene == chain), bins).otherwise(result)
    return result


def tcr_hash() -> Column:
    """SHA-256 of nine columns run together; null if any is null."""
    return F.sha2(F.concat(*HASHED), 256)
