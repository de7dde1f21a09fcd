"""Field validators of the released checks, as column builders (true = accepted)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the released checks.
AMINO_ACIDS = "ARNDCQEGHILKMFPSTWYV"
SPECIES = ["homosapiens", "musmusculus", "rattusnorvegicus", "macacamulatta"]
MHC_CLASSES = ["MHCI", "MHCII"]
MHC_PATTERN = r"^HLA-[A-Z]+[0-9]?\*[0-9]{2}(:[0-9]{2,3}){0,3}$"
REFERENCE_PREFIXES = ["PMID:", "doi:", "http://", "https://"]


def sequence_ok(c: Column, legacy: bool = False) -> Column:
    """Amino acid sequence: null, or more than 3 residues of the 20-letter alphabet.

    ``legacy`` accepts 3 residues and the unknown residue X.
    """
    alphabet, least = (AMINO_ACIDS + "X", 3) if legacy else (AMINO_ACIDS, 4)
    return c.isNull() | ((F.length(c) >= least) & c.rlike(f"^[{alphabet}]+$"))


def mhc_ok(c: Column) -> Column:
    """MHC name: anything not starting with HLA, or a well-formed HLA allele; null is accepted."""
    return c.isNull() | ~c.startswith("HLA") | c.rlike(MHC_PATTERN)


def prefix_ok(c: Column, prefix: str) -> Column:
    """Null or starting with ``prefix``."""
    return c.isNull() | c.startswith(prefix)


def species_ok(c: Column) -> Column:
    """One of the four species names, in any letter case; null is refused."""
    return F.coalesce(F.lower(c).isin(SPECIES), F.lit(False))


def mhc_class_ok(c: Column) -> Column:
    """MHCI or MHCII; null is refused."""
    return F.coalesce(c.isin(MHC_CLASSES), F.lit(False))


def present_ok(c: Column) -> Column:
    """Not null."""
    return c.isNotNull()


def reference_ok(c: Column) -> Column:
    """Null, a known scheme prefix, or any text that contains "unpublished"."""
    known = F.lower(c).contains("unpublished")
    for prefix in REFERENCE_PREFIXES:
        known = known | c.startswith(prefix)
    return c.isNull() | known


#: Validator of each checked column, in the order of their messages.
VALIDATORS: dict[str, Callable[[Column], Column]] = {
    "cdr3_alpha": sequence_ok,
    "v_alpha": lambda c: prefix_ok(c, "TRAV"),
    "j_alpha": lambda c: prefix_ok(c, "TRAJ"),
    "cdr3_beta": sequence_ok,
    "v_beta": lambda c: prefix_ok(c, "TRBV"),
    "d_beta": lambda c: prefix_ok(c, "TRBD"),
    "j_beta": lambda c: prefix_ok(c, "TRBJ"),
    "species": species_ok,
    "mhc_a": mhc_ok,
    "mhc_b": mhc_ok,
    "mhc_class": mhc_class_ok,
    "antigen_epitope": sequence_ok,
    "antigen_gene": present_ok,
    "reference_id": reference_ok,
}
