"""Column groups of the record tables and their dotted file names."""

from __future__ import annotations

# The columns of the record tables.
COMPLEX = ["cdr3_alpha", "v_alpha", "j_alpha", "cdr3_beta", "v_beta", "d_beta", "j_beta", "species", "mhc_a", "mhc_b", "mhc_class", "antigen_epitope", "antigen_gene", "antigen_species", "reference_id"]
METHOD = ["method_identification", "method_frequency", "method_singlecell", "method_sequencing", "method_verification"]
META = ["meta_study_id", "meta_cell_subset", "meta_subject_cohort", "meta_subject_id", "meta_replica_id", "meta_clone_id", "meta_epitope_id", "meta_tissue", "meta_donor_MHC", "meta_donor_MHC_method", "meta_structure_id"]
EXTRA = ["chunk_id", "meta_subset_frequency", "comment", "submitter"]
ROW_META = ["meta_study_id", "meta_cell_subset", "meta_subject_cohort", "meta_subject_id", "meta_replica_id", "meta_clone_id", "meta_tissue"]
SIGNATURE = ["cdr3_alpha", "v_alpha", "j_alpha", "cdr3_beta", "v_beta", "j_beta", "species", "mhc_a", "mhc_b", "mhc_class", "antigen_epitope"]

ALL = COMPLEX + METHOD + META
ROW_SIGNATURE = COMPLEX + ROW_META


def dotted(name: str) -> str:
    """File name of an internal column: cdr3_beta -> cdr3.beta, meta_donor_MHC_method -> meta.donor.MHC.method."""
    return name.replace("_", ".")


def undotted(name: str) -> str:
    """Internal name of a file column."""
    return name.strip().replace(".", "_")
