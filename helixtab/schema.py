"""Column names of the tables that operators read and write."""

from __future__ import annotations

# The columns of a mutation annotation table, in order.
MAF_COLUMNS = (
    "Hugo_Symbol", "Entrez_Gene_Id", "Center", "NCBI_Build", "Chromosome", "Start_Position", "End_Position", "Strand", "Variant_Classification",
    "Variant_Type", "Reference_Allele", "Tumor_Seq_Allele1", "Tumor_Seq_Allele2", "dbSNP_RS", "dbSNP_Val_Status", "Tumor_Sample_Barcode",
    "Matched_Norm_Sample_Barcode", "Match_Norm_Seq_Allele1", "Match_Norm_Seq_Allele2", "Tumor_Validation_Allele1", "Tumor_Validation_Allele2",
    "Match_Norm_Validation_Allele1", "Match_Norm_Validation_Allele2", "Verification_Status", "Validation_Status", "Mutation_Status", "Sequencing_Phase",
    "Sequence_Source", "Validation_Method", "Score", "BAM_File", "Sequencer", "t_ref_count", "t_alt_count", "n_ref_count", "n_alt_count", "Caller",
)
# Variant classes that change a protein.
FUNCTIONAL_CLASSES = ("Frame_Shift_Del", "Frame_Shift_Ins", "In_Frame_Del", "In_Frame_Ins", "Missense_Mutation", "Nonsense_Mutation", "Splice_Site")
# Reasons for which a rejected call may still be rescued.
RESCUABLE = ("alt_allele_in_normal", "nearby_gap_events", "possible_contamination", "triallelic_site", "DBSNP Site")
# Bits of an alignment's flag.
FLAG_PAIRED, FLAG_PROPER, FLAG_UNMAPPED, FLAG_MATE_UNMAPPED, FLAG_REVERSE, FLAG_MATE_REVERSE = 1, 2, 4, 8, 16, 32
FLAG_FIRST, FLAG_SECOND, FLAG_SECONDARY, FLAG_QC_FAIL, FLAG_DUPLICATE = 64, 128, 256, 512, 1024
