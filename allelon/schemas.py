"""Fixed schemas of the tables that operators exchange; ids are always strings."""

BLAST10 = "qseqid string, sseqid string, pident double, length long, qstart long, qend long, sstart long, send long, sstrand string, slen long"
TBLASTN13 = (
    "qseqid string, sseqid string, pident double, length long, mismatch long, gapopen long, qstart long, qend long, "
    "sstart long, send long, evalue double, bitscore double, sseq string"
)
REPORT = "Accession string, Gene string, Mutation string, Status string, Phenotype string, Reference_PDB string, prediction_score double, prediction_source string"
EDGES = (
    "Node_1 string, Node_2 string, Node_1_Gene string, Node_2_Gene string, Node_1_Mutation string, Node_2_Mutation string, "
    "Frequency long, Avg_Biochemical_Severity double, Composite_Network_Score double"
)
DOCKING = (
    "Node_1 string, Node_2 string, mutation_network string, wt_affinity double, mut_affinity double, delta_delta_g double, "
    "confidence string, confidence_flags string, interpretation string, status string, center_x double, center_y double, center_z double"
)
#: The isolate columns that are kept; a fixed value.
ISOLATE_COLUMNS = (
    "Genome ID",
    "Antibiotic",
    "Resistant Phenotype",
    "isolation_country",
    "geographic_location",
    "latitude",
    "longitude",
    "collection_year",
    "host_group",
    "isolation_source",
    "disease",
)
