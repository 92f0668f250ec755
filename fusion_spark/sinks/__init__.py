"""Writers: partitioned tables between stages, delimited text and FASTA at the edge."""
