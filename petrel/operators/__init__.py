"""DataFrame operators of the gene-network engine."""
