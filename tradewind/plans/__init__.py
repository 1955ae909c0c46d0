"""Plans: the query registry (one entry per operator) and the end-to-end pipeline."""
