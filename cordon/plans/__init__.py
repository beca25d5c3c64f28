"""Plans: the query registry, its DuckDB oracle SQL, and the end-to-end audit run."""
