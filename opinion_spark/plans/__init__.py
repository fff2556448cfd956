"""End-to-end compositions of the operators (the analysis' three entries)."""
