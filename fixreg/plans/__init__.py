"""Domain plans built from the generic operators: enrichment (E0–E14),
cohorts (K1–K15), exam grades (X0–X6) and the coverage report (R1)."""
