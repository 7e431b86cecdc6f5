"""End-to-end jobs: each takes snapshot DataFrames and returns the tables it would hand on."""
