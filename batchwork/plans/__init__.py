"""End-to-end batch jobs (dict of named output DataFrames per job)."""
