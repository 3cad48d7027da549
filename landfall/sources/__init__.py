"""Schemas, captured inputs and the Parquet tables of the two zones."""
