"""Inputs and outputs: Parquet tables, snapshot tables, generated fixtures."""
