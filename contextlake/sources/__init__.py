"""Readers and normalizers that turn raw inputs into DataFrames."""
