"""Operators over DataFrames: rollups, latest state, quality, rules and normalizers."""
