"""End-to-end chains: medallion ingestion and the daily decision."""
