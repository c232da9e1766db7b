"""Versioned change capture on Spark: capture, classify and inspect change data with DataFrames."""
