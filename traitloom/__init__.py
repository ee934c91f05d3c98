"""Molecular-phenotype preparation on Spark: every public function maps DataFrames to DataFrames."""
