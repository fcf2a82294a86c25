"""Operators on DataFrames of block-ordered rows, block ranges and ledgers."""
