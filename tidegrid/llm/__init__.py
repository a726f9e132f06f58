"""Operators for preparing text corpora, their queries and the SQL those must agree with."""
