"""Operational-fact analytics on Spark DataFrames: parse, classify, seal, verify and query log facts."""
