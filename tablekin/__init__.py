"""Describe, check and synthesise sets of related tables with Spark DataFrames."""
