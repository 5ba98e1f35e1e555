"""Whole pipelines, and the queries that show each operator."""
