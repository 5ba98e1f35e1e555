"""Operators over tables: extraction from pages, deduplication, frontiers, reports."""
