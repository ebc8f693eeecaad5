"""Reusable DataFrame operators: deduplication, lineage, change detection, evolution."""
