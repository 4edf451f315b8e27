"""Compositions of operators: daily pipelines, date-range backfill, registered queries."""
