"""Granary: curation, reconciliation and matching operators as Spark DataFrame transformations."""
