"""Operators of a training-data pipeline: deduplication, filtering, extraction,
token counting and packing, exact search.  Nothing outside this subpackage
imports it; its queries are registered by ``__spark_entry__.py``."""
