"""Operators for training-data corpora: archives, text extraction, de-duplication, scoring, mixing,
tokenising, sharding and vector search, each a DataFrame -> DataFrame function.

Nothing outside this subpackage imports it; ``queries.py`` registers its queries."""
