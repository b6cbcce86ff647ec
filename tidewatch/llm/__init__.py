"""Operators for cleaning, scoring and packing training documents, and their queries."""
