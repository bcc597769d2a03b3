"""Operators for preparing text corpora: scoring, near-duplicates, mixing, packing and scans."""
