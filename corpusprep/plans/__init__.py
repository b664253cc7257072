"""Shuffle patterns shared by the operators: ordered scans, hot-key joins, lineage cuts."""
