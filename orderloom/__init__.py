"""Retail order warehouse on Spark: feed cleaners, keyed merges, change tracking,
a star build, order outcomes, money allocation and reports, all as DataFrame functions."""
