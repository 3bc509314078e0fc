"""Cleaners: one function per feed, raw frames in, rows of a staging table out.

All are lazy DataFrame functions. Rows keep `row_no` where later rows of a key win. Conditions under which
a feed must not be loaded fail the query that reads it.
"""
