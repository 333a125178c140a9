"""Operators for preparing training data: scans, search, tokens, packing, scores, duplicates and lists.

Nothing else in the library imports this package.  Every operator takes the columns it
names and ignores all others, so extra columns of any name do no harm.
"""
