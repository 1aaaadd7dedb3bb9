"""Operators for building training corpora: deduplication, filters, scans, scoring, search and mixing.

``queries`` holds one registered query per operator and the SQL that checks it where SQL can say it.
"""
