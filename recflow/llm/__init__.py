"""Operators for preparing training text: scans, deduplication, tokenization, scoring.

Every operator takes a frame with ``doc_id`` and ``text`` and ignores other columns. Common rules: a
null text counts as the empty text, a null ``doc_id`` is kept as a document of its own, repeated rows
are scored one by one, and an empty table gives an empty result of the same columns.
"""
