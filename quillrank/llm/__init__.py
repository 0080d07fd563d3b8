"""Corpus operators: ten operators over texts, pages and dialogues, and the queries built on them.

Nothing else in the library imports this package.
"""
