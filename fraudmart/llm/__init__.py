"""Operators of a training-data pipeline: language, scoring, tokens, copies and leaks.

Each module holds one operator with its own general interface; ``queries``
registers the thin ``opN_*`` queries over them. Nothing outside this package
imports it (``__spark_entry__.py`` adds its queries when it is present).
"""
