"""Operators for preparing large text corpora.

Nothing else in the library imports this subpackage; ``__spark_entry__.py`` adds
its queries only when it is present. Each module holds one operator with a
general interface; :mod:`shelfcost.llm.queries` holds the thin registered
queries and their SQL.
"""
