"""Operators of a training-data pipeline; nothing outside this package imports it.

Each module holds one operator with its own general interface;
``echolens.llm.queries`` registers one query per operator over the given
tables.  All of them state what they do with nulls, empty and very long
texts, ties, repeated rows, empty tables and extra columns.
"""
