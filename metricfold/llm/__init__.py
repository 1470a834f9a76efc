"""Operators for building training corpora.

One module per operator; ``queries.py`` holds the registered queries and ``sql.py`` their
DuckDB SQL.  Nothing outside this package imports it (``__spark_entry__.py`` adds its
queries when it is present).

Shared conventions, unless an operator states otherwise: a null text counts as empty, rows
with a null id are kept under a null id, repeated rows are separate rows, an empty table
gives an empty result, and only the named id and text columns are read, so extra columns
of any name do no harm.
"""
