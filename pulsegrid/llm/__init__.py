"""Operators that prepare text for training language models.

Nothing outside this subpackage imports it.  Every operator takes DataFrames
and column names and gives a DataFrame; ``queries`` holds the thin queries over
the given tables and ``load`` collects them.
"""


def load():
    """(queries, sql) of this subpackage."""
    from pulsegrid.llm.queries import QUERIES, SQL

    return QUERIES, SQL
