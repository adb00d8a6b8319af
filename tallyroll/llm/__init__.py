"""Operators on text corpora and their registered queries.

Nothing else in the library imports this subpackage.
"""

from tallyroll.llm.catalog import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
