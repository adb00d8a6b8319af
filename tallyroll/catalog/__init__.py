"""Registered queries with the SQL each one is checked against."""

from tallyroll.catalog import aggregates, explore, features, models, relations, scalars, sources
from tallyroll.catalog.base import Query

QUERIES: dict[str, Query] = {
    name: query
    for module in (sources, scalars, relations, aggregates, features, explore, models)
    for name, query in module.QUERIES.items()
}
