"""Registered queries: each operator on the given tables, with the same result in SQL."""

from framewright.plans import (  # noqa: F401  (importing registers the queries)
    arrays, charts, cleaning, features, flagship, grouping, joining, metrics, models, sequences, sources, timeseries,
)
