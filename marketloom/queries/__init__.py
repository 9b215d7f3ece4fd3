"""Registered queries: each pairs a DataFrame with the SQL it must agree with."""

from marketloom.queries import (  # noqa: F401
    forecasts,
    gold,
    ingest,
    intraday,
    quality,
    reads,
    streams,
)
from marketloom.queries.registry import oracle_sql, queries  # noqa: F401
