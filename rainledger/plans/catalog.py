"""Registry of the named queries."""

from __future__ import annotations

from rainledger.plans import archives, groundwater, landing, layers, publish, rain, review, status, status_spi, tables

FLAGSHIP = "status_full"
PARTS = (groundwater, rain, layers, status, tables, landing, archives, review, status_spi, publish)


def queries():
    return {k: f for part in PARTS for k, f in part.QUERIES.items()}


def oracle_sql():
    return {k: f for part in PARTS for k, f in part.SQL.items()}
