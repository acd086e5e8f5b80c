"""Names of all catalog queries, with the DuckDB SQL each one is checked against."""

from __future__ import annotations

from lexledger.plans import catalog, rules, scalars, streams, structure, versioning

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _module in (catalog, versioning, scalars, structure, rules, streams):
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
