"""All registered queries and their SQL twins."""

from __future__ import annotations

from tessera.plans import agents, chunks, retrieval, stores, streams, text

QUERIES: dict = {}
ORACLES: dict = {}
NO_ORACLE: dict = {}

for _m in (retrieval, agents, text, chunks, streams, stores):
    QUERIES.update(_m.QUERIES)
    ORACLES.update(_m.ORACLES)
    NO_ORACLE.update(getattr(_m, "NO_ORACLE", {}))
