"""All queries over the driver tables and their SQL for the oracle."""

from __future__ import annotations

from . import captures, curation, evaluation, labelling, monitor, provenance

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
for _module in (monitor, curation, evaluation, labelling, captures, provenance):
    QUERIES.update(_module.QUERIES)
    ORACLE_SQL.update(_module.ORACLE_SQL)
