"""Names of all queries outside the training-data subpackage, with their SQL."""

from __future__ import annotations

from millrace.plans import conversations, curation, reading, relational, textual, traces

MODULES = (conversations, curation, reading, relational, textual, traces)


def queries() -> dict:
    found: dict = {}
    for module in MODULES:
        found |= module.QUERIES
    return found


def oracle_sql() -> dict:
    found: dict = {}
    for module in MODULES:
        found |= module.ORACLES
    return found
