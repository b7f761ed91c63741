"""All queries of the library by name, and SQL that gives the same rows."""

from __future__ import annotations

from corpusmill.plans import domains, evaluation, files, metrics, quality, records, replies, shapes, text

QUERIES: dict = {}
ORACLES: dict = {}
for module in (text, records, quality, metrics, replies, domains, evaluation, shapes, files):
    QUERIES |= module.QUERIES
    ORACLES |= module.ORACLES
