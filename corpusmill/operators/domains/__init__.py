"""Simulated businesses: their tools as steps of a fold over a task's actions."""

from __future__ import annotations

from corpusmill.operators.domains import airline, shop, tasks, telecom
from corpusmill.operators.domains.store import Domain

DOMAINS: dict[str, Domain] = {d.name: d for d in (airline.DOMAIN, shop.DOMAIN, tasks.DOMAIN, telecom.DOMAIN)}
