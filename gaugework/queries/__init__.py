"""Registered queries: one per inventory entry, each with a reference SQL where SQL can say it."""

from .registry import ORACLES, QUERIES  # noqa: F401
from . import sources, calendar, scalars, joins, aggregates, fleet, monitoring, taxes, checks, semantic, streams  # noqa: F401
