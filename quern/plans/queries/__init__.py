"""Registered queries over the given tables."""

from quern.plans.queries import (  # noqa: F401
    aggregates,
    changes,
    filters,
    joins,
    ordering,
    profiles,
    reports,
    scalars,
    sources,
    telemetry,
)
