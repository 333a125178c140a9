"""All registered queries."""

from __future__ import annotations

from millrace.plans import registry
from millrace.plans import (  # noqa: F401  (importing a module registers its queries)
    scans,
    transforms,
    sampling,
    joins,
    aggregates,
    ordering,
    setops,
    scalars,
    vectors,
    learning,
    streams,
    reports,
)


def queries() -> dict[str, registry.Runner]:
    return registry.runners()


def oracle_sql() -> dict[str, str]:
    return registry.oracles()
