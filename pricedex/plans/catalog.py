"""Public access to the query catalogue (all modules that register queries are imported here)."""

from __future__ import annotations

from pricedex.plans import registry


def _load() -> None:
    # Importing a module registers its queries.
    from pricedex.plans import registry_forecast, registry_monitor, registry_more, registry_sources  # noqa: F401


def queries():
    _load()
    return dict(registry.QUERIES)


def oracle_sql():
    _load()
    return dict(registry.ORACLE)
