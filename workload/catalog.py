"""All registered queries by name."""

from __future__ import annotations

from workload import ads, prices, registry, transactions

MODULES = [prices, transactions, registry, ads]


def all_queries() -> dict:
    found: dict = {}
    for module in MODULES:
        for name, entry in module.QUERIES.items():
            if name in found:
                raise ValueError(f"query {name} registered twice")
            found[name] = entry
    return found
