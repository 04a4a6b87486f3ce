"""Every registered query."""

from __future__ import annotations

from labelloom.catalog import encoding, evaluation, feed, generation, model_responses, preparation, scoring, storage
from labelloom.catalog.base import Registry

REGISTRY = Registry()
for module in (preparation, evaluation, generation, model_responses, encoding, scoring, feed, storage):
    for name, item in module.registry.items():
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = item
