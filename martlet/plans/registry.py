"""All registered queries by key."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("views", "extras", "reports", "builds", "business", "quality", "features", "models", "model_checks",
            "synth", "files", "basics", "activity")

QUERIES = {}
for _name in _MODULES:
    _module = import_module(f"martlet.plans.{_name}")
    for _key, _plan in _module.ALL.items():
        if _key in QUERIES:
            raise ValueError(f"two queries named {_key}")
        QUERIES[_key] = _plan
