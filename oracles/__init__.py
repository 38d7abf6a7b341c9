"""DuckDB statements the Spark results are compared with.

The statements are written directly over the input tables with decimals and plain
COUNT(DISTINCT ...), independent of how the Spark plans are built.
"""

from __future__ import annotations

import re
from importlib import import_module

from oracles.base import CTES

_MODULES = ("views", "reports", "builds", "jobs", "synth", "quality", "features", "files", "basics")


def compose(body: str) -> str:
    """Put in front of ``body`` the shared CTEs it uses, in dependency order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, sql in CTES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(sql)

    visit(body)
    ctes = [f"{name} AS ({sql.strip()})" for name, sql in CTES.items() if name in needed]
    body = body.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def all_statements() -> dict[str, str]:
    out: dict[str, str] = {}
    for name in _MODULES:
        module = import_module(f"oracles.{name}")
        out.update({key: compose(sql) for key, sql in module.SQL.items()})
    return out
