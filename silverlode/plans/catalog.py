"""Every registered query and its SQL twin."""

from __future__ import annotations

from importlib import import_module

MODULES = ("ledger", "federation", "change", "credit", "matching", "comments", "scans", "models")


def _merged(attr: str) -> dict:
    out: dict = {}
    for name in MODULES:
        part = getattr(import_module(f"silverlode.plans.{name}"), attr)
        clash = out.keys() & part.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        out.update(part)
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("ORACLE")
