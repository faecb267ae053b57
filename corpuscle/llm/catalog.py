"""All registered queries of the llm subpackage, with SQL twins where SQL can express them."""

from __future__ import annotations

from importlib import import_module

MODULES = ["splitting", "sentences", "repetition", "consensus", "turns", "tokens", "packing", "subjects"]


def _gather(what: str) -> dict:
    out: dict = {}
    for m in MODULES:
        out |= getattr(import_module(f"corpuscle.llm.{m}"), what)
    return out


def queries() -> dict:
    return _gather("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _gather("SQL")
