"""All registered queries of the core, with their SQL twins."""

from __future__ import annotations

from importlib import import_module

MODULES = ["interval_queries", "corpus_queries", "sentence_queries", "annotation_queries", "profile_queries"]


def _gather(what: str) -> dict:
    out: dict = {}
    for m in MODULES:
        out |= getattr(import_module(f"corpuscle.plans.{m}"), what)
    return out


def queries() -> dict:
    return _gather("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _gather("SQL")
