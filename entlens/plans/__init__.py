"""Registered queries by topic."""

from __future__ import annotations

import importlib

from entlens.plans.registry import ORACLES, QUERIES

TOPICS = ("tables", "normalise", "context", "rows", "features", "modelling", "evaluation", "describe")


def _load() -> None:
    for topic in TOPICS:
        importlib.import_module(f"entlens.plans.{topic}")


def all_queries():
    _load()
    return dict(QUERIES)


def all_oracles():
    _load()
    return dict(ORACLES)
