"""Imports every plan module so that the registry is complete."""

from __future__ import annotations

from tallyspark.plans import changes, loading, model, quality, retail, scd  # noqa: F401
from tallyspark.plans.registry import ORACLE, QUERIES


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return dict(ORACLE)
