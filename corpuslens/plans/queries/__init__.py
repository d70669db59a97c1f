"""Catalogue of runnable queries, each next to the SQL that checks it."""

from corpuslens.plans.queries import (  # noqa: F401
    evaluation,
    features,
    intake,
    leakage,
    modelling,
    near_duplicates,
    profile,
    scoring,
    splits,
    streams,
    texts,
)
from corpuslens.plans.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
