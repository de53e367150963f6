"""Imports every query module so the registry is complete."""

from __future__ import annotations

from . import q_hist, q_learn, q_metrics, q_prep, q_profile, q_select  # noqa: F401
from .registry import REGISTRY


def all_queries():
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def all_oracles():
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}
