"""Named queries over the given tables with their SQL counterparts."""

from . import cleaning, features, models, monitoring, profiles, splits, storage  # noqa: F401
from .base import REGISTRY


def queries():
    return {name: q.run for name, q in REGISTRY.items()}


def oracle_sql():
    return {name: q.full_sql() for name, q in REGISTRY.items() if q.sql is not None}


def operators():
    return {name: q.ops for name, q in REGISTRY.items()}
