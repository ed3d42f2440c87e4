"""Named queries over the standard tables, each with the SQL that gives the same rows."""

from keelson.plans import formats, graphs, logs, models, relational, similarity, splits, text  # noqa: F401
from keelson.plans.registry import oracles, queries

__all__ = ["oracles", "queries"]
