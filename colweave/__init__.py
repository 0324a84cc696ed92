"""colweave: feature preparation and model selection on tables, as Spark jobs."""

from colweave.schema import KEY, LABEL, Roles, one_missing, prefix_schema

__all__ = ["KEY", "LABEL", "Roles", "one_missing", "prefix_schema"]
