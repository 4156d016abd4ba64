"""All registered queries, loaded from the modules below."""

from wavelens.registry import basics, flow_ops, results, scale_ops, survey_ops  # noqa: F401
from wavelens.registry.core import QUERIES

__all__ = ["QUERIES"]
