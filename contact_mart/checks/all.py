"""All registered queries."""

from contact_mart.checks import q_groups, q_joins, q_layers, q_rows, q_scans
from contact_mart.checks.registry import ORACLES, QUERIES

MODULES = (q_scans, q_rows, q_joins, q_groups, q_layers)

__all__ = ["MODULES", "ORACLES", "QUERIES"]
