"""All registered queries."""

from marlstone.workload import gold_queries, job_queries, mart_queries, silver_queries  # noqa: F401
from marlstone.workload.registry import QUERIES

__all__ = ["QUERIES"]
