"""Registered queries and their SQL."""

from curatrix.plans import files, kernels, matrices, runs_and_reads, selection  # noqa: F401
from curatrix.plans.bindings import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
