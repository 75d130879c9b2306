"""Bindings to the given tables, and the registered queries with their SQL."""

from . import assembly, companies, dimensions, documents, evidence, marts, nested, records, tables, trials, weeks  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
