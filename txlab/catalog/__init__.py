"""The operators bound to the supplied tables, each with equivalent SQL where SQL can say it."""

from . import drift, metrics, modelling, prepare, profile, scoring, sources, streaming, validate  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
