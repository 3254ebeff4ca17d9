"""Named queries over the test tables, each with the SQL that checks it.

A query reads whole tables; nested or textual inputs are derived from them inside Spark and then decoded by the operator
under test.
"""

from . import cleaning, dimensions, feeds, joblogs, jobruns, nested, quality, repair  # noqa: F401
from .registry import REGISTRY, Tables

__all__ = ["REGISTRY", "Tables"]
