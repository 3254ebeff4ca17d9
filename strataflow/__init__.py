"""Spark building blocks for layered (raw, cleaned, curated) lakehouse data.

Every operator takes DataFrames and returns DataFrames (or takes and returns
Columns), so a whole flow stays one Catalyst plan.  Paths, connection settings
and the clock are always parameters.
"""

from .session import build_session

__all__ = ["build_session"]
