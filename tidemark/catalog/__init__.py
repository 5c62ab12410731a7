"""The registered queries: each operator applied to the given tables, its SQL beside it."""

from tidemark.catalog import (aggregates, dimensions, feeds, joins, maintenance, reports, rows,  # noqa: F401
                              scalars, touched, windows)
from tidemark.catalog.base import registered

__all__ = ["registered"]
