"""Named queries over the test tables, each with its SQL counterpart."""

from . import analytics, dashboards, fraud, ingest, models, streams  # noqa: F401
from .base import CATALOG

__all__ = ["CATALOG"]
