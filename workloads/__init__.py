"""Queries over the shared tables, each with its SQL counterpart where SQL can say it."""

from . import cleansing, charts, correlations, descriptive, diagnostic, exploration  # noqa: F401
from . import models, prescriptive, project, sources, streams, timeseries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
