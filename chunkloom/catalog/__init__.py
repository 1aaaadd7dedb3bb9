"""Importing this package registers every query."""

from . import artifacts, elements, listings, ordered, scalars, services, states, worklists  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
