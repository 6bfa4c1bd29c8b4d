"""All registered queries."""

from energylake.queries import (  # noqa: F401
    cleaning, expressions, gains, layers, metrics, model, rows)
from energylake.queries.registry import REGISTRY, Query  # noqa: F401
