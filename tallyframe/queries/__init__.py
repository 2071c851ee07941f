"""Named queries; importing the modules registers them."""

from tallyframe.queries import (  # noqa: F401
    alerting, expressions, modelling, people, profile, retail, selection, storage,
)
from tallyframe.queries.registry import REGISTRY, Tables

__all__ = ["REGISTRY", "Tables"]
