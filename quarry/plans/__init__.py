"""Named queries (one per operator / report) and their oracle SQL."""

from . import cleaning, tagging, reports, vectors, models, topics, entities, io  # noqa: F401  (registration side effects)
from .registry import HEADLINE, ORACLE, QUERIES  # noqa: F401
