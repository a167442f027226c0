"""Training-data operators: search, near-dedup, mixing, URL filters,
tokenisation, sharding, language ID and licence scans.

Nothing else in the library imports this subpackage.
"""

from . import queries  # noqa: F401  (registration side effects)
from .registry import ORACLE, QUERIES  # noqa: F401
