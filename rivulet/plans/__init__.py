"""Importing this package fills the query registry."""

from rivulet.plans import basics, cases, matching, windowing  # noqa: F401, I001
from rivulet.plans import streams  # noqa: F401  (reuses the SQL registered above)
from rivulet.plans.registry import QUERIES, SQL  # noqa: F401
