"""The query catalog: every registered query and its DuckDB oracle SQL.

The queries live in ``echolens.plans.queries`` (one module per operator
family); importing that package registers them.
"""

from .queries import ORACLES, QUERIES, register, round_doubles  # noqa: F401
