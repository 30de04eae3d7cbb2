"""Registered queries over the driver tables, each with its DuckDB oracle SQL.

Every query reads whole tables (no id subsets, no row caps); limits appear
only where the limit is the feature (top-k reports).  Doubles are rounded
to 6 decimals on both sides so the two engines compare equal despite
different summation orders.  One module per operator family."""

from ._common import ORACLES, QUERIES, register, round_doubles  # noqa: F401
from . import lift  # noqa: F401,E402
from . import shares  # noqa: F401,E402
from . import accounts  # noqa: F401,E402
from . import drilldown  # noqa: F401,E402
from . import maintenance  # noqa: F401,E402
from . import discovery  # noqa: F401,E402
from . import text  # noqa: F401,E402
from . import topics  # noqa: F401,E402
from . import streaming  # noqa: F401,E402
from . import consolidation  # noqa: F401,E402
from . import landed  # noqa: F401,E402
