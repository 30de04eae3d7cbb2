"""Sources (readers, inline lookups) and sinks (writers)."""

from . import lookups, sinks, tables  # noqa: F401
