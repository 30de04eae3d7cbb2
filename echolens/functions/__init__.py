"""Column builders (scalar functions), all built from pyspark.sql.functions."""

from . import calendar, emotions, geo, profile, text  # noqa: F401
