"""Pure Column → Column expressions (built-in Spark functions only)."""

from rollcall.functions import codes, dates, text  # noqa: F401
