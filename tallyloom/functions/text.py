"""Fixed-width and currency text for printed reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shown for an unknown number.
UNKNOWN = "N/A"


def left(value: Column, width: int) -> Column:
    """Left-aligned text, padded but never cut."""
    return F.format_string(f"%-{width}s", value)


def _number(value: Column, width: int, places: int, grouped: bool) -> Column:
    flags = ("-" if width else "") + ("," if grouped else "")
    return F.format_string(f"%{flags}{width or ''}.{places}f", value.cast("double"))


def _known(value: Column, shown: Column, width: int) -> Column:
    return F.when(value.isNotNull(), shown).otherwise(UNKNOWN.ljust(width))


def dollars(value: Column, width: int = 0, grouped: bool = False) -> Column:
    """Two places behind a dollar sign, the number left-aligned in ``width``."""
    return _known(value, F.concat(F.lit("$"), _number(value, width, 2, grouped)), width + 1 if width else 0)


def percent(value: Column, width: int = 0, places: int = 2) -> Column:
    """Fixed places before a percent sign."""
    return _known(value, F.concat(_number(value, width, places, False), F.lit("%")), width + 1 if width else 0)
