"""Numbers formatted into sentences."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from storeops.functions.columns import half_up


def percent_text(ratio_col: Column, digits: int = 1) -> Column:
    """0.4225 -> '42.3'; NULL stays NULL."""
    return half_up(ratio_col * 100, digits).cast(f"decimal(30,{digits})").cast("string")


def whole_text(col: Column) -> Column:
    """6140.5 -> '6,141'; NULL stays NULL."""
    return F.format_number(half_up(col, 0).cast("decimal(28,0)"), 0)


def sentence(template: str, **values: Column) -> Column:
    """Fill `{name}` slots with columns. One NULL value makes the whole text NULL, as concat does."""
    parts = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            parts.append(values[piece].cast("string"))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)
