"""Phone-number masking (two styles used by the order jobs)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Characters kept and mask text of each style.
PREFIX_KEEP, PREFIX_MASK = 4, "******"                    # "prefix": first 4 chars + 6 stars
MIDDLE_KEEP, MIDDLE_MASK, MIDDLE_RESUME = 3, "****", 8    # "middle": first 3 + 4 stars + from char 8


def mask_phone(tel, style: str = "middle") -> Column:
    """Mask a phone string. Short or empty input keeps what exists (a substring past the end is '')."""
    c = F.col(tel) if isinstance(tel, str) else tel
    if style == "prefix":
        return F.concat(F.substring(c, 1, PREFIX_KEEP), F.lit(PREFIX_MASK))
    if style == "middle":
        tail = c.substr(F.lit(MIDDLE_RESUME), F.length(c))
        return F.concat(F.substring(c, 1, MIDDLE_KEEP), F.lit(MIDDLE_MASK), tail)
    raise ValueError(f"unknown mask style {style!r}")
