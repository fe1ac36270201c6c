"""Text helpers: tokens, hashes and report lines."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(line: Column, separator: str = " ") -> Column:
    """Array of the parts of ``line``, without empty parts at its end.

    An empty line has one empty part, a line of separators only has none, and empty
    parts inside the line are kept.
    """
    literal = re.escape(separator)
    if len(separator) == 1:
        stripped = F.rtrim(line, F.lit(separator))
    else:
        stripped = F.regexp_replace(line, f"({literal})+$", "")
    parts = F.split(stripped, literal)
    nothing = F.expr("cast(array() as array<string>)")
    return F.when((line != "") & (stripped == ""), nothing).otherwise(parts)


def token(line: Column, index: int, separator: str = " ") -> Column:
    """Part number ``index`` (from 0) of ``line``; null beyond the last."""
    return F.get(tokens(line, separator), index)


def bitmap_offset(value: Column, seed: int = 61, bits: int = 30) -> Column:
    """Position of ``value`` in a bitmap of ``2 ** bits`` bits: a base-``seed`` polynomial."""
    codes = F.transform(F.split(value.cast("string"), ""), lambda c: F.ascii(c).cast("long"))
    mask = (1 << bits) - 1
    return F.aggregate(
        codes, F.lit(0).cast("long"), lambda h, c: (h * seed + c).bitwiseAND(F.lit(mask))
    )


def report(header: Column, entries: Column) -> Column:
    """A report block: ``header``, then ``Top1:...`` to ``TopN:...`` from a text array."""
    lines = F.transform(
        entries, lambda e, i: F.concat(F.lit("Top"), (i + 1).cast("string"), F.lit(":"), e)
    )
    return F.concat_ws("\n", header, F.array_join(lines, "\n"))
