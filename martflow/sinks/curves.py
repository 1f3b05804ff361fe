"""A layout for filters on several columns: rows along a space-filling curve.

Sorting by one column helps filters on that column. Here each column is cut at its
quantiles into ranks, and the bits of the ranks are interleaved to one number, the
highest bits of all columns first. Rows near each other on that curve are near each
other in every column, so the minimum and maximum of a file's columns lie close and a
filter on any of them skips most files.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from martflow.sinks.writers import write

BITS = 6  # of each column's rank
_LETTERS = 6  # of a text that its rank goes by


def _number(df: DataFrame, col: str) -> Column:
    """A number in the order of the column's values."""
    kind = df.schema[col].dataType.typeName()
    if kind == "string":
        head = F.hex(F.substring(F.col(col).cast("binary"), 1, _LETTERS))
        return F.conv(F.rpad(head, 2 * _LETTERS, "0"), 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(col).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    return F.col(col).cast("double")


def _rank(number: Column, cuts: list[float]) -> Column:
    """How many cuts lie below the number; none below a null."""
    if not cuts:
        return F.lit(0)
    literal = F.split(F.lit(",".join(map(repr, cuts))), ",").cast("array<double>")
    return F.when(number.isNull(), 0).otherwise(F.size(F.filter(literal, lambda cut: cut < number)))


def curve_place(df: DataFrame, cols: Sequence[str], bits: int = BITS) -> Column:
    """The place of a row on the curve through ``cols``; nulls come first in their column.

    Cuts are approximate quantiles from one aggregation of all columns, so a
    column's ranks hold about equally many rows, however its values are spread.
    """
    if not 0 < bits * len(cols) <= 62:
        raise ValueError(f"{len(cols)} columns of {bits} bits don't fit a place of 62 bits")
    n = 1 << bits
    numbers = df.select(*[_number(df, c).alias(f"_{i}") for i, c in enumerate(cols)])
    found = numbers.agg(*[F.percentile_approx(f"_{i}", [j / n for j in range(1, n)], 20 * n) for i in range(len(cols))]).head()
    place = []
    for i, c in enumerate(cols):
        rank = _rank(_number(df, c), sorted(set(found[i] or []))).cast("long")
        place += [F.shiftleft(F.shiftright(rank, b).bitwiseAND(F.lit(1)), b * len(cols) + len(cols) - 1 - i) for b in range(bits)]
    return reduce(Column.__add__, place)


def write_along_curve(df: DataFrame, path: str, cols: Sequence[str], files: int, bits: int = BITS, **options: str) -> None:
    """Files that hold pieces of the curve through ``cols``, with rows in its order.

    Rows of one place are dealt on by a hash of all columns, so that a very
    frequent combination of values is cut into several files too.
    """
    placed = df.withColumns({"_place": curve_place(df, cols, bits), "_spread": F.xxhash64(*df.columns)})
    ordered = placed.repartitionByRange(files, "_place", "_spread").sortWithinPartitions("_place", *cols)
    write(ordered.drop("_place", "_spread"), path, **options)
