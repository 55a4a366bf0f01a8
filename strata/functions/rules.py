"""Declarative validity rules.

A rule set is a list of named boolean Columns; ``all_of`` reduces it with
``&``.  Every ranged column is also null-checked by the callers, so the
reduced condition is never NULL and ``valid + rejected = total`` holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def not_null(*names: str) -> list[tuple[str, Column]]:
    return [(f"{n}_not_null", F.col(n).isNotNull()) for n in names]


def limits(name: str, least=None, most=None, above: bool = False) -> list[tuple[str, Column]]:
    """The range of a column; with ``above`` the lower limit must be exceeded."""
    out = []
    if least is not None:
        out.append((f"{name}_from_{least}", F.col(name) > least if above else F.col(name) >= least))
    if most is not None:
        out.append((f"{name}_to_{most}", F.col(name) <= most))
    return out


def from_table(table, which: str, above=()) -> list[tuple[str, Column]]:
    """Rules of the set ``which`` from rows (column, least, most, sets that require the column)."""
    mine = [row for row in table if which in row[3].split()]
    required = not_null(*(row[0] for row in mine))
    return required + [rule for name, least, most, _ in mine for rule in limits(name, least, most, name in above)]


def equals(name: str, value) -> tuple[str, Column]:
    other = value if isinstance(value, Column) else F.lit(value)
    return (f"{name}_eq", F.col(name) == other)


def not_nan(*names: str) -> list[tuple[str, Column]]:
    return [(f"{n}_not_nan", ~F.isnan(F.col(n))) for n in names]


def all_of(rules) -> Column:
    return reduce(lambda a, b: a & b, (c for _, c in rules), F.lit(True))

