"""Plain column expressions: picks by position, formatted codes, flags, hierarchy levels."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_LITERAL_POOL = 200


def literal_array(values: Sequence) -> Column:
    """A short literal array.  Longer pools belong in a table and are joined."""
    if not 0 < len(values) <= MAX_LITERAL_POOL:
        raise ValueError(f"a literal pool holds 1..{MAX_LITERAL_POOL} values, not {len(values)}")
    return F.expr(f"array({', '.join(sql_literal(v) for v in values)})")


def sql_literal(value: object) -> str:
    """A string, integer or double as SQL text."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else f"{value!r}"


def cyclic_pick(values: Sequence, position: Column) -> Column:
    """The value at ``position`` modulo the number of values."""
    return F.get(literal_array(values), F.pmod(position, F.lit(len(values))).cast("int"))


def cyclic_number(position: Column, modulus: int | Column, offset: int = 0) -> Column:
    """``position`` modulo ``modulus``, plus an offset."""
    n = modulus if isinstance(modulus, Column) else F.lit(modulus)
    return F.pmod(position, n) + F.lit(offset)


def zero_pad(number: Column, width: int) -> Column:
    """At least ``width`` digits.  Longer numbers stay whole, so codes stay distinct."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def code(prefix: str, number: Column, width: int = 0) -> Column:
    """Prefix and zero-padded number."""
    return F.concat(F.lit(prefix), zero_pad(number, width) if width else number.cast("string"))


def every(position: Column, k: int, hit: object, miss: object) -> Column:
    """``hit`` on every k-th position, else ``miss``."""
    return F.when(F.pmod(position, F.lit(k)) == 0, F.lit(hit)).otherwise(F.lit(miss))


def number_after_round(position: Column, per_round: int, shown: Column) -> Column:
    """Empty on the first round through a pool, then a space and ``shown``."""
    return F.when(position <= per_round, F.lit("")).otherwise(
        F.concat(F.lit(" "), shown.cast("string"))
    )


def case(branches: Iterable[tuple[Column, Column]], default: Column) -> Column:
    """Chained CASE from (condition, value) pairs."""
    chosen = None
    for condition, value in branches:
        chosen = F.when(condition, value) if chosen is None else chosen.when(condition, value)
    return default if chosen is None else chosen.otherwise(default)


def threshold_index(ratio: Column, weights: Sequence[int]) -> Column:
    """Position of the first cumulative share above ``ratio``."""
    total = sum(weights)
    shares = [sum(weights[: i + 1]) / total for i in range(len(weights))]
    return case(
        ((ratio < F.lit(share), F.lit(i)) for i, share in enumerate(shares[:-1])),
        F.lit(len(weights) - 1),
    )


def nested_level_sizes(n: int, levels: int, step: int) -> list[int]:
    """Node count per level, 1 the coarsest: each is a multiple of the one before.

    The targets n // (levels*step) … n // step grow with depth; rounding each down to a
    multiple of its parent's count makes every node have exactly one parent.
    """
    sizes: list[int] = []
    for level in range(1, levels + 1):
        target = max(1, n // ((levels + 1 - level) * step))
        sizes.append(target if not sizes else sizes[-1] * max(1, target // sizes[-1]))
    return sizes


def shrinking_level_sizes(n: int, levels: int, step: int, plus: int = 0) -> list[int]:
    """Node count per level that falls with depth; nodes are not nested."""
    return [max(1, n // (level * step) + plus) for level in range(1, levels + 1)]


def level_nodes(position: Column, sizes: Sequence[int]) -> list[Column]:
    """The node number, from 1, of a row on each level."""
    return [cyclic_number(position, size, 1) for size in sizes]


def parent_code(position: Column, prefix: str, width: int, roots: int = 10) -> Column:
    """Null for the first ``roots`` rows, then the code of one of them."""
    return F.when(position > roots, code(prefix, cyclic_number(position, roots, 1), width))
