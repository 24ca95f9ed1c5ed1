"""Seeded random columns that depend on nothing but the row id, a salt and the seed.

``rand(seed)`` changes with partitioning; here every draw is a hash of the row id, so a
table has the same rows from any number of partitions, after any retry, and in any engine
that has 64-bit xxHash.  One hash costs a few nanoseconds inside generated code.
"""

from __future__ import annotations

import datetime as dt
import math
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerweave.functions.exprs import MAX_LITERAL_POOL, case, literal_array
from ledgerweave.functions.pools import AmountParams

UNIFORM_STEPS = float(1 << 52)
AMOUNT_UNITS = 100_000  # amounts are whole multiples of 1e-5


def salt_key(salt: str, seed: int) -> int:
    """The number a column's salt and the run's seed contribute to the hash."""
    return (seed << 32) + zlib.crc32(salt.encode())


@dataclass(frozen=True)
class RowRandom:
    """Draws for the row identified by column ``id``; each salt is an independent stream."""

    id: str = "id"
    seed: int = 42

    @property
    def row(self) -> Column:
        """The row id."""
        return F.col(self.id)

    def stream(self, salt: str) -> str:
        """The full name of a salt's stream."""
        return salt

    def uniform_sql(self, salt: str) -> str:
        key = salt_key(self.stream(salt), self.seed)
        bits = f"xxhash64({key}L, cast(`{self.id}` as bigint))"
        return f"(shiftrightunsigned({bits}, 12) / {UNIFORM_STEPS!r}D)"

    def uniform(self, salt: str) -> Column:
        """Double in [0, 1) with 52 random bits."""
        return F.expr(self.uniform_sql(salt))

    def index(self, salt: str, n: int | Column) -> Column:
        """Bigint in 0..n-1; ``n`` may be a column or a scalar subquery."""
        if isinstance(n, int):
            return F.expr(f"floor({self.uniform_sql(salt)} * {n})")
        return F.floor(self.uniform(salt) * n)

    def pick(self, salt: str, values: Sequence) -> Column:
        """One of ``values``, all equally likely."""
        return F.get(literal_array(values), self.index(salt, len(values)).cast("int"))

    def weighted(self, salt: str, values: Sequence, weights: Sequence[int]) -> Column:
        """One of ``values`` with the given relative frequencies, of any total.

        A number below the total falls to the first value whose cumulative weight exceeds
        it.  For short pools that is written as an array lookup, which is faster.
        """
        drawn = self.index(salt, sum(weights))
        if sum(weights) <= MAX_LITERAL_POOL:
            return F.get(literal_array(expand_weights(values, weights)), drawn.cast("int"))
        if len(values) != len(weights):
            raise ValueError(f"{len(values)} values but {len(weights)} weights")
        ends = [sum(weights[: k + 1]) for k in range(len(weights))]
        *firsts, last = values
        return case(((drawn < F.lit(e), F.lit(v)) for e, v in zip(ends, firsts)), F.lit(last))

    def flag(self, salt: str, probability: float) -> Column:
        """True with the given probability."""
        return self.uniform(salt) < F.lit(probability)

    def between(self, salt: str, low: float, high: float) -> Column:
        """Double in [low, high)."""
        span = float(high) - float(low)
        return F.expr(f"{float(low)!r}D + {self.uniform_sql(salt)} * {span!r}D")

    def decimal(self, salt: str, low: float, high: float) -> Column:
        """Decimal(28,5) in [low, high)."""
        return from_units(to_units(self.between(salt, low, high)))

    def log_normal(self, salt: str, mean: float | Column, std_dev: float | Column) -> Column:
        """Log-normal double with the given arithmetic mean and standard deviation."""
        mu, sigma = log_normal_params(mean, std_dev)
        return F.exp(mu + sigma * self.standard_normal(salt))

    def standard_normal(self, salt: str) -> Column:
        """Box-Muller normal; 1-u lies in (0, 1], so the logarithm is finite."""
        radius, angle = (self.uniform_sql(f"{salt}/{part}") for part in ("radius", "angle"))
        return F.expr(f"sqrt(-2D * ln(1D - {radius})) * cos({2 * math.pi!r}D * {angle})")

    def sign(self, salt: str, negative_share: float) -> Column:
        """-1 with the given probability, else 1."""
        return F.expr(f"if({self.uniform_sql(salt)} < {negative_share!r}D, -1, 1)")

    def date(self, salt: str, start: dt.date | str, end: dt.date | str) -> Column:
        """Date in [start, end)."""
        first, last = _as_date(start), _as_date(end)
        return F.date_add(F.lit(first), self.index(salt, (last - first).days).cast("int"))

    def audit_dates(
        self, salt: str, start: dt.date | str, end: dt.date | str, update_share: float
    ) -> tuple[Column, Column]:
        """Creation date, and update date: for some rows drawn from the days from the creation
        to the end, else the same."""
        created = self.date(f"{salt}/created", start, end)
        left = F.datediff(F.lit(_as_date(end)), created)
        later = F.date_add(created, self.index(f"{salt}/updated", left).cast("int"))
        updated = F.when(self.flag(f"{salt}/is_updated", update_share), later).otherwise(created)
        return created, updated


def expand_weights(values: Sequence, weights: Sequence[int]) -> list:
    """Each value repeated by its weight."""
    if len(values) != len(weights):
        raise ValueError(f"{len(values)} values but {len(weights)} weights")
    return [v for v, w in zip(values, weights) for _ in range(w)]


def log_normal_params(
    mean: float | Column, std_dev: float | Column
) -> tuple[float | Column, float | Column]:
    """Parameters of the underlying normal for an arithmetic mean and standard deviation."""
    if isinstance(mean, Column) or isinstance(std_dev, Column):
        ratio = std_dev / mean
        variance = F.log(F.lit(1.0) + ratio * ratio)
        return F.log(mean) - variance / 2, F.sqrt(variance)
    variance = math.log(1.0 + (std_dev / mean) ** 2)
    return math.log(mean) - variance / 2, math.sqrt(variance)


def log_normal_params_of(params: AmountParams) -> tuple[float, float]:
    return log_normal_params(params.mean, params.std_dev)


def to_units(amount: Column) -> Column:
    """A double as a whole number of 1e-5 units, half up."""
    return F.floor(amount * F.lit(float(AMOUNT_UNITS)) + F.lit(0.5))


def from_units(units: Column) -> Column:
    """Whole units as decimal(28,5); several times cheaper than casting a double."""
    step = F.lit("0.00001").cast("decimal(5,5)")
    return (units.cast("decimal(17,0)") * step).cast("decimal(28,5)")


def _as_date(value: dt.date | str) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)
