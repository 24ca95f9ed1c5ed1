"""Goodness of fit: whether a table's values follow the distributions they were declared with.

Each test counts with partial sums; what is compared afterwards is one row per declared
value or per cell of a fixed grid, however large the table is.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Standard scores are counted in so many cells per unit, from -LIMIT to LIMIT.
CELLS, LIMIT = 32, 6
#: A right declaration is rejected with this chance.
LEVEL = 0.001
#: sqrt(rows) times the Kolmogorov-Smirnov distance exceeds this with chance LEVEL.
KS_CRITICAL = math.sqrt(-math.log(LEVEL / 2) / 2)


def chi_square_tail(x: float, degrees: int) -> float:
    """The chance that a chi-square of so many degrees exceeds ``x``: two degrees at a time."""
    k, tail = (1, math.erfc(math.sqrt(x / 2))) if degrees % 2 else (2, math.exp(-x / 2))
    while k < degrees:
        if x > 0:
            tail += math.exp(k / 2 * math.log(x / 2) - x / 2 - math.lgamma(k / 2 + 1))
        k += 2
    return tail


def chi_square_critical(degrees: int, level: float = LEVEL) -> float:
    """What a chi-square of so many degrees exceeds with chance ``level``; 0 without degrees."""
    if degrees < 1:
        return 0.0
    low, high = 0.0, 1.0
    while chi_square_tail(high, degrees) > level:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_tail(middle, degrees) > level else (low, middle)
    return high


def weight_fit(df: DataFrame, column: Column, weights: Mapping[object, float]) -> DataFrame:
    """Pearson's chi-square of a column against declared relative weights, as one row.

    Returns row_cnt, undeclared_cnt, chi_square, degrees, fits.  Null and undeclared values
    count as undeclared, and with any the declaration is rejected; the statistic is of the
    others.  A value of weight zero that occurs is undeclared.  An empty table fits, with a
    statistic of 0.
    """
    shares = {value: weight for value, weight in weights.items() if weight > 0}
    total = sum(shares.values())
    if not total:
        raise ValueError("no declared value has a weight")
    counted = df.agg(
        F.count("*").alias("row_cnt"),
        *(F.count_if(column == F.lit(value)).alias(f"_{i}") for i, value in enumerate(shares)),
    )
    seen = [F.col(f"_{i}") for i in range(len(shares))]
    declared = sum(seen[1:], seen[0])
    terms = [
        F.pow(n - declared * F.lit(weight / total), F.lit(2)) / (declared * F.lit(weight / total))
        for n, weight in zip(seen, shares.values())
    ]
    statistic = F.when(declared > 0, sum(terms[1:], terms[0])).otherwise(F.lit(0.0))
    degrees = len(shares) - 1
    return counted.select(
        "row_cnt", (F.col("row_cnt") - declared).alias("undeclared_cnt"), statistic.alias("chi_square")
    ).select(
        "*",
        F.lit(degrees).alias("degrees"),
        (
            (F.col("undeclared_cnt") == 0)
            & (F.col("chi_square") <= F.lit(chi_square_critical(degrees)))
        ).alias("fits"),
    )


def log_normal_fit(
    df: DataFrame,
    amount: Column,
    by: Column,
    declared: Mapping[str, tuple[float, float, float, float]],
) -> DataFrame:
    """Kolmogorov-Smirnov distances of amounts from log-normals cut off at bounds, per group.

    ``declared`` holds mu, sigma and the two bounds of every group.  Returns grp, row_cnt,
    outside_cnt, distance, fits for the groups with rows.  Rows are counted per group and cell
    of the standard score, at most 2 * LIMIT * CELLS + 3 cells each; the distance is the largest
    at the cells' edges strictly inside the bounds, where cutting off changes nothing.  Amounts
    that are null, zero, not numbers or outside the bounds, and all of an undeclared group,
    count as outside, and with any the declaration is rejected.  Signs are ignored.  Rows
    without a group have no declaration and are left out.
    """
    spark = df.sparkSession
    params = [(grp, *map(float, values)) for grp, values in declared.items()]
    given = spark.createDataFrame(
        params, "grp string, mu double, sigma double, low double, high double"
    )
    sizes = df.select(by.cast("string").alias("grp"), F.abs(amount).cast("double").alias("size"))
    rows = sizes.where("grp is not null").join(F.broadcast(given), "grp", "left")
    score = (F.log("size") - F.col("mu")) / F.col("sigma") * CELLS
    cell = F.least(F.greatest(F.floor(score), F.lit(-LIMIT * CELLS - 1)), F.lit(LIMIT * CELLS))
    inside = F.coalesce(F.col("size").between(F.col("low"), F.col("high")) & (F.col("size") > 0),
                        F.lit(False))
    cells = rows.select("grp", F.when(inside, cell).alias("cell"))
    counted = cells.groupBy("grp", "cell").agg(F.count("*").alias("n"))
    # One row per edge, a constant number, holding the declared share below it.
    normal = NormalDist()
    edges = [(k, k / CELLS, normal.cdf(k / CELLS)) for k in range(-LIMIT * CELLS, LIMIT * CELLS + 1)]
    grid = spark.createDataFrame(edges, "edge long, score double, share double")
    groups = counted.groupBy("grp").agg(
        F.sum(F.when(F.col("cell").isNotNull(), F.col("n")).otherwise(0)).alias("inside_cnt"),
        F.sum("n").alias("row_cnt"),
    )
    bound = lambda c: ((F.log(c) - F.col("mu")) / F.col("sigma"))
    groups = groups.join(F.broadcast(given), "grp", "left").select(
        "grp", "inside_cnt", "row_cnt", bound("low").alias("from"), bound("high").alias("to")
    )
    wanted = groups.select("grp", "inside_cnt", "from", "to", F.explode(
        F.sequence(F.lit(-LIMIT * CELLS), F.lit(LIMIT * CELLS)).cast("array<bigint>")
    ).alias("edge")).join(F.broadcast(grid), "edge")
    held = counted.where("cell is not null").select("grp", (F.col("cell") + 1).alias("edge"), "n")
    at = Window.partitionBy("grp").orderBy("edge").rowsBetween(Window.unboundedPreceding, 0)
    edged = wanted.join(held, ["grp", "edge"], "left").withColumn(
        "below", F.sum(F.coalesce("n", F.lit(0))).over(at)
    )
    gap = F.abs(F.col("below") / F.col("inside_cnt") - F.col("share"))
    within = (F.col("score") > F.col("from")) & (F.col("score") < F.col("to"))
    distances = edged.groupBy("grp").agg(F.max(F.when(within, gap)).alias("distance"))
    distance = F.coalesce("distance", F.lit(0.0))  # null without an edge or a row inside
    return groups.join(distances, "grp").select(
        "grp",
        "row_cnt",
        (F.col("row_cnt") - F.col("inside_cnt")).alias("outside_cnt"),
        distance.alias("distance"),
        (
            (F.col("row_cnt") == F.col("inside_cnt"))
            & (distance * F.sqrt("inside_cnt") <= F.lit(KS_CRITICAL))
        ).alias("fits"),
    )
