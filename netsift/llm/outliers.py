"""Minimum-covariance-determinant estimates per group, with DataFrame operations only.

For each group the estimator looks for the share ``half`` of rows whose covariance has
the smallest determinant: from two deterministic starts it repeats concentration steps
(mean and covariance of the rows in use, then the rows nearest by Mahalanobis distance),
takes the start with the smaller determinant, scales for consistency, and reweights
once. A step is one aggregate of sums and products: groups of any size are summed map
side, nothing but one small row per group is joined back, and each step's small table is
written to the shared folder, so lineage stays short.

Nearest rows are found by counting distances in bins of a 64th of a natural logarithm,
so the subset may exceed ``half`` by the rows of one bin. ``floor`` has the least standard
deviation of each dimension; with it constant columns do no harm.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netsift.functions.staging import once
from netsift.llm.common import written

BINS = 64


def chi2_cdf(x: float, degrees: int) -> float:
    """For an even number of degrees of freedom, in closed form."""
    if degrees % 2:
        raise ValueError("an even number of dimensions is needed")
    term = total = 1.0
    for k in range(1, degrees // 2):
        term *= x / 2 / k
        total += term
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(share: float, degrees: int) -> float:
    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, degrees) < share else (low, mid)
    return low


def consistency(share: float, degrees: int) -> float:
    """The factor that makes the covariance of the central ``share`` of a normal sample consistent."""
    return share / chi2_cdf(chi2_quantile(share, degrees), degrees + 2)


def _medians(df: DataFrame, columns: list[str], step: float = 1 / 256) -> DataFrame:
    """Per group ``_g`` the median of each column, exact to ``step``; counts bins, so a group of any size is summed map side."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("d"), F.floor(F.col(c) / step).alias("b")) for i, c in enumerate(columns)]))
    bins = df.select("_g", pairs.alias("p")).groupBy("_g", "p.d", "p.b").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("_g", "d")
    counted = bins.select("*", F.sum("n").over(order.orderBy("b")).alias("upto"), F.sum("n").over(order).alias("all"))
    found = counted.where(F.col("upto") * 2 >= F.col("all")).groupBy("_g", "d").agg(F.min("b").alias("b"))
    return found.groupBy("_g").agg(*[
        F.max(F.when(F.col("d") == i, F.col("b") * step + step / 2)).alias(f"_m{i}") for i in range(len(columns))
    ])


def _sums(p: int, value) -> list[Column]:
    """Aggregates for mean and covariance of ``value(i)``."""
    out = [F.count(F.lit(1)).alias("_n")] + [F.sum(value(i)).alias(f"_s{i}") for i in range(p)]
    return out + [F.sum(value(i) * value(j)).alias(f"_q{i}_{j}") for i in range(p) for j in range(i + 1)]


def _factors(sums: DataFrame, p: int, scale: float, floor: list[float], keys: list[str]) -> DataFrame:
    """Mean ``_m*``, inverse of the Cholesky factor ``_w*`` and log determinant ``_logdet`` from sums."""
    n = F.col("_n")
    mean = {i: F.col(f"_s{i}") / n for i in range(p)}
    cov = {(i, j): scale * (F.col(f"_q{i}_{j}") / n - mean[i] * mean[j]) for i in range(p) for j in range(i + 1)}
    df = sums.select(*keys, *[mean[i].alias(f"_m{i}") for i in range(p)], *[
        (F.greatest(cov[i, j], F.lit(0.0)) + floor[i] ** 2 if i == j else cov[i, j]).alias(f"_c{i}_{j}")
        for i in range(p) for j in range(i + 1)
    ])
    # each column is used several times; ``once`` keeps an expression from being written out at each use
    for j in range(p):
        square = F.col(f"_c{j}_{j}") - sum((F.col(f"_l{j}_{k}") ** 2 for k in range(j)), F.lit(0.0))
        df = once(df, **{f"_l{j}_{j}": F.sqrt(F.greatest(square, F.lit(floor[j] ** 2 / 100)))})
        below = {
            f"_l{i}_{j}": (F.col(f"_c{i}_{j}") - sum((F.col(f"_l{i}_{k}") * F.col(f"_l{j}_{k}") for k in range(j)), F.lit(0.0)))
            / F.col(f"_l{j}_{j}")
            for i in range(j + 1, p)
        }
        df = once(df, **below) if below else df
    for i in range(p):
        row = {
            f"_w{i}_{j}": (F.lit(1.0) if i == j else -sum((F.col(f"_l{i}_{k}") * F.col(f"_w{k}_{j}") for k in range(j, i)), F.lit(0.0)))
            / F.col(f"_l{i}_{i}")
            for j in range(i + 1)
        }
        df = once(df, **row)
    logdet = sum((2 * F.log(F.col(f"_l{i}_{i}")) for i in range(p)), F.lit(0.0))
    return df.select(*keys, *[f"_m{i}" for i in range(p)], *[f"_w{i}_{j}" for i in range(p) for j in range(i + 1)],
                     logdet.alias("_logdet"))


def _distance(columns: list[str]) -> Column:
    p = len(columns)
    parts = []
    for i in range(p):
        dot = sum((F.col(f"_w{i}_{j}") * (F.col(columns[j]) - F.col(f"_m{j}")) for j in range(i + 1)), F.lit(0.0))
        parts.append(dot * dot)
    return sum(parts[1:], parts[0])


def _nearest(measured: DataFrame, half: float) -> DataFrame:
    """Per group and start the bin of squared distances up to which rows are in use."""
    bins = measured.groupBy("_g", "_start", "_bin").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("_g", "_start")
    counted = bins.select("*", F.sum("n").over(group.orderBy("_bin")).alias("upto"), F.sum("n").over(group).alias("all"))
    return counted.where(F.col("upto") >= half * F.col("all")).groupBy("_g", "_start").agg(F.min("_bin").alias("_last"))


def _bin(square: Column) -> Column:
    return F.floor(BINS * F.log(square + 1e-9)).cast("long")


def robust_distances(
    df: DataFrame, columns: list[str], floor: list[float], half: float = 0.75, steps: int = 4, trusted: float = 0.975
) -> DataFrame:
    """``df`` (with a group column ``_g`` and numbers, none null) plus ``_d2``, the squared robust distance.

    ``columns`` is an even number of dimensions. ``df`` is read several times: hand in a table.
    """
    p = len(columns)
    slim = df.select("_g", *columns)
    middle = written(_medians(slim, columns))
    shifted = slim.join(middle, "_g").select("_g", *[F.abs(F.col(c) - F.col(f"_m{i}")).alias(c) for i, c in enumerate(columns)])
    spread = _medians(shifted, columns).select("_g", *[
        F.greatest(1.4826 * F.col(f"_m{i}"), F.lit(floor[i])).alias(f"_a{i}") for i in range(p)
    ])
    start = written(middle.join(spread, "_g"))
    z = [(F.col(c) - F.col(f"_m{i}")) / F.col(f"_a{i}") for i, c in enumerate(columns)]
    # start 0: distance in robust units; start 1: shape of the squashed units, which outliers bend little
    squashed = slim.join(start, "_g").select("_g", *[F.tanh(v).alias(f"z{i}") for i, v in enumerate(z)])
    shape = _factors(squashed.groupBy("_g").agg(*_sums(p, lambda i: F.col(f"z{i}"))), p, 1.0, [0.1] * p, ["_g"])
    names = [f"_w{i}_{j}" for i in range(p) for j in range(i + 1)]
    shape = written(shape.select("_g", *names))
    units = slim.join(start, "_g").join(shape, "_g")
    plain = sum((v * v for v in z[1:]), z[0] * z[0])
    shaped = [sum((F.col(f"_w{i}_{j}") * z[j] for j in range(i + 1)), F.lit(0.0)) for i in range(p)]
    shaped = sum((v * v for v in shaped[1:]), shaped[0] * shaped[0])
    pair = F.explode(F.array(*[F.struct(F.lit(k).alias("_start"), _bin(d).alias("_bin")) for k, d in enumerate((plain, shaped))]))
    measured = units.select("_g", *columns, pair.alias("_x")).select("_g", *columns, "_x.*")
    factors = None
    for _ in range(steps):
        near = written(_nearest(measured, half))
        used = measured.join(near, ["_g", "_start"]).where(F.col("_bin") <= F.col("_last"))
        sums = used.groupBy("_g", "_start").agg(*_sums(p, lambda i: F.col(columns[i])))
        factors = written(_factors(sums, p, consistency(half, p), floor, ["_g", "_start"]))
        measured = slim.join(factors, "_g").select("_g", *columns, "_start", _bin(_distance(columns)).alias("_bin"))
    best = factors.groupBy("_g").agg(F.min(F.struct("_logdet", "_start")).alias("_b"))
    chosen = factors.join(best.select("_g", F.col("_b._start").alias("_start")), ["_g", "_start"]).drop("_start", "_logdet")
    inside = slim.join(chosen, "_g").where(_distance(columns) <= chi2_quantile(trusted, p))
    sums = inside.groupBy("_g").agg(*_sums(p, lambda i: F.col(columns[i])))
    final = written(_factors(sums, p, consistency(trusted, p), floor, ["_g"]).drop("_logdet"))
    return df.join(final, "_g", "left").withColumn("_d2", _distance(columns)).select(*df.columns, "_d2")
