"""Peer-group outliers: exact group quantiles that stay distributed under skew,
peer thresholds (percentile, IQR, z-score) and the outlier filter / flag.

Why not ``percentile_disc`` / ``percentile`` as one aggregate: those keep every
distinct value of a group in one buffer in one task, so a peer group holding a
third of all rows would land whole in one task. ``group_quantiles`` narrows the
range of each wanted rank instead, in passes over the values still in range:

1. a pass counts, per group and rank, the values below, at, between, and above two
   split points, and sketches those between with ``percentile_approx``: partial
   aggregates of bounded size, whatever the group's;
2. the counts tell exactly which of these parts holds the rank: a split point is the
   answer, any other part is the next range, with split points close around the
   rank from the sketch (a wrong guess costs a pass, never the result);
3. ranks that are not settled go on. A pass leaves about a fortieth of the values and
   never the split points themselves, so four passes settle 10^6 distinct values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxlake.functions.money import stable_avg, stable_stddev
from rxlake.session import stored

# --- fixed values -------------------------------------------------------------
ANOMALY_REASON = "avg_cost_per_claim_gt_peer_p95"
REFERENCE_PEER_KEYS = ("year", "state", "specialty")
DRUG_PEER_KEYS = ("year", "state", "specialty", "generic_name")

#: Steps of a sketch's grid, and its accuracy (a quarter of a step).
GRID = 128
ACCURACY = 4 * GRID


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    r = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"_k_{k}"]) for k in keys])
    return left.join(r, cond, how).drop(*[f"_k_{k}" for k in keys])


def _ranks(kind: str, q: float, n: Column) -> tuple[Column, Column, Column]:
    """1-based ranks (r1, r2) of the order statistics and the interpolation weight.

    disc: the first value whose cumulative share reaches q -> rank ceil(q n).
    cont: linear interpolation at 0-based position q (n - 1)."""
    if kind == "disc":
        r = F.greatest(F.ceil(F.lit(q) * n), F.lit(1)).cast("long")
        return r, r, F.lit(0.0)
    pos = F.lit(q) * (n - F.lit(1))
    return (F.floor(pos) + 1).cast("long"), (F.ceil(pos) + 1).cast("long"), pos - F.floor(pos)


_RANGE = ["_rank", "_below", "_lo", "_hi", "_a", "_b"]


def _grid(value: Column, accuracy: int) -> Column:
    return F.percentile_approx(value, [i / GRID for i in range(GRID + 1)], accuracy)


def _splits(grid: Column, rank: Column, n: Column, low: Column, high: Column, accuracy: int) -> list[Column]:
    """Points of the grid around a rank, as far to each side as the sketch may err;
    the middle one where these would be the ends of the range ``low`` to ``high``, so
    that a pass at least halves what is left."""
    margin = 1 + GRID // accuracy
    step = F.floor((rank - 0.5) / n * GRID).cast("int") + 1  # arrays count from 1
    a, b = F.element_at(grid, F.greatest(step - margin, F.lit(1))), F.element_at(grid, F.least(step + 1 + margin, F.lit(GRID + 1)))
    wide, middle = (a <= low) & (b >= high), F.element_at(grid, F.lit(GRID // 2 + 1))
    return [F.when(wide, middle).otherwise(x) for x in (a, b)]


def _narrow(base: DataFrame, ranges: DataFrame, keys: list[str], value: str, accuracy: int) -> DataFrame:
    """One pass: the ranges (keys and ``_RANGE``) that hold the ranks afterwards."""
    v = F.col(value)
    rows = _null_safe_join(base, ranges, keys).where((v >= F.col("_lo")) & (v <= F.col("_hi")))
    a, b = F.col("_a"), F.col("_b")
    inside = (v > a) & (v < b)
    seen = rows.groupBy(*keys, *_RANGE).agg(
        F.count_if(v < a).alias("_c0"), F.count_if(v == a).alias("_c1"), F.count_if(inside).alias("_c2"), F.count_if((v == b) & (a < b)).alias("_c3"),
        F.max(F.when(v < a, v)).alias("_under"), F.min(F.when(inside, v)).alias("_first"), F.max(F.when(inside, v)).alias("_last"), F.min(F.when(v > b, v)).alias("_over"),
        _grid(F.when(inside, v), accuracy).alias("_grid"),
    )
    r = F.col("_rank") - F.col("_below")
    ends = [F.col("_c0"), F.col("_c0") + F.col("_c1"), F.col("_c0") + F.col("_c1") + F.col("_c2"), F.col("_c0") + F.col("_c1") + F.col("_c2") + F.col("_c3")]

    def part(*choices) -> Column:
        out = F.when(r <= ends[0], choices[0])
        for end, choice in zip(ends[1:], choices[1:4], strict=True):
            out = out.when(r <= end, choice)
        return out.otherwise(choices[4])

    low = part(F.col("_lo"), a, F.col("_first"), b, F.col("_over"))
    high = part(F.col("_under"), a, F.col("_last"), b, F.col("_hi"))
    below = F.col("_below") + part(F.lit(0), *ends)
    between = (r > ends[1]) & (r <= ends[2])
    split = _splits(F.col("_grid"), r - ends[1], F.col("_c2"), F.col("_first"), F.col("_last"), accuracy)
    near = [F.when(between, s).otherwise(x) for s, x in zip(split, (low, high), strict=True)]
    return seen.select(*keys, "_rank", below.cast("long").alias("_below"), low.alias("_lo"), high.alias("_hi"), near[0].alias("_a"), near[1].alias("_b"))


def group_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    quantiles: dict[str, tuple[float, str]],
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Exact per-group quantiles, e.g. ``{"p95": (0.95, "disc"), "q1": (0.25, "cont")}``.

    ``disc`` equals SQL ``percentile_disc`` (a member of the group), ``cont``
    equals ``percentile_cont`` (interpolated). NULL values are ignored; groups
    with no value are absent. Output: keys, ``n`` and one column per quantile.

    All quantiles share the passes (see the module's text). ``df`` is read by each
    pass and should be a stored table; ranges of a pass are stored, a row a rank."""
    keys = list(keys)
    if not keys:
        raise ValueError("group_quantiles needs at least one group key")
    v = F.col(value).cast("double")
    base = df.where(v.isNotNull()).select(*keys, v.alias(value))
    specs = list(quantiles.items())
    ranks = [_ranks(kind, q, F.col("_n")) for _, (q, kind) in specs]
    stats = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(value).alias("_lo"), F.max(value).alias("_hi"), _grid(F.col(value), accuracy).alias("_grid"))
    wanted = F.array_distinct(F.array(*[r for r1, r2, _ in ranks for r in (r1, r2)]))
    first = stats.select(*keys, "_n", "_lo", "_hi", "_grid", F.explode(wanted).alias("_rank"))
    a, b = _splits(F.col("_grid"), F.col("_rank"), F.col("_n"), F.col("_lo"), F.col("_hi"), accuracy)
    first = stored(first.select(*keys, "_n", "_rank", F.lit(0).cast("long").alias("_below"), "_lo", "_hi", a.alias("_a"), b.alias("_b")), "ranks")
    groups = first.select(*keys, "_n").distinct()
    settled, ranges = [], first.drop("_n")
    while True:
        settled.append(ranges.where("_lo = _hi").select(*keys, "_rank", F.col("_lo").alias("_v")))
        ranges = ranges.where("_lo < _hi")
        if ranges.isEmpty():
            break
        ranges = stored(_narrow(base, ranges, keys, value, accuracy), "ranks")
    found = reduce(lambda x, y: x.union(y), settled)
    by_rank = F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at")  # a few ranks a group
    with_n = _null_safe_join(found.groupBy(*keys).agg(by_rank), groups, keys)
    columns = []
    for (name, (_, kind)), (r1, r2, w) in zip(specs, ranks, strict=True):
        v1, v2 = F.element_at("_at", r1), F.element_at("_at", r2)
        columns.append((v1 + (v2 - v1) * w if kind == "cont" else v1).alias(name))
    return with_n.select(*keys, F.col("_n").alias("n"), *columns)


def approx_group_quantiles(
    df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float], accuracy: int = 10_000
) -> DataFrame:
    """``percentile_approx`` per group (bounded sketch; the reference's own method
    uses accuracy 100)."""
    aggs = [F.percentile_approx(value, q, accuracy).alias(name) for name, q in quantiles.items()]
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *aggs)


def peer_thresholds(
    df: DataFrame,
    peer_keys: tuple[str, ...] = REFERENCE_PEER_KEYS,
    metric: str = "avg_cost_per_claim",
    method: str = "percentile",
    q: float = 0.95,
    exact: bool = True,
    accuracy: int = 10_000,
    iqr_k: float = 1.5,
    z: float = 3.0,
) -> DataFrame:
    """Upper threshold of ``metric`` per peer group, over all group members.

    percentile: the q-quantile (a member of the group); iqr: Q3 + k (Q3 - Q1);
    zscore: mean + z * stddev_samp. Output: peer keys, ``peer_threshold`` and
    the statistics behind it."""
    keys = list(peer_keys)
    if method == "percentile":
        if exact:
            t = group_quantiles(df, keys, metric, {"peer_threshold": (q, "disc")})
        else:
            t = approx_group_quantiles(df, keys, metric, {"peer_threshold": q}, accuracy)
        return t.withColumnRenamed("n", "peer_size")
    if method == "iqr":
        if exact:
            t = group_quantiles(df, keys, metric, {"q1": (0.25, "cont"), "q3": (0.75, "cont")})
        else:
            t = approx_group_quantiles(df, keys, metric, {"q1": 0.25, "q3": 0.75}, accuracy)
        return t.withColumnRenamed("n", "peer_size").withColumn(
            "peer_threshold", F.col("q3") + F.lit(iqr_k) * (F.col("q3") - F.col("q1"))
        )
    if method == "zscore":
        t = df.where(F.col(metric).isNotNull()).groupBy(*keys).agg(
            F.count(F.lit(1)).alias("peer_size"),
            stable_avg(metric).alias("peer_mean"),
            stable_stddev(metric).alias("peer_stddev"),
        )
        return t.withColumn("peer_threshold", F.col("peer_mean") + F.lit(z) * F.col("peer_stddev"))
    raise ValueError(f"unknown method {method!r}")


def peer_outliers(
    df: DataFrame,
    peer_keys: tuple[str, ...] = REFERENCE_PEER_KEYS,
    metric: str = "avg_cost_per_claim",
    volume: str = "total_claims",
    min_volume: int = 30,
    method: str = "percentile",
    mode: str = "filter",
    materialize: bool = True,
    **threshold_args,
) -> DataFrame:
    """Rows whose ``metric`` is strictly above their peer group's threshold.

    Only rows with ``volume >= min_volume`` and a non-NULL metric can be
    outliers; groups are matched on equal, non-NULL keys. ``mode="filter"``
    returns the outliers with the threshold; ``mode="flag"`` returns every row
    with ``peer_threshold`` and a boolean ``is_anomaly``.

    The thresholds have one row per peer group; the join is left to AQE, which
    broadcasts them at run time when their measured size is small and uses a
    skew-split shuffle join otherwise.

    The input is read several times (passes, final join), so by default it is first
    stored once in the shared folder; pass ``materialize=False`` when ``df`` is
    already a stored table."""
    keys = list(peer_keys)
    if materialize:
        df = stored(df, "members")
    thr = peer_thresholds(df, peer_keys, metric, method, **threshold_args)
    eligible = (
        (F.col(volume) >= F.lit(min_volume))
        & F.col(metric).isNotNull()
        & F.col("peer_threshold").isNotNull()
        & (F.col(metric) > F.col("peer_threshold"))
    )
    if mode == "filter":
        return df.join(thr, keys, "inner").where(eligible)
    if mode == "flag":
        return df.join(thr, keys, "left").withColumn("is_anomaly", F.coalesce(eligible, F.lit(False)))
    raise ValueError(f"unknown mode {mode!r}")


def approx_rank_error(df: DataFrame, keys: list[str], metric: str, q: float = 0.95, accuracy: int = 100) -> DataFrame:
    """Per group: peer_size and whether the approximate q-quantile keeps its
    promise, a rank no further than size / accuracy (and one) from q * size."""
    thr = approx_group_quantiles(df, keys, metric, {"_q": q}, accuracy)
    known = df.where(F.col(metric).isNotNull())
    ranks = known.join(thr, keys).groupBy(*keys).agg(
        F.first("n").alias("peer_size"), F.count_if(F.col(metric) < F.col("_q")).alias("_lo"), F.count_if(F.col(metric) <= F.col("_q")).alias("_hi")
    )
    slack, target = F.col("peer_size") / accuracy + 1, F.col("peer_size") * q
    return ranks.select(*keys, "peer_size", ((F.col("_lo") <= target + slack) & (F.col("_hi") >= target - slack)).alias("within_bound"))


def anomaly_prescribers(summary: DataFrame, peer_keys: tuple[str, ...] = REFERENCE_PEER_KEYS, **kw) -> DataFrame:
    """The anomaly mart: prescribers whose average cost per claim is above the
    95th percentile of their peers (same year, state and specialty by default),
    with at least 30 claims."""
    from rxlake.schemas import MART_COLUMNS

    out = peer_outliers(summary, peer_keys, **kw)
    return out.select(
        *[c for c in MART_COLUMNS["gold_anomaly_prescribers"] if c not in ("peer_p95_cost_per_claim", "anomaly_reason")],
        F.col("peer_threshold").alias("peer_p95_cost_per_claim"),
        F.lit(ANOMALY_REASON).alias("anomaly_reason"),
    )
