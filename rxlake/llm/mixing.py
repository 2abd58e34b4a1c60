"""Mixing sources to target weights.

Tokens are summed by source, targets are set by weight with a ceiling, and each
document is emitted floor(rate) times plus once more with probability equal to
the fraction, decided by a hash of the document's id, its text and its number among
rows that have both in common: a rerun takes the same.

Defined cases: a null or empty text has size 0; a null source is a source of its
own and comes last; a source of size 0 has target 0 and no copies; repeated rows,
also those of a null id, draw each; an empty table gives no rows. Columns of the
input are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxlake.llm.store import free_name, global_prefix, keep

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_draw(seed: str, key: Column) -> Column:
    """A number in [0, 1) from the hash of a key: 52 bits of its MD5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def numbered(docs: DataFrame, key: str, out: str) -> DataFrame:
    """``docs`` with the number (from 0) of each row among those of equal ``key``.

    Only keys that repeat are numbered: over salts of rows, so that a hot key is
    dealt to many tasks, with the salts' counts before each."""
    salt, n, again = free_name(docs.withColumn(out, F.lit(0)), "_salt", "_n", "_again")
    repeated = keep(docs.groupBy(key).agg(F.count("*").alias(n)).where(F.col(n) > 1).select(F.col(key).alias(again)), "repeated")
    held = docs.join(repeated, F.col(key) == F.col(again), "left_semi").withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(64)))
    held = keep(held, "repeated")
    counts = held.groupBy(key, salt).agg(F.count("*").alias(n))
    before = Window.partitionBy(key).orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(key, salt, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n))
    inside = F.row_number().over(Window.partitionBy(key, salt).orderBy(F.lit(1))) - 1
    held = held.withColumn(out, inside).join(counts, [key, salt]).withColumn(out, (F.col(out) + F.col(n)).cast("long"))
    single = docs.join(repeated, F.col(key) == F.col(again), "left_anti").withColumn(out, F.lit(0).cast("long"))
    return single.unionByName(held.drop(salt, n))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: tuple[int, int], ceiling: int) -> DataFrame:
    """One row a source: source, source_size, target.

    Sources in ascending order (null last) take the weights in turn. The sum of
    targets is ``share`` (a fraction) of all sizes; a target stops at
    ``ceiling`` times its source's size, and the rest is shared again by weight.
    With the sources in order of ceiling / weight, a source is at its ceiling
    if the level reached without all those before it exceeds its own, so two
    prefix sums decide it. Sums are exact integers."""
    num, den = share
    src = keep(sizes, "sources")
    ranked = global_prefix(src, [F.col("source").asc_nulls_last()], {"rank": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    big = "decimal(38,0)"
    ranked = ranked.withColumn("w", weight.cast("long")).withColumn("cap", (F.col("source_size") * ceiling).cast("long"))
    ranked = keep(ranked, "ranked")
    by_level = [(F.col("cap") / F.col("w")).asc(), F.col("rank").asc()]
    row = ranked.agg(F.sum("source_size").alias("s"), F.sum("w").alias("w")).first()
    total, all_w = int(row["s"] or 0), int(row["w"] or 0)
    pool = total * num  # times den
    placed = global_prefix(ranked, by_level, {"cap_before": F.col("cap"), "w_before": F.col("w")})
    lhs = F.col("w").cast(big) * (F.lit(pool).cast(big) - F.col("cap_before").cast(big) * den)
    rhs = F.col("cap").cast(big) * (F.lit(all_w).cast(big) - F.col("w_before").cast(big)) * den
    placed = keep(placed.withColumn("full", lhs >= rhs), "placed")
    row = placed.where("full").agg(F.sum("cap").alias("c"), F.sum("w").alias("w")).first()
    rest, rest_w = pool - den * int(row["c"] or 0), all_w - int(row["w"] or 0)
    level = F.col("w").cast("double") * F.lit(float(rest)) / F.lit(float(den * max(rest_w, 1)))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(level)
    return keep(placed.select("source", "source_size", target.alias("target")), "targets")


def plan_mix(docs: DataFrame, out: str = "mix", *, weights: Sequence[int] = (3, 1, 2), share: tuple[int, int] = (3, 2), ceiling: int = 2, seed: str = "mix") -> DataFrame:
    """``docs`` with the struct ``out``: size, source_size, target, copies."""
    size, src, key, nth = free_name(docs, "_size", "_source", "_key", "_nth")
    own = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce(F.col("text"), F.lit(""))))
    sized = docs.withColumn(size, word_count(F.col("text"))).withColumn(key, own)
    sizes = sized.groupBy(F.col("source")).agg(F.sum(size).cast("long").alias("source_size"))
    targets = source_targets(sizes, weights, share, ceiling)
    # The rate is of the source: worked out a source, not a row, which leaves little
    # code to the stage that writes the texts.
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    of_source = F.struct("source_size", "target", F.floor(rate).alias("whole"), (rate - F.floor(rate)).alias("part"))
    targets = targets.select(F.col("source").alias(src), of_source.alias(f"{src}_t"))
    sized = numbered(sized, key, nth)
    joined = sized.join(targets, sized["source"].eqNullSafe(targets[src]))
    total, target = F.col(f"{src}_t.source_size"), F.col(f"{src}_t.target")
    draw = unit_draw(seed, F.concat(F.col(key), F.lit(":"), F.col(nth).cast("string")))
    copies = F.col(f"{src}_t.whole") + F.when(draw < F.col(f"{src}_t.part"), 1).otherwise(0)
    mixed = F.struct(F.col(size).alias("size"), total.alias("source_size"), target.alias("target"), copies.cast("long").alias("copies"))
    kept = [F.col(c) for c in docs.columns if c.lower() != out.lower()]
    return joined.select(*kept, mixed.alias(out))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: each document as many times as it is taken."""
    (out, i) = free_name(docs, "_mix", "_copy")
    planned = plan_mix(docs, out, **options)
    # No copies are an empty array; a filter on them would draw each row twice.
    return planned.withColumn(i, F.explode(F.array_repeat(F.lit(True), F.col(f"{out}.copies").cast("int")))).select(*docs.columns)
