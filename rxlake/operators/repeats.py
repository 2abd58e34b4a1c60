"""Rows whose key may occur twice, found by the hashes of keys alone.

Most keys of a table occur once. Shuffling 64-bit hashes tells which do not, so that
only rows of the others are moved whole. What is told is one-sided: a key that occurs
twice always counts as repeated, one that occurs once seldom does (its hash, or its
place among the bits, is that of a repeated one), and an exact step decides over all
that count as repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlake.session import stored

#: Bits that mark repeated hashes: 8 MB when all of them are in use.
BITS = 1 << 26
#: Words of 64 bits in a row of the table of bits.
WORDS = 8


def key_hash(keys: list[str | Column]) -> Column:
    """NULLs count as equal to each other, as in a grouping."""
    return F.xxhash64(*keys)


def repeated_hashes(df: DataFrame, keys: list[str | Column], name: str = "_hash") -> DataFrame:
    """The hashes of keys that two rows or more of ``df`` have; stored. A hot key is
    counted before the shuffle."""
    counts = df.select(key_hash(keys).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
    return stored(counts.where("_n > 1").select(name), "repeated")


def _places() -> list[Column]:
    """Row, word of it and bit of that for a hash."""
    at = F.pmod("_hash", F.lit(BITS))
    row, word, bit = F.floor(at / (64 * WORDS)), F.pmod(F.shiftright(at, 6), F.lit(WORDS)), F.pmod(at, F.lit(64))
    return [row.cast("int").alias("_piece"), word.cast("int").alias("_word"), bit.cast("int").alias("_bit")]


def _bits(hashes: DataFrame) -> DataFrame:
    """_piece, _bits: the bits of all hashes, BITS / 64 / WORDS rows at most."""
    words = hashes.select(*_places()).groupBy("_piece", "_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    slots = [F.coalesce(F.bit_or(F.when(F.col("_word") == i, F.col("_bits"))), F.lit(0).cast("long")) for i in range(WORDS)]
    return words.groupBy("_piece").agg(F.array(*slots).alias("_bits"))


def split_repeats(df: DataFrame, keys: list[str | Column]) -> tuple[DataFrame, DataFrame]:
    """``df`` as (rows whose key no other row has, the others). All rows of one key are
    on one side. ``df`` is read once here and once for each part: it should come from
    a stored table, and give the same rows each time.

    The table of bits is bounded, so it is broadcast whatever the planner may know of
    its size, and the rows themselves are not moved. With very many repeated keys the
    bits fill up and more rows count as repeated."""
    bits = stored(_bits(repeated_hashes(df, keys)), "repeated-bits")
    told = df.withColumn("_hash", key_hash(keys)).select(*df.columns, *_places()).join(F.broadcast(bits), "_piece", "left")
    # The bit in question is shifted to the sign.
    marked = F.expr("coalesce(shiftleft(get(_bits, _word), 63 - _bit) < 0, false)")
    return told.where(~marked).select(*df.columns), told.where(marked).select(*df.columns)
