"""Bronze -> Silver: normalise, type, flag suppression, dedup, quarantine."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType

from rxlake.functions.cleaning import (
    UNKNOWN,
    default_blank,
    ge65_suppressed,
    in_grammar,
    number_text,
    parse_number,
    safe_divide,
)
from rxlake.operators.repeats import split_repeats
from rxlake.schemas import CORRUPT_COLUMN, SILVER_COLUMNS, SILVER_KEY

# --- fixed values: raw -> silver text columns (upper-cased or only trimmed) ---
TEXT_MAP = [
    ("npi", "Prscrbr_NPI", False),
    ("prescriber_last_or_org_name", "Prscrbr_Last_Org_Name", False),
    ("prescriber_first_name", "Prscrbr_First_Name", False),
    ("city", "Prscrbr_City", True),
    ("state", "Prscrbr_State_Abrvtn", True),
    ("state_fips", "Prscrbr_State_FIPS", False),
    ("specialty", "Prscrbr_Type", True),
    ("brand_name", "Brnd_Name", True),
    ("generic_name", "Gnrc_Name", True),
    ("ge65_suppression_flag", "GE65_Sprsn_Flag", True),
]

# --- fixed values: raw -> silver numeric columns ------------------------------
NUMERIC_MAP = [
    ("tot_claims", "Tot_Clms", LongType()),
    ("tot_30day_fills", "Tot_30day_Fills", DoubleType()),
    ("tot_drug_cost", "Tot_Drug_Cst", DoubleType()),
    ("tot_day_supply", "Tot_Day_Suply", LongType()),
    ("tot_beneficiaries", "Tot_Benes", LongType()),
    ("ge65_claims", "GE65_Tot_Clms", LongType()),
    ("ge65_drug_cost", "GE65_Tot_Drug_Cst", DoubleType()),
]

# --- fixed values: ratio -> numerator and denominator --------------------------
RATIOS = {"cost_per_claim": ("tot_drug_cost", "tot_claims"), "claims_per_beneficiary": ("tot_claims", "tot_beneficiaries")}


# --- fixed values: quarantine rules (name -> predicate on typed rows) ---------
REJECT_RULES = {
    "malformed_line": lambda: F.col(CORRUPT_COLUMN).isNotNull(),
    "unparsable_number": lambda: F.col("_unparsable_number"),
    "negative_cost": lambda: F.col("tot_drug_cost") < 0,
    "missing_npi": lambda: F.col("npi").isNull() | (F.col("npi") == ""),
}
DEFAULT_REJECT_RULES = ("malformed_line", "unparsable_number", "negative_cost")


def _year(year: int | None, year_col: str) -> Column:
    return F.lit(year).cast(IntegerType()) if year is not None else F.col(year_col).cast(IntegerType())


def type_raw(
    raw: DataFrame, year: int | None = None, year_col: str = "year", keep_audit: bool = False, extra: list[str] | None = None
) -> DataFrame:
    """Raw text -> typed Silver columns (before dedup), in four narrow steps.

    ``year`` is a constant for one yearly file; otherwise it is read from
    ``year_col``. With ``keep_audit`` the corrupt-line text and an
    "unparsable number" marker are kept for the reject split.

    Steps: (1) trim every raw column; (2) the text of each number, NULL where it is
    suppressed; (3) flags, labels and parsed numbers; (4) ratios and the marker, which
    tries the grammar again only where a parse gave nothing. Each step reads the
    columns of the one before several times, so Catalyst keeps them apart, and every
    generated method stays below the size that the JIT compiles (tested)."""
    year_expr = _year(year, year_col)
    texts, numbers = [src for _, src, _ in TEXT_MAP], [src for _, src, _ in NUMERIC_MAP]
    keep = [CORRUPT_COLUMN] if keep_audit and CORRUPT_COLUMN in raw.columns else []
    rest = [year_expr.alias("year"), *keep, *(extra or [])]
    trimmed = raw.select(*[F.trim(F.col(c)).alias(c) for c in [*texts, *numbers]], *rest)
    rest = ["year", *keep, *(extra or [])]
    clean = trimmed.select(*texts, *[number_text(c).alias(c) for c in numbers], *rest)

    cols = {name: (F.upper(F.col(src)) if upper else F.col(src)) for name, src, upper in TEXT_MAP}
    cols["state"] = default_blank(cols["state"], UNKNOWN)
    cols["year"] = F.col("year")
    cols["is_tot_claims_suppressed"] = F.col("Tot_Clms").isNull()
    cols["is_ge65_suppressed"] = ge65_suppressed("GE65_Tot_Clms", "GE65_Tot_Drug_Cst", cols["ge65_suppression_flag"])
    for name, src, target in NUMERIC_MAP:
        cols[name] = parse_number(src, target)
    audit = [*keep, *(extra or [])]
    typed = clean.select(*[cols[c].alias(c) for c in SILVER_COLUMNS if c in cols], *([F.col(src).alias(f"_text_{name}") for name, src, _ in NUMERIC_MAP] if keep_audit else []), *audit)

    ratios = {c: safe_divide(*of) for c, of in RATIOS.items()}
    out = [ratios[c].alias(c) if c in ratios else F.col(c) for c in SILVER_COLUMNS]
    if keep_audit:
        bad = [F.col(name).isNull() & F.col(f"_text_{name}").isNotNull() & ~in_grammar(f"_text_{name}", target) for name, _, target in NUMERIC_MAP]
        out += [F.lit(None).cast("string").alias(CORRUPT_COLUMN)] * (not keep)
        out.append(reduce(lambda a, b: a | b, bad).alias("_unparsable_number"))
    return typed.select(*out, *audit)


def dedup_order() -> list[Column]:
    """Total tie-break for rows sharing a business key: every non-key column,
    ascending, NULLs last. Rows still tied are identical, so the winner is the
    same for any partitioning and any run."""
    return [F.col(c).asc_nulls_last() for c in SILVER_COLUMNS if c not in SILVER_KEY]


def dedup_by_key(df: DataFrame, keys: list[str] | None = None, order: list[Column] | None = None, watch: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Keep one row per key (NULL keys compare equal) chosen by a total order.

    Only rows whose key may occur twice are compared (``repeats.split_repeats``, which
    reads ``df`` ahead); the others stay where they are. The comparison is planned as
    ``row_number() = 1``: Spark inserts a partial WindowGroupLimit before the shuffle,
    so a hot key is cut to one row per map task before it crosses the network. Both
    sorts begin with a hash of the key, a number that tells most keys apart without
    their texts. ``watch`` is applied to both parts on their way."""
    keys = keys or SILVER_KEY
    single, several = split_repeats(df, keys)
    if watch:
        single, several = watch(single), watch(several)
    return _first_of_each(single, several, keys, order or dedup_order())


def _first_of_each(single: DataFrame, several: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy("_key", *keys).orderBy(*order)
    hashed = several.withColumn("_key", F.hash(*keys))
    first = hashed.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn", "_key")
    return single.unionByName(first)


def _typed_order() -> list[Column]:
    """Ratios follow from columns that come before them in the tie-break."""
    return [F.col(c).asc_nulls_last() for c in SILVER_COLUMNS if c not in SILVER_KEY and c not in RATIOS]


def _with_ratios(kept: DataFrame) -> DataFrame:
    return kept.select(*[safe_divide(*RATIOS[c]).alias(c) if c in RATIOS else F.col(c) for c in SILVER_COLUMNS])


def dedup_typed(typed: DataFrame, watch: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Typed Silver rows, one per key. Ratios are left out of the shuffle and computed
    again."""
    return _with_ratios(dedup_by_key(typed.drop(*RATIOS), order=_typed_order(), watch=watch))


def raw_key(year: int | None = None, year_col: str = "year") -> list[Column]:
    """The business key of a raw row, as ``type_raw`` gives it."""
    cols = {name: F.upper(F.trim(src)) if upper else F.trim(src) for name, src, upper in TEXT_MAP}
    cols["state"] = default_blank(cols["state"], UNKNOWN)
    cols["year"] = _year(year, year_col)
    return [cols[c] for c in SILVER_KEY]


def to_silver(raw: DataFrame, year: int | None = None, year_col: str = "year") -> DataFrame:
    """Bronze -> Silver: typed, flagged and unique on (year, npi, state, brand, generic).
    Raw rows are told apart by the repeats of their key, so each is typed once."""
    parts = split_repeats(raw, raw_key(year, year_col))
    single, several = (type_raw(part, year, year_col).drop(*RATIOS) for part in parts)
    return _with_ratios(_first_of_each(single, several, SILVER_KEY, _typed_order()))


def flag_rejects(
    raw: DataFrame, rules: tuple[str, ...] = DEFAULT_REJECT_RULES, year: int | None = None, year_col: str = "year", extra: list[str] | None = None
) -> DataFrame:
    """Typed rows with ``reject_reasons`` (none: accepted) and the text of
    malformed lines; not yet deduplicated."""
    typed = type_raw(raw, year, year_col, keep_audit=True, extra=extra)
    reasons = F.array_compact(F.array(*[F.when(REJECT_RULES[r](), F.lit(r)) for r in rules]))
    return typed.withColumn("reject_reasons", reasons).drop("_unparsable_number")


def split_rejects(raw: DataFrame, rules: tuple[str, ...] = DEFAULT_REJECT_RULES, **kw) -> tuple[DataFrame, DataFrame]:
    """(accepted typed rows, rejected rows with reasons): together all input rows."""
    flagged = flag_rejects(raw, rules, **kw)
    accepted = flagged.where(F.size("reject_reasons") == 0).select(*SILVER_COLUMNS)
    return accepted, flagged.where(F.size("reject_reasons") > 0)
