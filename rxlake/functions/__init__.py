from rxlake.functions.cleaning import (
    default_blank,
    ge65_suppressed,
    in_grammar,
    number_text,
    parse_number,
    safe_divide,
)
from rxlake.functions.keys import drug_id, fact_id, full_name, prescriber_id, stable_hash
from rxlake.functions.money import money_sum, stable_avg, stable_sum

__all__ = [
    "default_blank",
    "drug_id",
    "fact_id",
    "full_name",
    "ge65_suppressed",
    "in_grammar",
    "money_sum",
    "number_text",
    "parse_number",
    "prescriber_id",
    "safe_divide",
    "stable_avg",
    "stable_hash",
    "stable_sum",
]
