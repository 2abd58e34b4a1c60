"""Bronze -> Silver: typing, suppression, grammar, dedup and rejects."""

from helpers import raw_df
from pyspark.sql import functions as F

from rxlake.operators import clean

PLAIN = {
    "Prscrbr_NPI": "  9 007", "Prscrbr_Last_Org_Name": " Okafor ", "Prscrbr_First_Name": "Bea", "Prscrbr_City": "lowell ",
    "Prscrbr_State_Abrvtn": " vt", "Prscrbr_State_FIPS": "50", "Prscrbr_Type": "sleep medicine", "Brnd_Name": "zolmira",
    "Gnrc_Name": "Zolmidine hcl", "Tot_Clms": "32", "Tot_30day_Fills": "40.25", "Tot_Drug_Cst": "144.00", "Tot_Day_Suply": "960",
    "Tot_Benes": "8", "GE65_Tot_Clms": "#", "GE65_Tot_Drug_Cst": "12.5", "GE65_Sprsn_Flag": "y",
}
HIDDEN = {**dict.fromkeys(PLAIN, " "), "Prscrbr_NPI": "77", "Tot_Clms": "suppressed", "Tot_Drug_Cst": "51.5", "Brnd_Name": "B", "Gnrc_Name": "G"}


def one(spark, **over):
    return clean.to_silver(raw_df(spark, [{**PLAIN, **over}]), year=2031).collect()[0].asDict()


def test_text_is_trimmed_and_typed(spark):
    row = one(spark)
    want = {
        "npi": "9 007", "prescriber_last_or_org_name": "Okafor", "city": "LOWELL", "state": "VT", "specialty": "SLEEP MEDICINE",
        "brand_name": "ZOLMIRA", "generic_name": "ZOLMIDINE HCL", "year": 2031, "tot_claims": 32, "tot_30day_fills": 40.25,
        "tot_drug_cost": 144.0, "tot_day_supply": 960, "ge65_claims": None, "ge65_drug_cost": 12.5, "cost_per_claim": 4.5,
        "claims_per_beneficiary": 4.0, "is_tot_claims_suppressed": False, "is_ge65_suppressed": True,
    }
    assert {c: row[c] for c in want} == want


def test_hidden_values_are_null_and_a_blank_state_is_unknown(spark):
    row = clean.to_silver(raw_df(spark, [HIDDEN]), year=2031).collect()[0].asDict()
    want = {"state": "UNKNOWN", "city": "", "tot_claims": None, "is_tot_claims_suppressed": True, "tot_drug_cost": 51.5, "cost_per_claim": None}
    assert {c: row[c] for c in want} == want


def test_number_grammar(spark):
    assert one(spark, Tot_Clms="1,234")["tot_claims"] == 1234
    r = one(spark, Tot_Clms="20.0")
    assert r["tot_claims"] is None and r["is_tot_claims_suppressed"] is False
    assert one(spark, Tot_Drug_Cst="1e5")["tot_drug_cost"] is None
    assert one(spark, Tot_Drug_Cst=".5")["tot_drug_cost"] == 0.5
    assert one(spark, Tot_Drug_Cst="5.")["tot_drug_cost"] == 5.0
    assert one(spark, Tot_Drug_Cst="+3")["tot_drug_cost"] == 3.0
    assert one(spark, Tot_Clms="99999999999999999999")["tot_claims"] is None


def test_suppression_tokens_any_case(spark):
    for token in (" suppressed ", "n/a", "Null", "#", "NA"):
        r = one(spark, Tot_Clms=token)
        assert r["tot_claims"] is None and r["is_tot_claims_suppressed"] is True, token


def test_ge65_flag_is_three_valued(spark):
    r = one(spark, GE65_Tot_Clms="10", GE65_Tot_Drug_Cst="5.0", GE65_Sprsn_Flag=None)
    assert r["is_ge65_suppressed"] is None
    r = one(spark, GE65_Tot_Clms="10", GE65_Tot_Drug_Cst="5.0", GE65_Sprsn_Flag="#")
    assert r["is_ge65_suppressed"] is True


def test_zero_denominators_give_null_ratios(spark):
    r = one(spark, Tot_Clms="0", Tot_Benes="0")
    assert r["cost_per_claim"] is None and r["claims_per_beneficiary"] is None


def test_dedup_same_winner_for_any_partitioning(spark):
    rows = [{**PLAIN, "Tot_Drug_Cst": str(100 + i), "Prscrbr_City": c} for i in range(6) for c in ("a", "b")]
    raw = raw_df(spark, rows)
    results = set()
    for n in (1, 3, 7):
        out = clean.to_silver(raw.repartition(n), year=2031).collect()
        assert len(out) == 1
        results.add(tuple(out[0]))
    assert len(results) == 1
    winner = dict(zip(clean.SILVER_COLUMNS, results.pop()))
    assert winner["city"] == "A" and winner["tot_drug_cost"] == 100.0


def test_reject_split_partitions_all_rows(spark):
    rows = [PLAIN, {**PLAIN, "Tot_Clms": "abc"}, {**PLAIN, "Tot_Drug_Cst": "-5"}, HIDDEN]
    accepted, rejected = clean.split_rejects(raw_df(spark, rows), year=2031)
    assert accepted.count() == 2 and rejected.count() == 2
    reasons = sorted(r[0] for r in rejected.select(F.explode("reject_reasons")).collect())
    assert reasons == ["negative_cost", "unparsable_number"]


def test_dedup_plan_trims_before_the_shuffle(spark, capsys):
    clean.to_silver(raw_df(spark, [PLAIN]), year=2031).explain()
    plan = capsys.readouterr().out
    # A partial group limit below the exchange: a hot key is cut map-side.
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")
    assert plan.count("WindowGroupLimit") == 2


def test_generated_methods_stay_small_enough_to_be_compiled(spark):
    # HotSpot interprets methods of more than 8,000 bytes for good.
    from rxlake.sources.standin import standin_raw

    def largest(df):
        debug = spark.sparkContext._jvm.org.apache.spark.sql.execution.debug
        found = getattr(debug, "package$").__getattr__("MODULE$").codegenStringSeq(df._jdf.queryExecution().executedPlan())
        return max((found.apply(i)._3().maxMethodCodeSize() for i in range(found.size())), default=0)

    raw = standin_raw(spark, "/root/testdata/sf0.001")
    for df in (clean.type_raw(raw, year_col="yr"), clean.flag_rejects(raw, year_col="yr")):
        assert 0 < largest(df) < 8000


def test_lines_of_the_raw_view_are_shuffled_by_part_and_order_only(spark):
    from rxlake.sources.standin import derive_raw

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = derive_raw(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "RoundRobin" not in plan
    assert plan.count("hashpartitioning(l_") == 2


def test_ratios_are_computed_after_the_shuffle(spark):
    from rxlake.sources.standin import standin_raw

    typed = clean.type_raw(standin_raw(spark, "/root/testdata/sf0.001"), year_col="yr")
    got, want = clean.dedup_typed(typed), clean.dedup_by_key(typed)
    assert got.schema == want.schema
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert "cost_per_claim" in got._jdf.queryExecution().executedPlan().toString().split("Exchange")[0]


def test_rows_with_a_key_of_their_own_are_not_shuffled(spark):
    rows = [{**PLAIN, "Prscrbr_NPI": str(i)} for i in range(40)] + [{**PLAIN, "Tot_Drug_Cst": "7"}] * 2
    plan = clean.to_silver(raw_df(spark, rows), year=2031)._jdf.queryExecution().executedPlan().toString()
    single, several = plan.split("WindowGroupLimit")[0], plan[plan.index("WindowGroupLimit") :]
    assert "Union" in single and "hashpartitioning" not in single.split("Window [")[0] and "hashpartitioning" in several


def test_repeated_keys_are_never_taken_for_single_ones(spark, monkeypatch):
    from rxlake.operators import repeats

    rows = [(i, f"k{i}" if i % 3 else None, i) for i in range(300)] + [(i, f"k{i}" if i % 3 else None, -1) for i in range(0, 300, 7)]
    df = spark.createDataFrame(rows, "a int, b string, c int")
    for bits in (64 * repeats.WORDS, repeats.BITS):
        monkeypatch.setattr(repeats, "BITS", bits)
        single, several = (p.collect() for p in repeats.split_repeats(df, ["a", "b"]))
        assert sorted(r["c"] for r in single + several) == sorted(r[2] for r in rows)
        assert not {r["a"] for r in single} & {r["a"] for r in several} and all(r["a"] % 7 for r in single)
        if bits > 1_000_000:
            assert {r["a"] for r in several} == set(range(0, 300, 7))
    assert repeats.split_repeats(df.where("a < 0"), ["a"])[0].count() == 0


def test_keys_of_raw_rows_are_those_of_typed_ones(spark):
    from rxlake.schemas import SILVER_KEY
    from rxlake.sources.standin import standin_raw

    raw = standin_raw(spark, "/root/testdata/sf0.001")
    of_raw, of_typed = raw.select(*[k.alias(c) for k, c in zip(clean.raw_key(year_col="yr"), SILVER_KEY, strict=True)]), clean.type_raw(raw, year_col="yr").select(*SILVER_KEY)
    assert of_raw.schema == of_typed.schema
    assert of_raw.exceptAll(of_typed).count() == 0 and of_typed.exceptAll(of_raw).count() == 0
