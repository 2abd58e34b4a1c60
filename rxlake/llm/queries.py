"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlake.llm import bestfit, html_main, jaccard, mixing, packing, phrases, quality, repair, rnn_lm, secret_scan, suffix_dedup, token_counts, topk
from rxlake.llm.oracle import OP12_SQL, OP13_SQL

WORDS = r"regexp_extract_all(coalesce({t}, ''), '[^\x20\x09-\x0D]+')"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    m = "mix"
    taken = F.col(f"{m}.size") * F.col(f"{m}.copies")
    return mixing.plan_mix(docs, m).select("doc_id", f"{m}.size", f"{m}.source_size", f"{m}.target", taken.alias("taken"))


OP1_SQL = f"""
WITH d AS (SELECT doc_id, source, len({WORDS.format(t="text")})::BIGINT AS size, coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, '')) AS key FROM documents),
s AS (SELECT source, sum(size)::HUGEINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT + 1]::HUGEINT AS w FROM s),
p AS (SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
        coalesce(sum(2 * source_size) OVER o, 0) AS cap_before, coalesce(sum(w) OVER o, 0) AS w_before
      FROM r WINDOW o AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, w * (3 * total - 2 * cap_before) >= 4 * source_size * (all_w - w_before) AS at_cap FROM p),
g AS (SELECT *, coalesce(sum(CASE WHEN at_cap THEN 2 * source_size END) OVER (), 0) AS c, coalesce(sum(CASE WHEN at_cap THEN w END) OVER (), 0) AS cw FROM f),
t AS (SELECT source, source_size::BIGINT AS source_size,
        CASE WHEN at_cap THEN (2 * source_size)::DOUBLE
             ELSE w::DOUBLE * (3 * total - 2 * c)::DOUBLE / (2 * greatest(all_w - cw, 1))::DOUBLE END AS target FROM g),
q AS (SELECT d.doc_id, d.size, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
        ('0x' || substr(md5('mix:' || key || ':' || (row_number() OVER (PARTITION BY key) - 1)), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM q
"""


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5)


OP2_SQL = """
WITH e AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: coalesce(z[1] * z[2], 0))), 0)::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op3_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_main.main_text(pages, ["page_id", "url"]).withColumn("n_chars", F.length("text").cast("long"))


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, byte_bpe(), ["doc_id"], with_ids=False)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_by_section(docs, byte_bpe(), ["doc_id"])


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    found = secret_scan.findings(docs, ["doc_id"], out="f")
    base, spans = secret_scan.as_text(F.col("f.base")), secret_scan.as_text(F.col("f.spans"))
    return found.select("doc_id", "f.n_assign", "f.n_access", "f.n_hex", "f.n_live", F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"))


_Q = "'"
OP6_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner,
             concat(coalesce(source, ''), chr(31), coalesce(lang, '')) AS repo, md5(coalesce(text, '')) AS digest FROM documents),
p(kind, name, least, pat) AS (VALUES {patterns}),
m AS (SELECT rid, owner, repo, digest, kind, name, least, pat, regexp_extract_all(text, pat, 0) AS w, string_split_regex(text, pat) AS g
      FROM d, p WHERE regexp_matches(text, pat)),
e AS (SELECT rid, owner, repo, digest, kind, name, least, pat, unnest(range(len(w))) AS i, w, g FROM m),
l AS (SELECT rid, owner, repo, digest, kind, name, least, pat, i, w[i + 1] AS hit, length(w[i + 1]) AS len, length(g[i + 1]) AS gap FROM e),
s AS (SELECT *, CASE WHEN kind = 0 THEN regexp_extract(hit, pat, 1) ELSE hit END AS value,
        sum(gap + len) OVER (PARTITION BY rid, kind ORDER BY i)::BIGINT AS stop FROM l),
c AS (SELECT rid, owner, repo, digest, kind, name, stop - len AS start, stop, value FROM s
      WHERE length(value) >= least AND (kind < 3 OR (regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')))),
g AS (SELECT *, min(repo) OVER (PARTITION BY value, digest) AS place FROM c),
h AS (SELECT value, NOT ((count(DISTINCT owner) > {owners} AND count(DISTINCT digest) > 1) OR count(DISTINCT place) > {repositories}) AS live FROM g GROUP BY value),
j AS (SELECT c.*, live FROM c JOIN h USING (value) WHERE kind < 3 OR live),
r AS (SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
        count(*) FILTER (live) AS n_live,
        string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop) FILTER (kind < 3) AS base,
        string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop) AS spans FROM j GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       coalesce(n_live, 0) AS n_live, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN r USING (rid)
""".format(
    owners=secret_scan.MAX_OWNERS,
    repositories=secret_scan.MAX_REPOSITORIES,
    patterns=", ".join(f"({i}, '{k}', {least}, '{pat.replace(_Q, _Q * 2)}')" for i, (k, pat, _, least) in enumerate([*secret_scan.BASE, secret_scan.MIXED])),
)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality.QualityRules.fit(docs, read(spark, sf_dir, "labels"))
    found = quality.assess(docs, rules, ["doc_id"], "q")
    return found.select("doc_id", *[f"q.{c}" for c in [*quality.COUNTS, "base_failed", "kept", "log_odds"]])


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.removed(docs, ["doc_id"])


def op10_rnn_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rnn_lm.score(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_bestfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bestfit.pack(docs, byte_bpe(), ["doc_id"], with_ids=False)[0]


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audits(repair.damaged(read(spark, sf_dir, "conversations")))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents").select("text", "lang"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_topk": op2_topk,
    "op3_html_main": op3_html_main,
    "op4_packing": op4_packing,
    "op5_token_counts": op5_token_counts,
    "op6_secret_scan": op6_secret_scan,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_quality_rules": op8_quality_rules,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_rnn_lm": op10_rnn_lm,
    "op11_bestfit": op11_bestfit,
    "op12_repair": op12_repair,
    "op13_collocations": op13_collocations,
}

ORACLE = {
    "op1_mixing": OP1_SQL,
    "op2_topk": OP2_SQL,
    "op6_secret_scan": OP6_SQL,
    "op12_repair": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
