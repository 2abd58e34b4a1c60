"""Secret scans: corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found in whole texts by regular expressions; their places follow
from the lengths of what lies between them. Each candidate's value is hashed
and counted over distinct owners, texts and repositories in the whole corpus. A
value is a copied example if several owners hold it in different texts, or if it
lies in more than ``MAX_REPOSITORIES`` repositories; a text that was copied is one
place, that of its least repository, for a copy of a document tells nothing about
the value in it. A long mixed token that is no copied example is a live-looking
credential and is added to the base findings. Base findings always stay.

Defined cases: null or empty text has no findings; a null owner or repository
counts as one; repeated rows share text and place and so raise no count;
ties are ordered by start, kind and end; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rxlake.llm.store import free_name, keep


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _either_case("api") + "_?" + _either_case("key")
ASSIGN = rf"""(?:{_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind, pattern, group with the value, least characters of the value
BASE = [
    ("assign", ASSIGN, 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]
#: The method's own candidates: long tokens of letters and digits.
MIXED = ("mixed", r"[A-Za-z0-9_-]{20,}", 0, 20)
KINDS = [k for k, *_ in BASE] + ["mixed"]
#: A value that more owners hold, in different texts, is a copied example; so is one
#: in more repositories.
MAX_OWNERS, MAX_REPOSITORIES = 1, 3


def _found(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Array of (kind, gap before, length, value) of all matches, in order.
    Short hex runs are cut off early: a run that fails matches nothing else."""
    fast = pattern.replace("+", f"{{{least},}}") if kind == "hex" else pattern
    gaps = F.split(text, fast, -1)
    whole, value = F.regexp_extract_all(text, F.lit(fast), F.lit(0)), F.regexp_extract_all(text, F.lit(fast), F.lit(group))
    rows = F.arrays_zip(whole.alias("w"), value.alias("v"), F.slice(gaps, F.lit(1), F.size(whole)).alias("g"))
    each = F.transform(rows, lambda x: F.struct(F.lit(KINDS.index(kind)).alias("kind"), F.length(x["g"]).alias("gap"), F.length(x["w"]).alias("len"), x["v"].alias("value")))
    none = F.array().cast("array<struct<kind:int,gap:int,len:int,value:string>>")
    return F.when(text.rlike(fast), each).otherwise(none)


def candidates(docs: DataFrame, owner: str, repository: list[str], columns: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """The kept rows with a row number, and one row a candidate: row number,
    kind, start, end, value hash, owner, repository, digest of the text. Third: added
    names."""
    rid, found = free_name(docs, "_rid", "_found")
    own = F.coalesce(F.col(owner).cast("string"), F.lit(""))
    repo = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in repository])
    text = F.coalesce(F.col("text"), F.lit(""))
    found_all = F.concat(*[_found(text, *k) for k in [*BASE, MIXED]])
    rows = docs.select(*columns, F.monotonically_increasing_id().alias(rid), F.struct(own.alias("owner"), repo.alias("repo"), F.md5(text).alias("digest"), found_all.alias("all")).alias(found))
    rows = keep(rows, "found")
    each = rows.where(F.size(f"{found}.all") > 0).select(F.col(rid).alias("rid"), F.col(f"{found}.owner").alias("owner"), F.col(f"{found}.repo").alias("repo"), F.col(f"{found}.digest").alias("digest"), F.posexplode(f"{found}.all").alias("i", "c"))
    before = Window.partitionBy("rid", "c.kind").orderBy("i")
    stop = F.sum(F.col("c.gap") + F.col("c.len")).over(before)
    each = each.select("rid", "owner", "repo", "digest", F.col("c.kind").alias("kind"), (stop - F.col("c.len")).alias("start"), stop.alias("end"), F.col("c.value").alias("value"))
    least = F.element_at(F.array(*[F.lit(k[3]) for k in [*BASE, MIXED]]), F.col("kind") + 1)
    both = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    each = each.where((F.length("value") >= least) & ((F.col("kind") < len(BASE)) | both))
    return rows, keep(each.withColumn("value", F.sha2("value", 256)), "candidates"), [rid, found]


def findings(docs: DataFrame, columns: list[str], *, owner: str = "source", repository: list[str] | None = None, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES, out: str = "secrets") -> DataFrame:
    """``columns`` of each row and the struct ``out``: n_assign, n_access, n_hex,
    n_live (spans that are no copied examples), base and spans: arrays of
    (start, kind, end), kind by place in ``KINDS``, in that order."""
    rows, each, (rid, found) = candidates(docs, owner, repository or [owner, "lang"], columns)
    # Distinct places of each value first: a value that a hot source repeats
    # shrinks before it meets others.
    places = each.groupBy("value", "digest", "owner", "repo").count()
    texts = places.groupBy("value", "digest").agg(F.min("repo").alias("place")).groupBy("value").agg(F.count("*").alias("texts"), F.countDistinct("place").alias("places"))
    held = places.groupBy("value").agg(F.countDistinct("owner").alias("owners")).join(texts, "value")
    copied = ((F.col("owners") > max_owners) & (F.col("texts") > 1)) | (F.col("places") > max_repositories)
    judged = each.join(held, "value").withColumn("live", ~copied)
    judged = judged.where((F.col("kind") < len(BASE)) | F.col("live"))
    is_base = F.col("kind") < len(BASE)
    span = F.struct(F.col("start"), F.col("kind"), F.col("end"))
    by_row = judged.groupBy("rid").agg(
        *[F.count_if(F.col("kind") == i).alias(f"n_{k}") for i, (k, *_) in enumerate(BASE)],
        F.count_if("live").alias("n_live"),
        F.array_sort(F.collect_list(F.when(is_base, span))).alias("base"),
        F.array_sort(F.collect_list(span)).alias("spans"),
    )
    by_row = by_row.select("rid", F.struct(*[c for c in by_row.columns if c != "rid"]).alias(out))
    joined = rows.join(by_row, rows[rid] == by_row["rid"], "left")
    names = ["n_assign", "n_access", "n_hex", "n_live"]
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    whole = F.struct(*[F.coalesce(F.col(f"{out}.{c}"), F.lit(0)).cast("long").alias(c) for c in names], *[F.coalesce(F.col(f"{out}.{c}"), empty).alias(c) for c in ("base", "spans")])
    return joined.select(*[rows[c] for c in columns if c != out], whole.alias(out))


def as_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def redact(docs: DataFrame, mask: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with each found span replaced by ``mask`` (overlapping spans by
    one), and n_chars, if there, brought up to date."""
    (out,) = free_name(docs, "_secrets")
    found = findings(docs, docs.columns, out=out, **options)
    spans = F.col(f"{out}.spans")
    # Spans in order: the gap before each, then the mark; a span that begins
    # inside the one before adds nothing of its own.
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(acc["parts"], F.array(gap, F.lit(mask)))).otherwise(acc["parts"]).alias("parts"))

    clean = F.aggregate(spans, start, step, lambda acc: F.concat(F.concat_ws("", acc["parts"]), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    text_now = F.when(F.size(spans) > 0, clean).otherwise(text)
    done = found.withColumn("text", text_now)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return done.select(*docs.columns)
