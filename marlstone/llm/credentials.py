"""Secrets in texts: fixed patterns, and weak candidates confirmed by their complements.

A credential often has parts: an access identifier, a secret and an endpoint.
Identifiers, secret-like strings and addresses that would be too weak alone are
reported when complementary parts stand in the same scope, a stretch of text
around the candidate.  Parts and scopes are cut into bins of text and joined on
document and bin; matches of one kind do not overlap, so a bin holds few of
them however many a document or the corpus has.

Everything is built from SQL functions.  The texts are read once: what the
patterns find is written as arrays of lengths, and the rest works on those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import broadcast_if_small, row_key, written

#: Kinds in order, each with its pattern, the group that is measured and its least length.
BASE = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"(AKIA[A-Z0-9]+)", 1, 20),
    ("hex", r"((?<![0-9a-f])[0-9a-f]{24,})", 1, 24),
]
#: Weak kinds: other key identifiers, long mixed strings, and addresses.
WEAK = [
    ("weak_id", r"((?<![A-Za-z0-9])(?:(?:ASIA|AIDA|AROA|AGPA)[A-Z0-9]{12,}|(?i:(?:client|account|user)_?id)\x20?[:=]\x20?[A-Za-z0-9_.-]{4,}))", 1, 8),
    ("weak_secret", r"((?<![A-Za-z0-9+/])(?=[A-Za-z+/]*+[0-9])[A-Za-z0-9+/]{32,}={0,2})", 1, 32),
    ("endpoint", r"""(https?://[^\s"'<>]{4,}|(?<![A-Za-z0-9])(?i:endpoint|host)\x20?[:=]\x20?[A-Za-z0-9.:/_-]{4,})""", 1, 8),
]
ROLES = {"access": "id", "weak_id": "id", "assign": "secret", "hex": "secret", "weak_secret": "secret", "endpoint": "endpoint"}
NEEDS = {"weak_id": ["secret"], "weak_secret": ["id"], "endpoint": ["id", "secret"]}

#: What a text must hold for a pattern to match: one of some words (capitals as they are, else in either case) or a run.
WORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("AKIA",),
    "weak_id": ("ASIA", "AIDA", "AROA", "AGPA", "client", "account", "user"),
    "endpoint": ("://", "endpoint", "host"),
}
RUNS = {"hex": "[0-9a-f]{24}", "weak_secret": "[A-Za-z0-9+/]{32}"}

KINDS = [k for k, *_ in BASE + WEAK]
REACH = 200  # code points that a scope extends to either side of its candidate
BIN = 512


def _lengths(texts: Column) -> Column:
    return F.transform(texts, lambda t: F.char_length(t))


def _long_enough(texts: Column, least: int) -> Column:
    return F.transform(texts, lambda t: F.char_length(t) >= least)


def _of_kind(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _may_match(kind: str, text: Column, low: Column) -> Column:
    """Cheap test that holds for every text in which the pattern of ``kind`` matches."""
    if kind in RUNS:
        return text.rlike(RUNS[kind])
    may = F.lit(False)
    for word in WORDS[kind]:
        may |= (text if word.isupper() else low).contains(word)
    return may


def find(docs: DataFrame) -> DataFrame:
    """One row for every document, without its text: key columns, doc_id, row and what each pattern matched."""
    text, low = F.coalesce("text", F.lit("")), F.col("lower_text")
    found = [
        F.when(
            _may_match(kind, text, low) & text.rlike(pattern),
            F.struct(
                _lengths(F.split(text, pattern, -1)).alias("gaps"),
                _lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("sizes"),
                _long_enough(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), least).alias("holds"),
            ),
        ).alias(kind)
        for kind, pattern, group, least in BASE + WEAK
    ]
    docs = docs.select("doc_id", "text", F.lower("text").alias("lower_text"))
    return docs.select(*row_key(), "doc_id", F.monotonically_increasing_id().alias("row"), *found)


def spans(found: DataFrame) -> DataFrame:
    """Matches, base and weak, as row, kind, rank, start, end (code points)."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(i).alias("rank"), F.col(k).alias("m")) for i, k in enumerate(KINDS)])
    each = (
        found.select("row", F.explode(kinds).alias("k"))
        .filter(F.size("k.m.sizes") > 0)
        .select("row", "k.kind", "k.rank", F.posexplode(F.arrays_zip("k.m.gaps", "k.m.sizes", "k.m.holds")).alias("n", "m"))
        .filter(F.col("m.sizes").isNotNull())
    )
    before = Window.partitionBy("row", "kind").orderBy("n")
    to = F.sum(F.col("m.gaps") + F.col("m.sizes")).over(before)
    return (
        each.withColumn("end", to)
        .withColumn("start", F.col("end") - F.col("m.sizes"))
        .filter("m.holds")
        .select("row", "kind", "rank", "start", "end")
    )


def uncovered(found_spans: DataFrame) -> DataFrame:
    """Spans without the weak ones that lie wholly inside a base span."""
    # Base spans are met in order of their starts, so the furthest end before tells.
    before = Window.partitionBy("row").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("rank") < len(BASE)
    reach = F.max(F.when(base, F.col("end"))).over(before)
    return found_spans.withColumn("reach", reach).filter(base | (F.coalesce("reach", F.lit(-1)) < F.col("end"))).drop("reach")


def linked(found_spans: DataFrame) -> DataFrame:
    """Base spans, and weak ones in whose scope every complementary part occurs.

    Parts take their roles whether or not they overlap others, but a weak identifier or secret is not confirmed by what
    overlaps it; an address may hold its complements.
    """
    role = F.element_at(F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv]), F.col("kind"))
    parts = found_spans.withColumn("role", role)

    def bins(start: Column, end: Column) -> Column:
        return F.explode(F.sequence(F.floor(start / BIN), F.floor((end - 1) / BIN)))

    scopes = parts.filter(F.col("rank") >= len(BASE)).select(
        "*", (F.col("start") - REACH).alias("scope_start"), (F.col("end") + REACH).alias("scope_end")
    )
    scopes = scopes.withColumn("bin", bins(F.col("scope_start"), F.col("scope_end")))
    near = parts.select(
        F.col("row").alias("other_row"), F.col("role").alias("other_role"), F.col("start").alias("other_start"), F.col("end").alias("other_end")
    ).withColumn("other_bin", bins(F.col("other_start"), F.col("other_end")))
    meets = (
        (F.col("row") == F.col("other_row"))
        & (F.col("bin") == F.col("other_bin"))
        & (F.col("other_start") < F.col("scope_end"))
        & (F.col("other_end") > F.col("scope_start"))
        & ((F.col("kind") == "endpoint") | (F.col("other_end") <= F.col("start")) | (F.col("other_start") >= F.col("end")))
    )
    has = {r: F.max(F.col("other_role") == r).alias(f"has_{r}") for r in ("id", "secret")}
    needed = F.lit(False)
    for kind, roles in NEEDS.items():
        for_kind = F.col("kind") == kind
        for r in roles:
            for_kind &= F.col(f"has_{r}")
        needed |= for_kind
    columns = ["row", "kind", "rank", "start", "end"]
    confirmed = scopes.join(near, meets).groupBy(*columns).agg(*has.values()).filter(needed).select(*columns)
    return found_spans.filter(F.col("rank") < len(BASE)).select(*columns).unionByName(confirmed)


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan(docs: DataFrame) -> DataFrame:
    """All secrets of every whole text.

    Returns one row for every input row: doc_id, n_assign, n_access, n_hex, base_sha256 and spans, where a span is
    kind:start:end and spans stand in order of start, then kind; a weak span wholly inside a base one is not listed.  A null or empty text has no spans and the digest of
    the empty string.  Null or repeated doc_ids are kept apart by row; further columns are not read; an empty table
    gives no rows.
    """
    found = written(find(docs), "secrets-found")
    all_spans = written(uncovered(linked(spans(found))), "secrets-spans")
    listed = all_spans.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "rank", "end", "kind"))).alias("spans")
    )
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    none = F.coalesce("spans", F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>"))
    return (
        found.select("doc_id", "row")
        .join(listed, "row", "left")
        .withColumn("spans", none)
        .select(
            "doc_id",
            *[F.size(_of_kind("spans", k)).cast("bigint").alias(f"n_{k}") for k, *_ in BASE],
            F.sha2(_listed(base), 256).alias("base_sha256"),
            _listed(F.col("spans")).alias("spans"),
        )
    )


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """Documents with every span, joined where spans overlap, replaced by ``mark``; n_chars follows the new text."""
    found = written(find(docs), "secrets-found")
    inside = Window.partitionBy("row").orderBy("start", "end")
    reach = F.max("end").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    merged = (
        linked(spans(found))
        .withColumn("fresh", (F.col("start") >= F.coalesce(reach, F.lit(-1))).cast("int"))
        .withColumn("part", F.sum("fresh").over(inside))
        .groupBy("row", "part")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    )
    keys = ["key_id", "key_hash"]
    cuts = written(found.select("row", *keys).join(merged, "row").dropDuplicates(keys).drop("row"), "secrets-cuts")
    first, last = F.lit(0).cast("bigint"), F.char_length("text").cast("bigint")
    starts = F.concat(F.array(first), F.transform("cuts", lambda c: c["end"]))
    ends = F.concat(F.transform("cuts", lambda c: c["start"]), F.array(last))
    kept = F.zip_with(starts, ends, lambda a, b: F.substring(F.col("text"), (a + 1).cast("int"), (b - a).cast("int")))
    text = F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.array_join(kept, mark))
    out = docs.withColumns(dict(zip(keys, row_key(), strict=True))).join(broadcast_if_small(cuts), keys, "left")
    changed = {"text": text}
    if "n_chars" in docs.columns:
        gained = F.aggregate("cuts", F.lit(0).cast("bigint"), lambda n, c: n + len(mark) - (c["end"] - c["start"]))
        changed["n_chars"] = (F.char_length("text") + F.coalesce(gained, F.lit(0))).cast(docs.schema["n_chars"].dataType)
    return out.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])
