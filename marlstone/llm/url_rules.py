"""URL filter: fixed rules first, then rules mined from the URLs that those decide.

Frequent combinations of URL tokens are mined with FP-growth over labelled URLs;
a combination that implies a verdict with enough support and confidence becomes
a rule, unless a part of it implies the same verdict as surely.  Rules match by
an inverted index: each is posted under its rarest token, so a URL meets a rule
only through that token, and the rest of the rule is then checked.

Tokens that stand in the same labelled URLs say the same, and any of them would
do in a rule.  They are mined and matched as one, so a URL that fills half of the
table with its many tokens does not give a rule for each combination of them.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import broadcast_if_small, written

#: Host and path of each rule, and its verdict.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LABELS = ("label=allow", "label=block")


def parts(pages: DataFrame) -> DataFrame:
    """page_id, url, host and path."""
    url = F.coalesce("url", F.lit(""))
    return pages.select(
        "page_id",
        "url",
        F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1).alias("path"),
    )


def rule_of(rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null if none does."""
    name = verdict = F.lit(None).cast("string")
    for host, path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        name, verdict = F.when(fits, host + path).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def tokens() -> Column:
    """Distinct tokens: labels of the host, words of the path, names in the query."""
    host = F.transform(F.split("host", r"[.\-:]+"), lambda t: F.concat(F.lit("host="), t))
    path = F.transform(F.split("path", r"[/._\-]+"), lambda t: F.concat(F.lit("path="), t))
    query = F.regexp_extract_all(F.coalesce("url", F.lit("")), F.lit(r"[?&]([A-Za-z_]+)="), F.lit(1))
    query = F.transform(query, lambda t: F.concat(F.lit("query="), t))
    found = F.filter(F.concat(host, path, query), lambda t: ~t.rlike("=[0-9]*$"))
    return F.array_sort(F.array_distinct(found))


def names(labelled: DataFrame, min_support: float) -> DataFrame:
    """token and name for the tokens (row, items) frequent enough for a rule: those of the same rows share a name.

    Rows are compared by their number and 128 bits of their hashes.  A row's tokens by the support bound the result.
    """
    total = labelled.agg(F.count("*").alias("total"))
    same = ["n", "low", "high"]
    each = labelled.select("row", F.explode("items").alias("token"))
    rows = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("row")).alias("low"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("high")]
    tokens = each.groupBy("token").agg(*rows).join(F.broadcast(total), F.col("n") >= F.ceil(F.col("total") * min_support))
    tokens = written(tokens.select("token", *same), "url-tokens")
    return tokens.join(tokens.groupBy(*same).agg(F.min("token").alias("name")), same).select("token", "name")


def mine(labelled: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    """Rules from labelled URLs (items, verdict): tokens, verdict, confidence, support, rarest token."""
    baskets = labelled.select(F.array_append("items", F.concat(F.lit("label="), F.col("verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.select(
        "antecedent", F.col("consequent")[0].alias("says"), "confidence", "support"
    ).filter(F.col("says").isin(*LABELS) & ~F.arrays_overlap("antecedent", F.array(*map(F.lit, LABELS))))
    rules = written(rules.withColumn("rule_id", F.monotonically_increasing_id()), "url-mined")
    # Pruning: a shorter rule with the same verdict that is as sure covers the longer one.
    short = rules.select(
        F.explode("antecedent").alias("token"),
        F.col("rule_id").alias("short_id"),
        F.col("antecedent").alias("short"),
        F.col("says").alias("short_says"),
        F.col("confidence").alias("short_confidence"),
    )
    covered = (
        rules.withColumn("token", F.explode("antecedent"))
        .join(short, "token")
        .filter(
            (F.col("rule_id") != F.col("short_id"))
            & (F.col("says") == F.col("short_says"))
            & (F.col("short_confidence") >= F.col("confidence"))
            & (F.size("short") < F.size("antecedent"))
            & (F.size(F.array_except("short", "antecedent")) == 0)
        )
        .select("rule_id")
        .distinct()
    )
    single = model.freqItemsets.filter(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    return (
        rules.join(covered, "rule_id", "left_anti")
        .withColumn("token", F.explode("antecedent"))
        .join(single, "token")
        .groupBy("rule_id", "antecedent", "says", "confidence", "support")
        .agg(F.min_by("token", F.struct("freq", "token")).alias("rarest"))
    )


def judge(
    pages: DataFrame,
    rules=RULES,
    *,
    min_support: float = 0.01,
    min_confidence: float = 0.8,
    default: str = "allow",
) -> DataFrame:
    """A verdict for every URL of ``pages`` (page_id, url).

    Returns page_id, host, path, rule, verdict and source (rule, mined or default).  The longest fitting rule decides;
    otherwise the surest mined rule, then the one with more support, then the longer one, then block; otherwise
    ``default``.  Null URLs and those without "://" have an empty host and path.  Every row is judged, also one whose
    page_id is null or repeated; no labelled URL or an empty table means no mined rule.
    """
    name, verdict = rule_of(rules)
    judged = written(
        parts(pages).select(
            "page_id", "host", "path", name.alias("rule"), verdict.alias("verdict"), tokens().alias("items")
        ).withColumn("row", F.monotonically_increasing_id()),
        "url-parts",
    )
    labelled = judged.filter(F.col("verdict").isNotNull() & (F.size("items") > 0))
    open_rows = judged.filter(F.col("verdict").isNull()).select("row", "items")
    mined = None
    if not labelled.isEmpty():
        known = broadcast_if_small(written(names(labelled, min_support), "url-names"))
        each = labelled.select("row", "verdict", F.explode("items").alias("token")).join(known, "token", "left")
        baskets = each.groupBy("row", "verdict").agg(F.collect_set("name").alias("items"))
        index = written(mine(baskets, min_support, min_confidence), "url-rules")
        best = F.max(
            F.struct("confidence", "support", F.size("antecedent").alias("n"), F.col("says").alias("says"))
        ).alias("best")
        # URLs with the same tokens share a verdict, so each set of tokens is matched once.
        sets = open_rows.select("items").distinct().withColumn("token", F.explode("items")).join(known, "token")
        sets = sets.groupBy("items").agg(F.collect_set("name").alias("names"))
        mined = (
            sets.withColumn("name", F.explode("names"))
            .join(broadcast_if_small(index), F.col("name") == F.col("rarest"))
            .filter(F.size(F.array_except("antecedent", "names")) == 0)
            .groupBy("items")
            .agg(best)
            .select("items", F.replace(F.col("best.says"), F.lit("label="), F.lit("")).alias("mined"))
        )
    out = judged.join(mined, "items", "left") if mined is not None else judged.withColumn("mined", F.lit(None).cast("string"))
    return out.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", "mined", F.lit(default)).alias("verdict"),
        F.when(F.col("verdict").isNotNull(), "rule").when(F.col("mined").isNotNull(), "mined").otherwise("default").alias("source"),
    )
