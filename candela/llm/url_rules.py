"""URL filtering by given rules and by mined association rules.

Urls that a given rule judges are the labelled ones. FP-growth mines combinations of url tokens that
go with a verdict; rules with too little confidence or support, and rules that a shorter one already
makes as surely, are dropped. The rest judge the other urls, found by an inverted index from tokens
to rules. A url's tokens are cut to those that rules use, so equal token sets are matched once.

Tokens that stand in the very same labelled urls are one item to the miner, as it would list every combination of
them; any of them stands for the item when urls are judged, as each alone would make a rule just as sure.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.session import materialize

SUPPORT, CONFIDENCE = 0.01, 0.8
#: Urls a rule must hold for, at least.
LEAST = 20
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[Column, Column]:
    rest = F.expr(f"if(instr({url}, '://') > 0, substring({url}, instr({url}, '://') + 3), '')")
    raw = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"\A[^?#]*", 0)
    return F.coalesce(F.translate(raw, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def given_rule(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest (verdict, host, path) that fits the columns host and path; null if none."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for judged, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        rule = F.when(fits, host + path).otherwise(rule)
        verdict = F.when(fits, judged).otherwise(verdict)
    return rule, verdict


def url_tokens() -> Column:
    """Distinct tokens of the columns url, host and path: words of the host, its last label, parts of
    the path and names of parameters; digits are one token."""
    mark = lambda name, values: F.transform(values, lambda x: F.concat(F.lit(name + "="), x))
    top = F.substring_index("host", ".", -1)
    words = F.split(F.expr("substring(host, 1, length(host) - length(substring_index(host, '.', -1)))"), r"[.\-]")
    plain = F.transform(F.split("path", "/"), lambda x: F.regexp_replace(F.lower(x), r"[0-9]+", "0"))
    keys = F.regexp_extract_all("url", F.lit(r"[?&]([^=&#]+)="), F.lit(1))
    marked = F.concat(mark("word", words), mark("top", F.array(top)), mark("path", plain), mark("key", keys))
    return F.array_distinct(F.filter(marked, lambda x: ~F.endswith(x, F.lit("="))))


def _items(tokens: str, item_of: dict[str, str]) -> Column:
    """The distinct items of a row's tokens; tokens without one are left out."""
    if not item_of:
        return F.array().cast("array<string>")
    known = F.map_from_arrays(F.lit(list(item_of)), F.lit(list(item_of.values())))
    return F.array_distinct(F.transform(F.array_intersect(tokens, F.lit(list(item_of))), lambda x: known[x]))


def mined_rules(labelled: DataFrame, support: float, confidence: float) -> tuple[DataFrame, dict[str, str]]:
    """(rule_id, tokens, verdict, confidence, support) mined from rows (tokens, verdict), and the item of each token in use."""
    n = labelled.count()
    support = min(1.0, max(support, LEAST / n))
    rows = labelled.select("tokens", F.xxhash64(F.monotonically_increasing_id()).alias("row"))
    held = (F.count("*").alias("n"), F.bit_xor("row").alias("x"), F.sum(F.col("row") % (1 << 40)).alias("y"))
    counts = rows.select("row", F.explode("tokens").alias("token")).groupBy("token").agg(*held)
    # A token in every url tells nothing; rare ones are in no rule. Fewer are left than a url's tokens / support.
    used = counts.where((F.col("n") < n) & (F.col("n") >= support * n)).orderBy("token").collect()
    first: dict[tuple, str] = {}
    item_of = {r.token: first.setdefault((r.n, r.x, r.y), r.token) for r in used}
    cut = _items("tokens", item_of)
    baskets = labelled.select(F.concat(cut, F.array(F.concat(F.lit("verdict="), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    found = (
        model.associationRules.where(F.startswith(F.col("consequent")[0], F.lit("verdict=")))
        .select(F.array_sort("antecedent").alias("tokens"), F.substring_index(F.col("consequent")[0], "=", -1).alias("verdict"), "confidence", "support")
        .withColumn("rule_id", F.xxhash64(F.concat_ws("\n", "tokens"), "verdict"))
    )
    found = materialize(found, "url-rules")
    # A rule goes if one with a part of its tokens is as sure of the same verdict.
    parts = found.select("rule_id", "verdict", "confidence", F.size("tokens").alias("size"), F.explode("tokens").alias("token"))
    shorter = parts.toDF("short_id", "verdict", "short_confidence", "short_size", "token")
    matched = parts.join(shorter, ["token", "verdict"]).where("short_size < size and short_confidence >= confidence")
    needless = matched.groupBy("rule_id", "short_id").agg(F.count("*").alias("n"), F.first("short_size").alias("size")).where("n = size")
    return found.join(needless.select("rule_id").distinct(), "rule_id", "left_anti"), item_of


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """One row per page row: page_id, host, path, rule, verdict (allow or block).

    The longest given rule (verdict, host, path) that fits decides; then the surest mined rule, by
    confidence, support and length; a tie between verdicts and no rule at all allow. Null urls and
    urls without '://' have an empty host and path and are allowed unless a rule without a host is given. Repeated
    rows are judged alike; an empty table gives an empty result; other columns are ignored.
    """
    host, path = host_and_path("url")
    rule, verdict = given_rule(rules)
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path")).withColumn("rule", rule).withColumn("verdict", verdict)
    rows = materialize(rows.withColumn("tokens", F.when(F.col("host") != "", url_tokens()).otherwise(F.array().cast("array<string>"))).drop("url"), "urls")
    labelled = rows.where("verdict is not null and size(tokens) > 0")
    if not labelled.head(1):
        return rows.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(DEFAULT)).alias("verdict"))
    mined, item_of = mined_rules(labelled, support, confidence)
    mined = materialize(mined, "url-rules")
    index = mined.select("rule_id", "verdict", "confidence", "support", F.size("tokens").alias("size"), F.explode("tokens").alias("token"))
    # Frequent tokens only: fewer than the tokens of a url divided by the support.
    used = {r.token for r in index.select("token").distinct().collect()}
    cut = _items("tokens", {token: item for token, item in item_of.items() if item in used})
    open_rows = rows.select("page_id", "host", "path", "rule", "verdict", F.concat_ws("\n", F.array_sort(cut)).alias("signature"))
    kinds = open_rows.where("verdict is null and signature <> ''").select("signature").distinct()
    best = (
        kinds.select("signature", F.explode(F.split("signature", "\n")).alias("token")).join(index, "token")
        .groupBy("signature", "rule_id", "verdict", "confidence", "support", "size").agg(F.count("*").alias("n")).where("n = size")
        .groupBy("signature").agg(F.min_by("verdict", F.struct(-F.col("confidence"), -F.col("support"), -F.col("size"), "verdict")).alias("mined"))
    )
    return open_rows.join(best, "signature", "left").select("page_id", "host", "path", "rule", F.coalesce("verdict", "mined", F.lit(DEFAULT)).alias("verdict"))
