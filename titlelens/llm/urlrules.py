"""URL filter: given host and path rules, and association rules mined from the URLs they judge.

URLs that a given rule judges are the labelled ones.  Their tokens (scheme, labels and suffixes
of the host, path segments, file ending, query keys, fragment) and the verdict make a
transaction; frequent combinations that imply a verdict with enough confidence become rules.  A
rule that a part of it already implies as surely is pruned.  Rules are indexed by their rarest
token; URLs with the same tokens of interest are matched once, and the surest rule wins.

FP-growth lists every combination of items that are frequent together, so tokens that stand in
exactly the same labelled URLs, as the parts of one template do, are put together as one item
first: any of them stands for all, and 20 query keys of a template are one item instead of a
million combinations.  Rules have any length.

What is sent along is bounded by the support: a token of a rule is in at least `min_support` of
the labelled URLs, which have a bounded number of frequent tokens on average.

Edge cases: null, or without `://`: host and path are empty, there are no tokens and the verdict
is the default; no labelled URLs give no mined rules; repeated rows are judged alike; an empty
table gives no rows.  Further columns are not looked at.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlelens.functions.hints import broadcast_if_small
from titlelens.llm.common import LOWER, UPPER, stored

# The rules given, (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))
DEFAULT = "allow"
MIN_SUPPORT, MIN_CONFIDENCE = 0.01, 0.8


def _rest(url: Column) -> Column:
    """What follows the first `://`; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def given_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct of its text and verdict; null if none does."""
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    return F.coalesce(*[
        F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p),
               F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")))
        for verdict, h, p in longest])


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens, each with the part of the URL it is from."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    n = F.size(labels)
    # Suffixes of one and two labels, and the labels in front of them.
    suffixes = F.filter(F.array(F.element_at(labels, -1), F.concat_ws(
        ".", F.try_element_at(labels, F.lit(-2)), F.element_at(labels, -1))), lambda x: x != "")
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.split(x, "=")[0]),
                    lambda x: x != "")
    named = lambda name, xs: F.transform(xs, lambda x: F.concat(F.lit(f"{name}:"), x))
    found = F.concat(
        named("scheme", F.array(F.regexp_extract(url, r"^([^:]*)://", 1))),
        named("suffix", F.when(n > 0, suffixes).otherwise(F.array().cast("array<string>"))),
        named("label", F.slice(labels, 1, F.greatest(n - 2, F.lit(0)))),
        named("path", segments),
        named("ending", F.filter(F.array(F.regexp_extract(path, r"\.([^./]+)$", 1)),
                                 lambda x: x != "")),
        named("key", keys),
        named("fragment", F.filter(F.array(F.regexp_extract(url, r"#(.*)$", 1)),
                                   lambda x: x != "")))
    return F.when(F.instr(url, "://") > 0, F.array_distinct(found)).otherwise(
        F.array().cast("array<string>"))


def alike(labelled: DataFrame, min_support: float = MIN_SUPPORT) -> dict[str, str]:
    """Each frequent token and the least one that stands in exactly the same rows.

    Rows are told apart by their content, as sums of two hashes over the rows of a token.
    """
    row = [F.xxhash64(F.lit(i), F.array_join(F.array_sort("tokens"), "\n"), "verdict")
           .cast("decimal(20,0)").alias(f"h{i}") for i in range(2)]
    spread = labelled.select(*row, F.explode(F.array_distinct("tokens")).alias("token"))
    least = labelled.count() * min_support
    frequent = spread.groupBy("token").agg(
        F.count("*").alias("n"), F.sum("h0").alias("s0"), F.sum("h1").alias("s1")).filter(
        F.col("n") >= least)
    # Bounded by the support.
    first: dict[tuple, str] = {}
    rows = sorted(map(tuple, frequent.select("token", "n", "s0", "s1").collect()))
    return {token: first.setdefault(tuple(told), token) for token, *told in rows}


def items_of(tokens: Column, items: dict[str, str]) -> Column:
    """The items that the tokens stand for; tokens that are not frequent are left out."""
    if not items:
        return F.array().cast("array<string>")
    known = F.create_map(*[F.lit(x) for pair in items.items() for x in pair])
    return F.array_sort(F.array_distinct(F.filter(F.transform(
        tokens, lambda t: F.try_element_at(known, t)), lambda x: x.isNotNull())))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT,
         min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """rule_id, items, verdict, confidence, support from rows (tokens, verdict), where no two
    tokens stand in the same rows throughout (see `alike`); stored."""
    spark = labelled.sparkSession
    ddl = "rule_id string, items array<string>, verdict string, confidence double, support double"
    if labelled.isEmpty():
        return spark.createDataFrame([], ddl)
    baskets = labelled.select(F.concat("tokens", F.array(
        F.concat(F.lit("verdict:"), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support,
                     minConfidence=min_confidence).fit(baskets)
    implied = stored(model.associationRules.filter(
        F.col("consequent")[0].startswith("verdict:")
        & ~F.exists("antecedent", lambda x: x.startswith("verdict:"))).select(
        F.array_sort("antecedent").alias("items"),
        F.substring(F.col("consequent")[0], len("verdict:") + 1, 1 << 20).alias("verdict"),
        "confidence", "support").withColumn("rule_id", F.concat_ws(" ", "items")), "url-rules")
    # A part of a rule holds its own rarest token, which the rule has too.
    parts = _index(implied).select(
        F.col("items").alias("part"), "verdict", "token", F.col("confidence").alias("already"))
    told = (implied.select("items", "verdict", "confidence", F.explode("items").alias("token"))
            .join(parts, ["token", "verdict"])
            .filter((F.col("already") >= F.col("confidence"))
                    & (F.size("part") < F.size("items"))
                    & (F.size(F.array_except("part", "items")) == 0))
            .select("items", "verdict").distinct())
    kept = implied.join(told, ["items", "verdict"], "left_anti")
    return stored(kept.select("rule_id", "items", "verdict", "confidence", "support"),
                  "url-rules")


def _index(rules: DataFrame) -> DataFrame:
    """Each rule under the token that the fewest rules have."""
    spread = rules.select("*", F.explode("items").alias("token"))
    common = spread.groupBy("token").agg(F.count("*").alias("rules"))
    return (spread.join(common, "token").groupBy("rule_id", "verdict")
            .agg(F.min(F.struct("rules", "token"))["token"].alias("token"),
                 F.first("items").alias("items"), F.max("confidence").alias("confidence"),
                 F.max("support").alias("support")))


def judge(pages: DataFrame, rules=RULES, default: str = DEFAULT,
          min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict, mined: the last is the mined rule that decided."""
    parsed = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"),
                          host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rows = parsed.select("page_id", "host", "path",
                         given_rule(F.col("host"), F.col("path"), rules).alias("given"),
                         tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"))
    labelled = rows.filter("given is not null").select(
        "tokens", F.col("given.verdict").alias("verdict"))
    items = alike(labelled, min_support)
    mined = mine(labelled.select(items_of(F.col("tokens"), items).alias("tokens"), "verdict"),
                 min_support, min_confidence)
    # Bounded by the support; one row per distinct item of a rule.
    used = {r[0] for r in mined.select(F.explode("items")).distinct().collect()}
    seen = items_of(F.col("tokens"), {t: i for t, i in items.items() if i in used})
    rows = rows.select("page_id", "host", "path", "given",
                       F.when(F.col("given").isNull(), F.concat_ws("\n", seen)).alias("seen"))
    kinds = stored(rows.filter("seen is not null").select("seen").distinct(), "url-kinds")
    index = broadcast_if_small(_index(mined), mined.count())
    by_token = kinds.select("seen", F.split("seen", "\n").alias("have")).select(
        "seen", "have", F.explode("have").alias("token"))
    surest = F.max(F.struct(
        "confidence", "support", (-F.size("items")).alias("short"), "rule_id", "verdict"))
    decided = (by_token.join(index, "token")
               .filter(F.size(F.array_except("items", "have")) == 0)
               .groupBy("seen").agg(surest.alias("best"))
               .select(F.col("seen").alias("kind"), F.col("best.rule_id").alias("mined"),
                       F.col("best.verdict").alias("implied")))
    decided = broadcast_if_small(decided, kinds.count())
    return rows.join(decided, F.col("seen") == F.col("kind"), "left").select(
        "page_id", "host", "path", F.col("given.rule").alias("rule"),
        F.coalesce("given.verdict", "implied", F.lit(default)).alias("verdict"), "mined")
