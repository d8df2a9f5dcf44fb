"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Sources are ranked by code point, null last, and weighted in turn.  A source may be repeated up
to `max_epochs` times; what it cannot take is shared among the others by weight until no target
is above its cap.  A document is repeated a whole number of times, as its source's target asks,
and once more if its seeded key is under the source's cut: the key up to which the documents
fill what the whole repetitions leave open, as near as whole documents can.

Edge cases: a null text has size 0; a null source is a source of its own, ranked last; sources
without words get target 0 and give no rows; rows that share a `doc_id` share the key, so they
are repeated alike; an empty table gives an empty one.  Further columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlelens.functions.hints import broadcast_if_small
from titlelens.llm.common import SPACED_WORD, stored

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
KEY_BITS, COARSE_BITS = 60, 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("bigint")


def order_key(doc_id: Column, seed: str = SEED) -> Column:
    """A number of 60 bits that looks random and is the same in every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("bigint")


def sizes(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """One narrow row per document; the texts are read once and left behind."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                       order_key(F.col("doc_id"), seed).alias("key"))


def targets(narrow: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target.  The windows without partition see one row per source."""
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # Those that reach their cap first come first.
    rising = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
              .withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn))
              .withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
              .withColumn("fill", F.col("cap") / F.col("weight"))
              .withColumn("left_words", F.sum(F.col("source_size").cast("double")).over(every)
                          - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              .withColumn("left_weight", F.sum("weight").over(every)
                          - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .withColumn("level", F.col("left_words") / F.col("left_weight")))
    # The first source that holds its share sets the level for itself and all after it.
    first = F.min(F.when(F.col("fill") >= F.col("level"), F.struct(
        "fill", F.col("source").isNull().alias("none"), "source", "level"))).over(every)["level"]
    return ranked.select("source", "source_size", F.least(
        F.col("cap"), F.col("weight") * first).alias("target"))


def _cuts(narrow: DataFrame, goals: DataFrame) -> DataFrame:
    """source, source_size, target, whole, cut.

    Documents are taken by rising key until the part of a repetition is full.  The key's leading
    bits are counted first, so that only one of 4096 parts of a source is put in order.
    """
    goals = goals.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(
        F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
    goals = goals.withColumn(
        "quota", F.col("target") - F.col("whole") * F.col("source_size").cast("double"))
    part = F.shiftright("key", KEY_BITS - COARSE_BITS).cast("int")
    rows = narrow.withColumn("part", part)
    by_part = Window.partitionBy("source").orderBy("part")
    parts = (rows.groupBy("source", "part").agg(F.sum("size").alias("words"))
             .withColumn("upto", F.sum("words").over(by_part)))
    marked = parts.join(goals.select(F.col("source").alias("s"), "quota"),
                        F.col("source").eqNullSafe(F.col("s"))).drop("s")
    edge = (marked.filter(F.col("upto") > F.col("quota")).groupBy("source")
            .agg(F.min(F.struct("part", (F.col("upto") - F.col("words")).alias("base"), "quota"))
                 .alias("e"))
            .select(F.col("source").alias("s"), "e.*").withColumnRenamed("part", "p"))
    by_key = Window.partitionBy("source").orderBy("key")
    inside = (rows.join(edge, F.col("source").eqNullSafe(F.col("s"))
                        & (F.col("part") == F.col("p")))
              .groupBy("source", "key", "base", "quota", "p").agg(F.sum("size").alias("size"))
              .withColumn("upto", F.col("base") + F.sum("size").over(by_key)))
    none = (F.col("p").cast("bigint") * F.lit(1 << (KEY_BITS - COARSE_BITS)) - 1)
    best = (inside.groupBy("source").agg(
        F.min(F.struct(F.abs(F.col("upto") - F.col("quota")).alias("off"), "key")).alias("at"),
        F.min(F.struct(F.abs(F.col("base") - F.col("quota")).alias("off"), none.alias("key")))
        .alias("start"))
        .select(F.col("source").alias("s"), F.least("at", "start")["key"].alias("cut")))
    return (goals.join(best, goals["source"].eqNullSafe(best["s"]), "left").drop("s")
            # With nothing left to fill, no document is taken once more, wordless ones neither.
            .withColumn("cut", F.coalesce(F.when(F.col("quota") > 0, F.col("cut")), F.lit(-1))))


def plan_mix(narrow: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target, whole, cut; stored, one row per source."""
    return stored(_cuts(narrow, targets(narrow, weights, max_epochs)), "mix-plan")


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    few = broadcast_if_small(plan.withColumnRenamed("source", "plan_source"), plan.count())
    return rows.join(few, rows["source"].eqNullSafe(few["plan_source"])).drop("plan_source")


def _copies() -> Column:
    return F.col("whole") + (F.col("key") <= F.col("cut")).cast("int")


def mix_report(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS,
               seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies: what the mix takes of each document."""
    narrow = stored(sizes(docs, seed), "mix-sizes")
    return _with_plan(narrow, plan_mix(narrow, weights, max_epochs)).select(
        "doc_id", "size", "source_size", "target",
        (_copies() * F.col("size")).cast("bigint").alias("taken"), _copies().alias("copies"))


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it, with the columns of `docs`."""
    narrow = stored(sizes(docs, seed), "mix-sizes")
    plan = plan_mix(narrow, weights, max_epochs)
    few = broadcast_if_small(plan.select(plan["source"].alias("plan_source"), "whole", "cut"),
                             plan.count())
    copies = few["whole"] + (order_key(docs["doc_id"], seed) <= few["cut"]).cast("int")
    # The columns in one struct, so that no name of theirs can clash with one added here.
    mixed = docs.join(few, docs["source"].eqNullSafe(few["plan_source"])).select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"))
    return mixed.select("row.*")
