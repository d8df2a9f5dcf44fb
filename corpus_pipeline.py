"""From raw documents to token files: five stages, each over all that the one before kept.

Every stage but the last returns the columns of its input, whatever they are called, and takes
null ids, null and empty texts, repeated rows and empty tables; what each makes of them is said
beside it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from titlelens.llm import decontaminate, mixing, ngram_join, tokenbinary, toxicity
from titlelens.llm.common import stored
from titlelens.llm.queries import byte_bpe
from titlelens.plans.scratch import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go.

    Null and empty texts have no tokens, so the rate of toxic labels alone judges them; equal
    texts are judged alike; without usable labels nothing is rejected.
    """
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one of least id stays.

    Texts without words all stay; of equal texts one row stays, be the ids equal, null or not;
    unlike texts stay even if they share an id.
    """
    return ngram_join.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go.

    Texts without words stay, as all do if no item has words; rows are judged by their own text.
    """
    return decontaminate.drop_contaminated(
        docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks.

    A null source is a source; wordless documents are taken as the others of their source are,
    never more often than the cap; rows of equal id are taken alike.
    """
    return mixing.mix(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all texts in files, and what the files read back say of each document.

    A null text is an empty one, that is the end id alone; null ids come first; each repeated row
    is encoded; no documents give no files' rows.
    """
    path = scratch_path(spark, "corpus-tokens")
    # The workers have run the stages before and keep what those left in memory.
    tokenbinary.write_tokens(docs, path, byte_bpe(), memo_bytes=40 << 20)
    return tokenbinary.read_tokens(spark, path)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("decontaminate", drop_benchmark_leaks),
    ("mix_sources", mix_sources),
    ("token_binary", write_token_ids),
]

# Fitted models and token ids are beyond SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
