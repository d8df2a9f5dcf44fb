"""Every query with SQL against DuckDB, plan shapes, and the pipeline against plain Python."""

import os
import sys
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from titlelens.llm import mixing, toxicity
from titlelens.llm.oracle import ORACLE
from titlelens.llm.queries import QUERIES
from titlelens.llm.common import stored

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from test_decontaminate import plain as plain_contamination  # noqa: E402
from test_ngram_join import plain_components  # noqa: E402
from test_tokenbinary import plain as plain_ids  # noqa: E402

DATA = os.environ.get("TITLELENS_DATA", "/root/testdata/sf0.001")


def _sorted(rows):
    return sorted(map(tuple, rows), key=str)


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    assert set(ORACLE) <= set(QUERIES) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", ORACLE)
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    df = QUERIES[name](spark, DATA)
    wanted = con.execute(ORACLE[name])
    columns = [d[0] for d in wanted.description]
    assert sorted(df.columns) == sorted(columns)
    assert _sorted(df.select(*columns).collect()) == _sorted(wanted.fetchall())


@pytest.mark.parametrize("name", ["op4_decontaminate", "op7_url_filter", "op8_mix_sources"])
def test_native_plans_run_no_python(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct",
                                       "BroadcastNestedLoopJoin"))


def test_stages_equal_plain_python(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    items = [(r["item_id"], r["text"])
             for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    inputs, outputs = [], []
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(docs)
        docs = stored(stage(spark, docs, DATA), name)
        outputs.append(docs)
    for df in outputs[:-1]:
        assert df.columns == inputs[0].columns
    pairs = [[(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
             for df in inputs]
    ids = [sorted(i for i, _ in p) for p in pairs]

    chain = toxicity.fit(inputs[0], labels)
    assert ids[1] == sorted(i for i, t in pairs[0]
                            if chain.scores(t)[1] < toxicity.REJECT)
    kept = {c for _, n, c in plain_components(pairs[1]) if n}
    assert ids[2] == sorted(kept | {i for i, n, _ in plain_components(pairs[1]) if not n})
    assert ids[3] == sorted(r[0] for r in plain_contamination(pairs[2], items) if not r[5])
    assert len(ids[0]) > len(ids[1]) > len(ids[2]) > len(ids[3])
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_report(inputs[3]).collect()}
    assert ids[4] == sorted(i for i in copies for _ in range(copies[i]))
    at = 0
    for r, (i, t) in zip(outputs[4].orderBy("start").collect(), sorted(pairs[4]), strict=True):
        mine = np.array(plain_ids(t) + [2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (
            i, at, len(mine), zlib.crc32(mine.tobytes()))
        at += len(mine)


def test_stages_take_odd_rows(spark, tmp_path):
    """Nulls, repeated rows, wordless and very long texts, clashing columns; and no rows at all."""
    labels = spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(40)],
                                   "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "ten words that stand in one item of the benchmark here"),
                                   (None, None)], "item_id long, text string")
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choice(words, 40)), f"s{i % 3}") for i in range(40)]
    rows += [(None, None, None), (None, None, None), (None, "a null id", "s0"), (3, "", "s1"),
             (3, " \t", None), (50, "word " * 60_000, "s2"), rows[0], rows[0], (None, rows[1][1], "s0"),
             (60, "so ten words that stand in one item of the benchmark here.", "s1")]
    docs = spark.createDataFrame(
        [(*r, 1, 2, 3, 4, 5) for r in rows],
        "doc_id long, text string, source string, row int, copy int, one int, hits int, n_words int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    for start, least in ((docs, 1), (docs.limit(0), 0)):
        now = start
        for name, stage in corpus_pipeline.STAGES:
            out = stored(stage(spark, now, str(tmp_path)), name)
            if name != "token_binary":
                assert out.columns == docs.columns and out.count() >= least
            if name == "ngram_jaccard" and least:
                worded = [r["text"] for r in out.collect() if r["text"] and r["text"].strip()]
                assert len(worded) == len(set(worded))
                assert out.filter("text is null").count() == now.filter("text is null").count()
            if name == "decontaminate" and least:
                assert out.filter("doc_id = 60").isEmpty()
            now, before = out, now
        assert now.count() == before.count() and now.agg({"n_tokens": "sum"}).first()[0] is not (
            None if least else 0)


