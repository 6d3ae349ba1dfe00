"""The corpus pipeline on planted documents: what goes, what stays."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__
import corpus_pipeline
from scorewatch.llm import bpe
from scorewatch.llm.queries import MULTI_RANKS

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean documents, toxic ones, repeated passages, near copies, benchmark passages."""
    rnd = random.Random(12)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "re", "su", "ti") for b in ("na", "pe", "ro", "sta", "vu", "xi", "za", "bo")]
    line = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    texts = {d: "\n".join(line(rnd.randrange(8, 25)) for _ in range(8)) for d in range(400)}
    kind = {d: "clean" for d in texts}
    for d in range(0, 400, 9):
        kind[d] = "toxic"
        texts[d] = " ".join(w if rnd.random() > 0.06 else rnd.choice(["vile", "stinker", "rotten"]) for w in texts[d].split(" ")) + " vile"
    passage = "\n".join(line(20) for _ in range(4))
    for d in (31, 55, 301):
        kind[d] = "passage"
        texts[d] = texts[d] + "\n" + passage
    for d in (41, 142, 243):
        kind[d] = "copy"
        w = texts[41].split(" ")
        if d != 41:
            w[d % 50] = "changed"
            w[d % 50 + 40] = "altered"
        texts[d] = " ".join(w).replace("\n", " ")
    kind[350], texts[350] = "exact", texts[12]
    items = [(i, line(30)) for i in range(5)]
    for d in (61, 161):
        kind[d] = "leak"
        texts[d] = f"{texts[d]}\n{items[d % 5][1]} and on"
    texts[10], texts[11] = None, ""
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in texts.items()],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(d, 1, int(kind[d] == "toxic")) for d in texts if d % 4], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), texts, kind, passage


def test_stages(spark, corpus, tmp_path):
    folder, texts, kind, passage = corpus
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
        assert name == "bpe" or docs.columns == COLUMNS
    clean = {d for d, k in kind.items() if k == "clean"}
    toxic = {d for d, k in kind.items() if k == "toxic"}
    after = seen["toxicity"]
    assert len(toxic - set(after)) >= 0.9 * len(toxic) and len(clean - set(after)) <= 0.01 * len(clean)
    lines = seen["line_dedup"]
    assert passage in lines[31].text
    assert all(passage not in lines[d].text and lines[d].n_chars == len(lines[d].text) for d in (55, 301))
    assert 350 not in lines and lines[12].text == texts[12]
    assert clean & set(after) <= set(lines)
    near = seen["near_dedup"]
    assert {41, 142, 243} & set(near) == {41} and clean & set(lines) <= set(near)
    left = seen["decontamination"]
    assert not {61, 161} & set(left) and clean & set(near) <= set(left)
    with open(public_tokenizers.path(MULTI_RANKS), "rb") as f:
        encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(f.read()), special_tokens={})
    assert set(seen["bpe"]) == set(left)
    for d, r in seen["bpe"].items():
        ids = encoding.encode_ordinary(left[d].text or "")
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256((left[d].text or "").encode()).hexdigest()


def test_registered_and_run(spark, corpus):
    folder = corpus[0]
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in __spark_entry__.oracle_sql()
    names = __spark_entry__.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "ids", "n_tokens", "decoded_sha256"] and out.count() > 250


def test_edge_rows_through_all_stages(spark, corpus, tmp_path):
    """Nulls in every column, empty and very long texts, repeated rows, other
    columns whose names the stages use inside, and an empty table."""
    folder = corpus[0]
    long = "\n".join(f"line {i} of a very long text that stays" for i in range(30_000))
    rows = [(900, None, None, None, None), (901, "", "en", "s", 0), (902, long, "en", "s", len(long)), (903, "short one", "en", "s", 9),
            (903, "short one", "en", "s", 9), (None, "text without an id", "en", "s", 18)]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame(rows, docs.schema)).selectExpr(
        "*", "1 AS hash", "2 AS node", "'x' AS key", "3 AS d", "4 AS score", "5 AS block", "6 AS _d", "7 AS line", "8 AS label", "9 AS item_id")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, docs.limit(0), folder)
        assert empty.columns == columns and empty.count() == 0, name
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns, name
    left = {r.doc_id: r for r in docs.collect()}
    assert {902, None} <= set(left) and left[902].text == long and left[902].hash == 1
    assert sum(r.doc_id == 903 for r in docs.collect()) == 1 or docs.filter("doc_id = 903").distinct().count() == 1
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs.limit(0), folder).count() == 0
    assert last(spark, docs, folder).filter("doc_id = 902").count() == 1
