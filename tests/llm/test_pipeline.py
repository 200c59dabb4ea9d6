"""Each stage of the pipeline on the small tables and on planted rows, against plain Python."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from hexloom.llm.queries import vocabulary_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    some = given.orderBy("doc_id").limit(3).collect()
    planted = [
        (90_001, None, "en", "src", 0), (90_002, "", "en", "src", 0), (90_003, "12 34 !!", "en", "src", 8),
        (90_004, some[0].text, some[0].lang, "src", 1), (90_005, some[1].text + " extra", some[1].lang, "src", 1), (90_006, "The of and that is with the by. " + item + " This is the end of it.", "en", "src", 1),
    ]
    return given.unionByName(spark.createDataFrame(planted, given.schema)).cache()


def test_stages(spark, docs):
    assert [n for n, _ in cp.STAGES] == ["language ID", "n-gram Jaccard join", "benchmark decontamination", "BPE encoding and decoding"]
    rows = {r.doc_id: r.text for r in docs.collect()}

    known = cp.known_language(spark, docs, SF)
    assert known.columns == docs.columns
    kept = {r.doc_id for r in known.collect()}
    assert kept == {i for i, t in rows.items() if t and any(map(str.isalpha, t))}

    one = {r.doc_id for r in cp.one_of_each_group(spark, known, SF).collect()}
    sets = {}
    for i in kept:
        w = rows[i].lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    parent = {i: i for i in kept}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    order = sorted(kept)
    for n, a in enumerate(order):
        for b in order[:n]:
            if min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b])) and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert one == {i for i in kept if root(i) == i} and 90_004 not in one

    left = docs.where(F.col("doc_id").isin([int(i) for i in one]))
    clean = {r.doc_id for r in cp.no_benchmark(spark, left, SF).collect()}
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert clean == {i for i in one if not any(t in " ".join(rows[i].split()) for t in items)} and 90_006 in one - clean

    theirs = Tokenizer.from_file(vocabulary_path())
    for r in cp.tokens(spark, left, SF).collect():
        want = theirs.encode(rows[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(want), hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].encode()).hexdigest()


def test_run(spark):
    assert cp.run(spark, SF).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_empty_and_null_rows(spark, docs):
    none = docs.where(F.lit(False))
    for _, stage in cp.STAGES:
        assert stage(spark, none, SF).count() == 0
    odd = spark.createDataFrame([(None, "the of and by with", "en", None, None), (None, None, None, None, None), (7, "the of and by with", None, "s", 1), (7, "the of and by with", None, "s", 1)], docs.schema)
    kept = cp.one_of_each_group(spark, odd, SF).collect()
    assert sum(r.doc_id == 7 for r in kept) == 1
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    twice = spark.createDataFrame([(5, item, "en", "s", 1), (5, "an other text under the same key of this table", "en", "s", 2), (None, item, "en", "s", 3), (None, "a text that has no key at all here", "en", "s", 4)], docs.schema)
    assert sorted(r.n_chars for r in cp.no_benchmark(spark, twice, SF).collect()) == [2, 4]
    assert sorted(r.n_chars for r in cp.one_of_each_group(spark, twice, SF).collect()) == [1, 2, 4]
    assert cp.no_benchmark(spark, odd, SF).count() == 4 and cp.tokens(spark, odd, SF).count() == 4
