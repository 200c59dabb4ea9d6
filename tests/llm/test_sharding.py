import zlib

from pyspark.sql import functions as F

from hexloom.llm.sharding import shard_documents


def placed(spark, rows, shards, schema="doc_id long, text string, shard string, size string"):
    return shard_documents(spark.createDataFrame(rows, schema), shards).toPandas()


def test_sizes_slots_and_balance(spark):
    rows = [(k, "word " * (k % 97 + 1) + str(k), "x", None) for k in range(6000)] + [(10_000 + k, "hot copy of a text", "x", None) for k in range(3000)]
    got = placed(spark, rows, 6)
    assert len(got) == 9000 and set(got.law) == {"bytes"} and got.grown_shard.isna().all()
    text = {r[0]: r[1] for r in rows}
    assert all(s == len(text[d].encode()) + 8 and c == zlib.crc32(text[d].encode()) for d, s, c in zip(got.doc_id, got["size"], got.text_crc32))
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    sums = got.groupby("shard")["size"].sum()
    assert len(sums) == 6 and sums.max() - sums.min() < 0.005 * sums.mean()
    assert got[got.doc_id >= 10_000].shard.nunique() == 1  # by its bytes it fits in one shard
    words = got.assign(tokens=[len(text[d].split()) for d in got.doc_id]).groupby("shard").tokens.sum()
    assert words.max() < 1.05 * words.mean()


def test_all_measures_are_even_on_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    got = shard_documents(docs, 24).toPandas()
    words = docs.select("doc_id", F.size(F.split(F.trim(F.coalesce("text", F.lit(""))), r"\s+")).alias("words")).toPandas().drop_duplicates("doc_id")
    got = got.merge(words, on="doc_id")
    for measure in (got.groupby("shard")["size"].sum(), got.groupby("shard").words.sum(), got.groupby("shard").doc_id.count()):
        assert len(measure) == 24 and 0.98 * measure.mean() < measure.min() and measure.max() < 1.02 * measure.mean()


def test_groups_up_to_a_share_stay_whole(spark):
    rows = [(k, f"text {k} " + "pad " * (k * 7 % 40), None, None) for k in range(3000)]
    total = sum(len(r[1].encode()) + 8 for r in rows)
    text = "a text that many documents share"
    for part, shards in ((0.9, 1), (4.0, 4)):  # of a share of 8 shards
        copies = int(part * total / 8 / (1 - part / 8) / (len(text) + 8))
        got = placed(spark, rows + [(10_000 + k, text, None, None) for k in range(copies)], 8)
        assert got[got.doc_id >= 10_000].shard.nunique() >= shards and (part > 1 or got[got.doc_id >= 10_000].shard.nunique() == 1)
        sums = got.groupby("shard")["size"].sum()
        assert len(sums) == 8 and sums.max() < 1.01 * sums.mean()


def test_equal_texts_stay_together(spark):
    rows = [(k, f"text number {k // 3} " + "pad " * (k // 3 % 50), None, None) for k in range(6000)]
    got = placed(spark, rows, 4)
    assert (got.assign(g=got.doc_id // 3).groupby("g").shard.nunique() == 1).all()


def test_edges(spark):
    rows = [(1, None, None, None), (2, "", None, None), (3, "a", None, None), (3, "a", None, None), (None, "é" * 100_000, None, None)]
    got = placed(spark, rows, 3)
    assert len(got) == 5 and got["size"].max() == 200_008
    assert set(got[got.doc_id.isin([1, 2])]["size"]) == {8} and set(got[got.doc_id.isin([1, 2])].text_crc32) == {0}
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    empty = spark.createDataFrame(rows, "doc_id long, text string, a string, b string").where(F.lit(False))
    assert shard_documents(empty, 3).count() == 0


def test_equal_rows_and_null_keys_are_cut(spark):
    for keys in ([7] * 2400, [None] * 2400, [7] * 1200 + [None] * 1200):
        got = placed(spark, [(k, "one text in every row", None, None) for k in keys], 24)
        counts = got.groupby("shard").doc_id.size()
        assert len(got) == 2400 and len(counts) == 24 and counts.min() >= 98 and counts.max() <= 102
        assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
        assert got.doc_id.isna().sum() == sum(k is None for k in keys)


def test_copies_beyond_one_task(spark, monkeypatch):
    monkeypatch.setattr("hexloom.llm.sharding.COPIES_A_TASK", 100)
    got = placed(spark, [(7, "one text in every row", None, None)] * 950 + [(8, "another", None, None)] * 50, 4)
    assert len(got) == 1000 and (got.doc_id == 7).sum() == 950 and got.groupby("shard").doc_id.size().max() < 300
