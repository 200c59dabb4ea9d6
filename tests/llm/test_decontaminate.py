import random

from pyspark.sql import functions as F

from hexloom.llm.decontaminate import LITERAL, NAME, NUM, UNIT, bit_array, clean, contaminated, maybe, template
from hexloom.llm import wordhash
from hexloom.llm.wordhash import chunks, hash_of
import numpy as np

ITEM = "A train leaves Paris at 9 am and travels 120 km to reach Lyon while another train leaves Lyon at 10 am and travels 80 km towards Paris; when do they meet?"
OTHER = ITEM.replace("Paris", "Berlin").replace("Lyon", "Munich").replace("9", "7").replace("120", "340").replace("80", "55").replace("10 am", "8 am")
BROKEN = "A train leaves Rome at 1 am and travels 2 km to reach Oslo while another train leaves Bern at 3 am and travels 4 km towards Wien; when do they meet?"
FILLER = "plain words that say nothing of note and go on for a while so that the text around is longer than what it holds "


def pairs(df):
    return sorted((r.doc_id, r.item_id, r.kind) for r in df.collect())


def test_kinds():
    (chunk,) = chunks(["Mary paid $5 for 3 kg of rice in Rome. Then 7kg, 20% and twelve days passed by a kg", None, "Été à Évry (Paris)"])
    _, kind, value = template(chunk)
    assert chunk.places.tolist() == [0, 20, 20, 24] and value[9] == hash_of("rome") and value[-1] == hash_of("paris")
    assert kind[20:].tolist() == [LITERAL, LITERAL, NAME, NAME]
    assert kind[:20].tolist() == [LITERAL, LITERAL, NUM, LITERAL, NUM, UNIT, LITERAL, LITERAL, LITERAL, NAME, LITERAL, NUM, NUM, LITERAL, NUM, UNIT, LITERAL, LITERAL, LITERAL, LITERAL]


def test_leaks_and_clean_documents(spark):
    docs = [
        (1, FILLER + ITEM + " " + FILLER), (2, ITEM.upper().replace("AM", "am")), (3, FILLER + OTHER), (4, FILLER * 3), (5, None), (6, ""), (7, FILLER + BROKEN + FILLER),
        (8, FILLER + ITEM), (8, FILLER + ITEM), (9, "when do they meet?"), (10, ITEM[:60]), (11, FILLER + ITEM[: len(ITEM) * 2 // 3] + "."), (None, ITEM), (12, "x " * 50_000 + ITEM),
    ]
    items = [(100, ITEM), (101, "Short one"), (102, None), (103, ""), (100, ITEM), (None, FILLER), (104, "totally different words in a question that nobody ever copied from here")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item", F.lit("clash"))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("doc", F.lit("clash"))
    got = pairs(contaminated(d, b))
    assert [g for g in got if g[0] not in (2, 10)] == [(1, 100, "verbatim"), (3, 100, "reparameterised"), (8, 100, "verbatim"), (11, 100, "verbatim"), (12, 100, "verbatim")]
    assert contaminated(d.where(F.lit(False)), b).count() == 0 and contaminated(d, b.where(F.lit(False))).count() == 0


def test_copies_in_other_case_and_short_items(spark):
    short, name, sharp = "Who wrote the Old Book?", "Jean Paul Sartre Junior", "Die große Straße führt am weißen Haus vorbei zum Fluß und bis zum alten Schloß"
    docs = [
        (2, ITEM.upper().replace("AM", "am")), (10, ITEM[:60]), (20, FILLER + ITEM.upper() + " " + FILLER), (21, FILLER + ITEM.title()), (22, ITEM.lower()),
        (30, FILLER + short + " " + FILLER), (31, short), (32, FILLER + short.upper()), (33, FILLER + "who wrote the new book?"), (40, FILLER + name.lower() + " " + FILLER), (41, FILLER * 3), (42, "Jean Paul"), (50, sharp.upper()),
    ]
    items = [(100, ITEM), (200, short), (300, name), (400, "Jean Paul"), (500, sharp)]
    got = pairs(contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    copies = [(d, 100) for d in (2, 20, 21, 22)] + [(d, 200) for d in (30, 31, 32)] + [(40, 300), (42, 400), (50, 500)]
    assert [g for g in got if g[0] != 10] == [(d, i, "verbatim") for d, i in copies]
    assert [g for g in got if g[0] == 10] == [(10, 100, "reparameterised")]  # its last word is cut


def test_own_words_beside_an_inconsistent_copy(spark):
    own = "the old keeper of the grey lighthouse by the northern sea wrote down every ship that passed"
    item = own + " 1 then 2 then 3 then 4 then alpha beta gamma delta 5"
    doc = own + " 6 then 6 then 6 then 6 then alpha beta gamma delta 6"
    got = pairs(contaminated(spark.createDataFrame([(1, doc)], "doc_id long, text string"), spark.createDataFrame([(9, item)], "item_id long, text string")))
    assert got == [(1, 9, "verbatim")]


def test_every_item_in_other_case(spark):
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").select("item_id", "text")
    around = lambda c: F.concat(F.lit(FILLER), c, F.lit(" " + FILLER))
    for change in (F.upper, F.lower, F.initcap):
        docs = items.select(F.col("item_id").alias("doc_id"), around(change("text")).alias("text"))
        got = {(r.doc_id, r.item_id) for r in contaminated(docs, items).collect()}
        assert {(r.item_id, r.item_id) for r in items.collect()} <= got


def test_against_plain_search(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()}
    words = lambda t: " ".join((t or "").split())
    items = [(r.item_id, words(r.text)) for r in bench.collect()]
    want = {(d.doc_id, i) for d in docs.collect() for i, t in items if t in words(d.text)}
    assert want and got == want


def test_bits_have_no_misses():
    r = np.random.default_rng(1)
    h = r.integers(0, 1 << 63, 20_000).astype(np.uint64)
    bits = bit_array(h)
    assert maybe(bits, h).all() and maybe(bits, r.integers(0, 1 << 63, 20_000).astype(np.uint64)).mean() < 0.01


def test_slots_must_be_consistent(spark):
    r = random.Random(1)
    words = [r.choice("alpha beta gamma delta omega sigma kappa theta".split()) + str() for _ in range(40)]
    item = " ".join(w + (f" {k % 5}" if k % 3 == 0 else "") for k, w in enumerate(words))
    same = " ".join(w + (f" {70 + k % 5}" if k % 3 == 0 else "") for k, w in enumerate(words))
    mixed = " ".join(w + (f" {r.randrange(1000)}" if k % 3 == 0 else "") for k, w in enumerate(words))
    d = spark.createDataFrame([(1, same), (2, mixed)], "doc_id long, text string")
    assert pairs(contaminated(d, spark.createDataFrame([(9, item)], "item_id long, text string"))) == [(1, 9, "reparameterised")]


def test_rows_that_stay(spark):
    rows = [(1, FILLER + ITEM, "a"), (1, FILLER, "b"), (None, ITEM, "c"), (None, FILLER, "d"), (2, None, "e"), (2, None, "e"), (3, "", "f"), (3, FILLER, "g"), (3, FILLER, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item string")
    bench = spark.createDataFrame([(100, ITEM)], "item_id long, text string")
    kept = clean(docs, bench)
    assert kept.columns == docs.columns and sorted(r["item"] for r in kept.collect()) == list("bdeefgg")
    assert clean(docs.where(F.lit(False)), bench).count() == 0 and clean(docs, bench.where(F.lit(False))).count() == len(rows)


def test_a_long_text_is_hashed_in_pieces(monkeypatch):
    text = " ".join(f"word{k % 37}é" for k in range(5000))
    (whole,) = chunks([text])
    want = whole.hashes()
    assert want[3] == hash_of("word3é") and want[0] == want[37]
    for piece in (64, 1000, 4097):
        monkeypatch.setattr(wordhash, "PIECE", piece)
        monkeypatch.setattr(wordhash, "_powers", [np.ones(1, np.uint64), np.ones(1, np.uint64)])
        assert (whole.hashes() == want).all()
        assert hash_of("word3é") == want[3]


def test_items_of_a_few_words_are_found_as_whole_documents(spark):
    bench = spark.createDataFrame([(1, "capital of France"), (2, "42"), (3, "Who?"), (4, "  ")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Capital of  france."), (2, "the capital of France is large"), (3, "42"), (4, "43"), (5, "who"), (6, ""), (7, None), (8, "France capital of")], "doc_id long, text string")
    got = contaminated(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id, r.kind, r.covered) for r in got) == [(1, 1, "verbatim", 1.0), (3, 2, "verbatim", 1.0), (5, 3, "verbatim", 1.0)]
