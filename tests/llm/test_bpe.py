import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hexloom.llm.bpe import Encoder, encode_and_decode

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def pair():
    return Encoder(json.load(open(PATH, encoding="utf-8"))), Tokenizer.from_file(PATH)


def texts():
    r = random.Random(3)
    yield from ["", " ", "\n\n  a", "a" * 5000, "ab" * 3000, "don't we'll  I'm", "<|endoftext|>", "x<|endoftext|> y<|endoftext|><|endoftext", "ß é 漢字 🙂‍🙂", "\u0000\u0001\t\r\n", "1234567890 % $$$ ###***"]
    for alphabet in ("ab", "aeiou st", "the and ing er on re in ", "0123456789,. ", "éèêçß äöü", "".join(map(chr, range(32, 0x250))), "🙂🙃漢字かな한 \n"):
        for _ in range(150):
            yield "".join(r.choice(alphabet) for _ in range(r.randrange(1, 120)))
    for _ in range(200):
        yield "".join(chr(r.choice([r.randrange(32, 127), r.randrange(0x400, 0x3000), r.randrange(0x1F300, 0x1F700)])) for _ in range(40))


def test_same_ids_as_the_library(pair):
    ours, theirs = pair
    for text in texts():
        want = theirs.encode(text, add_special_tokens=False).ids
        assert ours.encode(text).tolist() == want, repr(text)
        assert ours.decode(np.array(want, "<u4")) == theirs.decode(want, skip_special_tokens=False)


def test_bytes_that_are_no_text_decode_like_the_library(pair):
    ours, theirs = pair
    r = random.Random(5)
    for _ in range(300):
        ids = [r.randrange(50257) for _ in range(r.randrange(1, 12))]
        assert ours.decode(np.array(ids, "<u4")) == theirs.decode(ids, skip_special_tokens=False)


def test_rows(spark):
    df = spark.createDataFrame([(1, None, "p"), (2, "", "q"), (3, "the same", "r"), (3, "the same", "r"), (4, "x " * 60_000, None)], "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r for r in encode_and_decode(df, PATH, keep_ids=True).collect()}
    none = hashlib.sha256(b"").hexdigest()
    assert [got[k].n_tokens for k in (1, 2)] == [0, 0] and got[1].ids_sha256 == got[2].decoded_sha256 == none
    assert got[3].decoded == "the same" and got[4].decoded == "x " * 60_000 == got[4].text
    assert encode_and_decode(df, PATH).count() == 5
    assert encode_and_decode(df.where(F.lit(False)), PATH).count() == 0
