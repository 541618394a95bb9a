"""Hashes that hold for words made to collide modulo powers of two."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.llm import bpe, minhash
from reviewlens.llm.common import small_batches
from reviewlens.llm.hashing import PRIME, Hashes, modulo, powers


def thue_morse(n: int, letters: str = "ab") -> str:
    return "".join(letters[bin(i).count("1") & 1] for i in range(n))


def pairs():
    for n in (512, 1024, 2048):
        yield thue_morse(n), thue_morse(n, "ba")
        yield "sevenab" + thue_morse(n), "sevenab" + thue_morse(n, "ba")


def test_words_that_collide_modulo_two_to_the_64():
    for a, b in pairs():
        text = np.frombuffer((a + " " + b).encode(), np.uint8)
        x, y = Hashes(text).of(np.array([0, len(a) + 1]), np.array([len(a), len(text)]))
        assert x != y


def test_tokens_of_such_words():
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(bpe.default_tokenizer())
    one = bpe.WordBpe(bpe.default_tokenizer())
    for a, b in pairs():
        for text in (a, b, f"{a} {b} {a}"):
            assert one.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_documents_of_such_words_are_not_linked(spark):
    small_batches(spark)
    texts = [t for pair in pairs() for t in pair] + [thue_morse(1031), thue_morse(1031, "ba")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = minhash.near_duplicates(docs).collect()
    assert len(rows) == len(texts) and all(r["component_id"] == r["doc_id"] and r["kept"] for r in rows)
    assert docs.select(F.countDistinct("text")).first()[0] == len(texts)


def test_hashes_are_polynomials_modulo_the_prime():
    x = np.array([0, PRIME - 1, PRIME, PRIME + 5, (1 << 64) - 1], np.uint64)
    assert modulo(x).tolist() == [int(v) % PRIME for v in x.tolist()]
    assert powers(12345, 40).tolist() == [pow(12345, i, PRIME) for i in range(41)]
    rng = np.random.default_rng(0)
    text = np.tile(rng.integers(0, 256, 500, dtype=np.uint8), 3)
    hashes = Hashes(text)
    grams = hashes.grams(200)
    assert len(grams) == 1301 and (grams[:500] == grams[500:1000]).all() and len(set(grams.tolist())) == 500
    assert (hashes.of(np.arange(1301), np.arange(200, 1501)) == grams).all()


def test_texts_longer_than_a_stretch(monkeypatch):
    text = np.frombuffer(b"abcdefgh" * 200_000, np.uint8)
    hashes = Hashes(text)
    a, b = hashes.of(np.array([0, 8 * 150_000]), np.array([8000, 8 * 151_000]))
    assert a == b
