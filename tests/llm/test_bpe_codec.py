"""Encoding and decoding equal the tokenizers library, and the methods' own tables are right."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from assay.llm import bpe_codec

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None,
    "",
    "   \t\r\n\x0b ",
    "It's <|endoftext|> 12345 a b\x1cc<|startoftext|><|endoftext|>x <|endoftext",
    "ΟΔΟΣ éé é 😀😀 !!?? İstanbul ﬁ",
    "x" * 5000,
    "ab" * 3000 + "　" + "don't'll I'M",
    "</w> <w/>  a a \x00",
    "日本語のテキスト العربية हिन्दी",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe_codec.Encoder(bpe_codec.Vocabulary.load(PATH))


def same(texts, library, encoder):
    decoder = bpe_codec.Decoder(encoder.vocabulary.tokens)
    for text in texts:
        expected = library.encode(text or "", add_special_tokens=False).ids
        packed = encoder.text((text or "").encode())
        assert np.frombuffer(packed, "<u4").tolist() == expected, text
        assert decoder.text(packed).decode() == library.decode(expected, skip_special_tokens=False)


def test_odd_texts(library, encoder):
    same(ODD, library, encoder)


def test_plain_text_is_split_as_by_the_library(encoder):
    rng = random.Random(8)
    plain = [chr(c) for c in [*range(0x21, 0x7F), *range(0xC0, 0x250)] if bpe_codec.PLAIN.fullmatch(chr(c))]
    words = ["".join(rng.choices(plain, k=rng.randint(1, 12))) for _ in range(5000)] + plain + ["'S", "DON'T", "a'LLb", "1a2"]
    assert encoder.split is not None
    for word in words:
        slow = encoder.pre_tokenizer.pre_tokenize_str(encoder.normalizer.normalize_str(word))
        assert encoder.pieces(word) == [piece for piece, _ in slow], word


@pytest.mark.parametrize("letters", ["ab", "aein", "thern", "abcdefghijklmnopqrstuvwxyz'0 ", "aéß 中!?́　"])
def test_random_words(library, encoder, letters):
    rng = random.Random(len(letters))
    same(["".join(rng.choices(letters, k=rng.randint(1, 60))) for _ in range(1500)], library, encoder)


def test_words_of_whole_tokens(library, encoder):
    rng = random.Random(5)
    ends = [t.removesuffix("</w>") for t in encoder.vocabulary.tokens]
    same(["".join(rng.choices(ends, k=rng.randint(1, 5))) for _ in range(3000)], library, encoder)


def test_very_long_word_takes_linear_work(encoder):
    calls = 0
    fits = encoder.fits

    def counted(a, b):
        nonlocal calls
        calls += 1
        return fits(a, b)

    encoder.fits = counted
    rng = random.Random(1)
    word = "".join(rng.choices("aeinrst", k=200_000))
    ids = encoder.word(word)
    encoder.fits = fits
    assert "".join(encoder.vocabulary.tokens[i].removesuffix("</w>") for i in ids) == word
    assert calls < 10 * len(word)


def test_a_rank_that_comes_too_early_is_refused(tmp_path):
    vocab = {"a": 0, "b": 1, "a</w>": 2, "abb": 3, "ab": 4}
    model = {"type": "BPE", "end_of_word_suffix": "</w>", "vocab": vocab, "merges": [["ab", "b"], ["a", "b"]]}
    file = tmp_path / "early.json"
    file.write_text(json.dumps({"model": model, "decoder": None, "added_tokens": []}))
    with pytest.raises(ValueError, match="made later"):
        bpe_codec.Vocabulary.load(str(file))


def test_query_rows(spark, library, tmp_path):
    schema = "doc_id long, text string, ids string, n_tokens string, `a.b` int"
    rows = [(i, text, "x", "y", 1) for i, text in enumerate(ODD)] + [(1, "", "x", "y", 1), (None, "no id", None, None, None)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in bpe_codec.op11_bpe_codec(spark, str(tmp_path)).collect()), key=str)
    expected = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        expected.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == sorted(expected, key=str)


def test_query_on_the_given_table(spark, sf, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for row in bpe_codec.op11_bpe_codec(spark, sf).collect():
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_codec.decode(bpe_codec.encode(none, PATH), PATH).collect() == []
