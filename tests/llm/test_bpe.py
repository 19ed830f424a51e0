"""BPE against the tokenizers library, and the defined cases of the operator."""

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from accesslake.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "</w>", "a</w> b", "<|endoftext|>hi<|startoftext|> x", "a" * 3000, "a\x00b", "\xa0x \xa0y", "it's THE 12,5 Çá",
       "İΣς ﬁ 漢字 한국 😀!!", "\x1c\x85 ​", "the the the"]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load(PATH).prepare()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(packed):
    return [int.from_bytes(packed[k : k + 4], "little") for k in range(0, len(packed), 4)]


def test_same_as_the_library(vocabulary, library):
    rng = random.Random(4)
    letters = "abcdeftheingor'stre0123 \n\t.,!?éñßÀÉİΣς漢字中́😀한<|>/w"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    texts += ["".join(rng.choice("aeinorst") for _ in range(rng.randint(1, 200))) for _ in range(300)]
    for t in texts:
        expected = library.encode(t, add_special_tokens=False).ids
        assert ids_of(vocabulary.encode(t)) == expected, t
        assert vocabulary.decode(vocabulary.encode(t)) == library.decode(expected, skip_special_tokens=False)


def test_a_full_table_changes_nothing(vocabulary, monkeypatch):
    text = "some words and some more words, again and again"
    expected = vocabulary.encode(text)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 2)
    monkeypatch.setattr(bpe, "KEPT_PAIRS", 2)
    vocabulary.words.clear()
    assert vocabulary.encode(text) == expected == vocabulary.encode(text)


def test_rows(frame, vocabulary, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "the cat", "y"), (3, "the cat", "z"), (None, "a " * 5000, None)]
    df = frame(rows, "doc_id long, text string, ids_le string")
    out = bpe.encode(df, vocabulary).withColumn("ids", bpe.unpack(F.col("ids_le")))
    got = sorted(out.collect(), key=lambda r: (r.doc_id or 0, r.decoded))
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 3]
    assert got[1].ids == [] and got[1].decoded == "" and got[2].ids == []
    assert got[3].ids == library.encode("the cat", add_special_tokens=False).ids
    d = {r.doc_id: r for r in bpe.digests(out).collect()}
    assert d[1].n_tokens == 0 and d[1].ids_sha256 == hashlib.sha256(b"").hexdigest() == d[1].decoded_sha256
    assert d[3].decoded_sha256 == hashlib.sha256(b"the</w> cat</w>").hexdigest()


def test_empty_table(frame, vocabulary):
    assert bpe.encode(frame([], "doc_id long, text string"), vocabulary).count() == 0


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary('{"model": {"type": "WordPiece", "vocab": {}}}').prepare()
