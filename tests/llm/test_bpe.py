import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer as Reference

from tarifa.llm.bpe import Tokenizer, decode, digests, encode, read_spec
from tests.llm.tables import docs_of, needs_tables, texts

PATH = public_tokenizers.path("word_bpe_49k.json")
CASES = [
    None, "", " \n\t", "Hello, WORLD!! it's we'll 123", "x<|endoftext|>y <|startoftext|><|ENDOFTEXT|>", "ΑΣ Σ ς İ ß ﬁ", "é é     x", "aaaaaaaaaaaaaaaa",
    "日本語 текст 🙂🙂", "a\x1cb\x1f c\x85d", "''' 's 'S ===---===", "=" * 5000, "word " * 20000, "ạ́b", "́x",
]


@pytest.fixture(scope="module")
def reference():
    tokenizer = Reference.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def check(spark, rows, reference):
    result = {r["doc_id"]: r for r in decode(encode(docs_of(spark, rows), PATH), PATH).collect()}
    assert len(result) == len(rows)
    for doc, text in rows:
        ids = reference.encode(text or "", add_special_tokens=False).ids
        assert result[doc]["ids"] == ids, text
        assert result[doc]["decoded"] == reference.decode(ids, skip_special_tokens=False)


@needs_tables
def test_whole_table_equals_the_library(spark, reference):
    check(spark, texts(spark), reference)


def test_edge_cases(spark, reference):
    check(spark, [*enumerate(CASES)], reference)


def test_full_tables_are_emptied(reference, monkeypatch):
    from tarifa.llm import bpe

    for name in ("ARCS", "READINGS", "WORDS"):
        monkeypatch.setattr(bpe, name, 20)
    tokenizer = Tokenizer(read_spec(PATH))
    text = "the quick brown fox jumps over a lazy dog and then returns home again " * 3
    assert [int.from_bytes(tokenizer.pack(text)[i : i + 4], "little") for i in range(0, len(tokenizer.pack(text)), 4)] == reference.encode(text, add_special_tokens=False).ids


def test_readings_of_many_words_are_kept():
    """A second pass over words with more than 150,000 readings enters nothing anew."""
    chance = random.Random(5)
    words = ["".join(chance.choices("etaoinshrdlucmfwypvbgk", k=9)) for _ in range(36_000)]
    tokenizer = Tokenizer(read_spec(PATH))
    first = tokenizer.pack(" ".join(words))
    entries = tokenizer.words.automaton.entries
    assert entries > 150_000
    tokenizer.words.clear()
    assert tokenizer.pack(" ".join(words)) == first
    assert tokenizer.words.automaton.entries == entries


def test_missing_ids_and_no_rows(spark):
    rows = digests(decode(encode(docs_of(spark, [(None, "a b"), (1, "a b"), (1, "a b")]), PATH), PATH)).collect()
    assert [r["n_tokens"] for r in rows] == [2, 2, 2]
    assert encode(docs_of(spark, [(1, "a")]).limit(0), PATH).count() == 0
