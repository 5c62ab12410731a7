"""Token counts of the compiled tokenizer against the library's."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import token_counts
from tidemark.llm.queries import PIECE_MODEL, tokenizer
from tidemark.llm.token_counts import Transducer, count_tokens

sentencepiece = pytest.importorskip("sentencepiece")
ODD_TEXTS = [None, "", "a", " ", "  ", "\n", "▁", "▁▁ a", "<s></s> x <unk>", "漢字🙂", "\0a\0", "a" * 5000, " " * 3000, "ab" * 4000,
             "é" * 3000, "1234567890" * 500, "=-" * 2000 + "a" * 3, "abcdefgh" * 900, "ẞß" * 700 + " x"]
ALPHABETS = [" ab", "abcdefghijklmnopqrstuvwxyz", "aeioust r", "ab\n\t  =-*#/0123456789", "éèàüßñ aeioulnst", "漢字かな🙂 a", " "]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer(PIECE_MODEL))


def check(library, texts):
    got = np.concatenate(list(Transducer.of(tokenizer(PIECE_MODEL)).count(pa.array(texts, pa.string()))))
    assert got.tolist() == [len(library.encode(t)) if t else 0 for t in texts]


def made(seed, letters, most=3000):
    r = random.Random(seed)
    return ["".join(r.choice(letters) for _ in range(r.choice([0, 1, 2, 5, 20, 300, most]))) for _ in range(40)]


def test_odd_texts(library):
    check(library, ODD_TEXTS)


@pytest.mark.parametrize("letters", ALPHABETS)
def test_random_texts(library, letters):
    check(library, made(1, letters))


@pytest.mark.parametrize("letters", ALPHABETS)
@pytest.mark.parametrize("guesses", [1, 4])
def test_maps_of_cuts_inside_runs(library, monkeypatch, letters, guesses):
    """With small chunks unbroken runs have many maps; with a single guess most start states are not in them."""
    monkeypatch.setattr(token_counts, "CHUNK", 16)
    monkeypatch.setattr(token_counts, "UNBROKEN", 20)
    monkeypatch.setattr(token_counts, "GUESSES", guesses)
    check(library, [*made(2, letters, 1500), *ODD_TEXTS])


def test_slices_of_long_texts_and_a_small_table(library, monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE_BYTES", 1000)
    check(library, [*ODD_TEXTS, *made(3, "abc é漢")])
    monkeypatch.setattr(token_counts, "MAX_STATES", 300)
    check(library, [*ODD_TEXTS, *made(4, "abcdefghijklmnop rst")])


def test_documents(spark, documents, odd, library):
    for docs in (documents, odd):
        want = sorted((str(r.doc_id), len((r.text or "").encode()), len(library.encode(r.text)) if r.text else 0) for r in docs.collect())
        got = count_tokens(docs, tokenizer(PIECE_MODEL), limit=60).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 60) for r in got)


def test_columns_and_no_rows(odd, none):
    got = count_tokens(none, tokenizer(PIECE_MODEL))
    assert got.count() == 0
    assert got.columns == [*[c for c in odd.columns if c != "text"], "n_bytes", "n_tokens", "over_limit"]
    assert count_tokens(odd.select("text"), tokenizer(PIECE_MODEL)).count() == odd.count()
