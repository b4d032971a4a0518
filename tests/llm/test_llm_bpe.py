"""Per-prefix BPE against the tokenizers library, and round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from llm_cases import documents, empty, frame
from tokenizers import Tokenizer

from claimsdq.llm import bpe

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def mine():
    return bpe.PrefixBPE(PATH)


def same(mine, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert mine.encode(text) == ids, text
    decoded = library.decode(ids, skip_special_tokens=False)
    assert mine.decode(ids) == decoded
    assert mine.encode_with_text(text) == (np.asarray(ids, "<u4").tobytes(), decoded.encode())


def test_documents(mine, library):
    for r in documents(16):
        same(mine, library, r[1] or "")


def test_random_texts(mine, library):
    r = random.Random(4)
    tokens = [t.replace("</w>", "") for t in library.get_vocab()]
    odd = "aaaabcdeehhiinorstt'  \n.,!?0123éüñßİıΣσ漢字🙂́　\x1c\x85ǅ"
    for n in range(2500):
        kind = n % 4
        text = "".join(r.choice(odd) for _ in range(r.randint(0, 60))) if kind == 0 else \
            "".join(r.choice("abhn") for _ in range(r.randint(1, 40))) if kind == 1 else \
            "".join(r.choice(tokens) for _ in range(r.randint(1, 6))) if kind == 2 else \
            "".join(r.choice(["<|endoftext|>", "<|startoftext|>", "aaa", "the ", "<|", "x"]) for _ in range(r.randint(1, 8)))
        same(mine, library, text)


def test_long_words_and_texts(mine, library):
    same(mine, library, "ab" * 20_000 + "a" * 5_000)
    same(mine, library, "word " * 20_000)


def test_pair_compatibility_is_bpe_of_the_pair(mine, library):
    r = random.Random(5)
    vocab = library.get_vocab()
    inner = [t for t in vocab if t.isascii() and t.isalpha() and t.islower() and not t.endswith("</w>")]
    last = [t for t in vocab if t.endswith("</w>") and t[:-4].isascii() and t[:-4].isalpha() and t[:-4].islower()]
    seen = set()
    for _ in range(3000):
        a, b = r.choice(inner), r.choice(last)
        want = library.encode(a + b[:-4], add_special_tokens=False).ids == [vocab[a], vocab[b]]
        # a word's own tokens must be BPE of themselves for the pair to say more
        if library.encode(b[:-4], add_special_tokens=False).ids == [vocab[b]]:
            assert mine.compatible(vocab[a], vocab[b]) == want, (a, b)
            seen.add(want)
    assert seen == {True, False}


def test_small_tables_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    monkeypatch.setattr(bpe, "CACHE_PAIRS", 3)
    small = bpe.PrefixBPE(PATH)
    for r in documents(17, n=20, long_words=200):
        same(small, library, r[1] or "")


def test_query_form(spark, library):
    rows = documents(18)
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_digests(frame(spark, rows), PATH).collect()}
    want = set()
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.add((r[0], len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256(text.encode()).hexdigest()))
    assert got == want
    real = {r.doc_id: (r.ids, r.decoded) for r in bpe.encode(frame(spark, rows), PATH).collect()}
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        assert real[r[0]] == (ids, library.decode(ids, skip_special_tokens=False))
    with_ids = bpe.encode_digests(frame(spark, rows), PATH, with_ids=True).collect()
    assert all(len(r.ids) == r.n_tokens for r in with_ids)
    assert bpe.encode_digests(empty(spark), PATH).count() == 0 and bpe.encode(empty(spark), PATH).count() == 0


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        bpe.PrefixBPE(str(public_tokenizers.path("byte_bpe_50k.json")))
