import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from clickmart.llm import bpe
from clickmart.llm.queries import registry
from tests.llm.conftest import SF, odd_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_query_matches_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = registry()["op7_bpe"](spark, SF).collect()
    assert len(out) == len(docs)
    for r in out:
        ids = library.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_odd_rows(spark, odd_docs, no_docs, library):
    out = bpe.encode_decode(odd_docs).collect()
    want = sorted(str((i, library.encode(t or "", add_special_tokens=False).ids, t or "")) for i, t, *_ in odd_rows())
    assert sorted(str((r["doc_id"], r["ids"], r["decoded"])) for r in out) == want
    assert bpe.encode_decode(no_docs).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    library = Tokenizer.from_file(PATH) if not hasattr(test_any_text, "t") else test_any_text.t
    test_any_text.t = library
    text = text.encode("utf-8", "replace").decode("utf-8")
    codec = bpe.codec_of(PATH)
    ids = library.encode(text, add_special_tokens=False).ids
    assert codec.encode(text) == ids
    assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_random_merge_tables():
    """The gadgets against plain BPE, over small alphabets where merges collide most."""
    r = random.Random(11)
    letters = {b: c for c, b in bpe.byte_letters().items()}
    for _ in range(60):
        base = [letters[b] for b in b"abc"[:r.randint(1, 3)]]
        tokens, merges = list(base), []
        for _ in range(r.randint(1, 12)):
            pair = (r.choice(tokens), r.choice(tokens))
            if pair[0] + pair[1] not in tokens:
                merges.append(pair)
                tokens.append(pair[0] + pair[1])
        vocab = {t: i for i, t in enumerate(tokens)}
        auto = bpe.Automaton(vocab, merges)
        plain = Tokenizer(models.BPE(vocab=vocab, merges=merges))
        for _ in range(40):
            word = "".join(r.choice(base) for _ in range(r.randint(1, 14)))
            assert auto.encode(word.encode()) == plain.encode(word).ids


def test_tables_may_be_emptied():
    codec = bpe.Codec(PATH, most=3)
    text = "one two three four five one two three four five"
    assert codec.encode(text) == bpe.codec_of(PATH).encode(text)
    assert codec.decode(codec.encode(text)) == text
