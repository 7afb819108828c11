"""The batch encoder against the tokenizers library itself."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dqspark.llm import encoder as M

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
PARTS = st.sampled_from(
    [" ", "  ", "\n", "\t", "\r", "'s", "'ll", "'", "a", "Be", "É", "ß", "×", "12", "3", ".", "!?", "%%", "the", "word",
     "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "\xa0", "\x85", "\u2003", "\x1c", "İ", "Σ", "你好", "🙂", "e\u0301", "²"]
)


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    path = public_tokenizers.path(request.param)
    return M.BatchEncoder(path, max_pieces=50), Tokenizer.from_file(path)


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.lists(PARTS, max_size=25).map("".join), st.text(max_size=20)), max_size=6))
def test_as_the_library(pair, texts):
    mine, lib = pair
    want = [lib.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in mine.lists(texts)] == want
    assert mine.counts(texts).tolist() == [len(x) for x in want]


def test_long_text_in_parts(pair, monkeypatch):
    mine, lib = pair
    monkeypatch.setattr(M, "SLICE_BYTES", 40)
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["abc", "Don't", "x\ny", "12", "é.", ""], 200)) for _ in range(3)]
    assert [x.tolist() for x in mine.lists(texts)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_hash_ties_are_told_apart(pair, monkeypatch):
    mine, lib = pair
    monkeypatch.setattr(mine, "t1", np.ones(256, dtype=np.uint64))  # pieces of one length now tie in the first hash
    texts = ["abc abd cab dog cat", "dog abc"]
    assert mine.counts(texts).tolist() == [len(lib.encode(t, add_special_tokens=False).ids) for t in texts]
