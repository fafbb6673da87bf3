import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wardframe.llm import bpe
from wardframe.llm.queries import tokenizer

LIBRARY = Tokenizer.from_file(tokenizer())


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


ODD = [
    None,
    "",
    " ",
    "\n",
    "  two  spaces \n and\tlines\r\n  ",
    "ends with space ",
    "it's we'll they've 'sharp !!'s ''' 's's",
    "<|endoftext|> a<|endoftext|>b <|endof text|>",
    "naïve ÉCOLE straße 日本語テキスト 🙂🙃👨‍👩‍👧 é",
    "\x1c a\x1d b \x85 c   d　 e",
    "a" * 5000,
    "!?" * 3000,
    "12345 67890 " * 500,
    "日本" * 3000,
    " " * 3000 + "x" + "\n" * 999 + " y",
    "<|endoftext|>" * 300,
]


@pytest.mark.parametrize("leaf_chars", [7, 100, bpe.LEAF_CHARS])
def test_ids_equal_the_library(documents, leaf_chars):
    df = documents(enumerate(ODD))
    found = bpe.encode_documents(df, tokenizer(), leaf_chars=leaf_chars).collect()
    assert {r.doc_id: r.ids for r in found} == {i: library(t) for i, t in enumerate(ODD)}
    assert {r.doc_id: r.decoded for r in found} == {i: t or "" for i, t in enumerate(ODD)}


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.sampled_from(["a", "the", " ", "  ", "\n", "'s", "!", "9", "é", "日", "🙂", "\t", "<|endoftext|>", "Zz"]), max_size=60),
    st.integers(1, 9),
)
def test_tree_of_any_text(pieces, leaf):
    text = "".join(pieces)
    own = bpe.encoder(tokenizer())
    import numpy as np

    parts = [np.array(library(p), dtype="<u4") for p in bpe.halves(text, leaf)]
    assert own.join_all(parts).tolist() == library(text)


def test_tree_of_long_unsplit_text():
    import numpy as np

    draw = random.Random(1)
    for alphabet in ("ab", "abcdefghijklmnop", "é日a", "0123456789", "-=_", "aA1 '"):
        text = "".join(draw.choice(alphabet) for _ in range(20_000))
        parts = [np.array(library(p), dtype="<u4") for p in bpe.halves(text, 1000)]
        assert bpe.encoder(tokenizer()).join_all(parts).tolist() == library(text)


def test_repeated_rows_null_ids_and_empty_table(documents):
    rows = [(None, "long text " * 50), (1, "long text " * 50), (1, "long text " * 50), (1, "x")]
    found = bpe.encode_documents(documents(rows), tokenizer(), leaf_chars=64).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in found) == sorted((i or 0, t) for i, t in rows)
    assert bpe.encode_documents(documents([]), tokenizer()).collect() == []
