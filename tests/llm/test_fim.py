import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wardframe.llm import fim


def plainly(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by the rules as written."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


PIECES = ["word", "É", "ß", " ", "\n", "\t", "7", "<", "<P", "P>", "<M>", "<S", "日本", "🙂", "x", "\x00", "Z<"]
ROWS = [
    (1, None),
    (2, ""),
    (3, "one"),
    (4, "a <P> b"),
    (5, "<M>"),
    (6, "several words, and a line\nor two"),
    (6, "several words, and a line\nor two"),
    (6, "the same id"),
    (None, "no id here"),
    (-7, "日本語 is not cut within é characters"),
    (8, "long " * 60_000 + "末"),
    (9, "x" * 300_000),
    (10, "é" * 5000),
    *[(100 + i, f"text {i} with <S and M> and < in it " * (i % 5)) for i in range(100)],
    *[(300 + i, "P>") for i in range(30)],
    *[(400 + i, "<") for i in range(30)],
]


def test_equals_the_rules(documents):
    found = fim.restore(fim.fill_in_middle(documents(ROWS))).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found), key=repr)
    assert got == sorted(((i, *plainly(i, t)) for i, t in ROWS), key=repr)
    restored = sorted(((r.doc_id, r.restored) for r in found), key=repr)
    assert restored == sorted(((i, t or "") for i, t in ROWS), key=repr)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_empty_table(documents):
    assert fim.restore(fim.fill_in_middle(documents([]))).collect() == []


def drawn(ids):
    digests = [hashlib.sha256(f"1:{i}".encode()).hexdigest() for i in ids]
    return np.array([[int(d[8 * k : 8 * k + 8], 16) for k in range(4)] for d in digests], np.int64).reshape(-1, 4)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), max_size=8), st.integers(0, 10**9))
def test_many_texts_at_once(texts, first):
    ids = [first + k for k in range(len(texts))]
    n, form, prefix, middle, output = fim.scatter(pa.array(texts, pa.string()), drawn(ids), 90, 20)
    rows = list(zip(*[c.to_pylist() for c in (n, form, prefix, middle, output)]))
    assert rows == [plainly(i, t) for i, t in zip(ids, texts)]
    assert fim.gather(output, form).to_pylist() == texts


def test_blocks_do_not_show(monkeypatch):
    texts = ["some words and ÄÖÜ " * 40, "", "日本 " * 99, "<", "P>S>", "abc" * 70]
    whole = fim.scatter(pa.array(texts), drawn(range(6)), 100, 50)
    monkeypatch.setattr(fim, "BLOCK", 7)
    monkeypatch.setattr(fim, "SCAN_BLOCK", 5)
    assert [c.to_pylist() for c in fim.scatter(pa.array(texts), drawn(range(6)), 100, 50)] == [
        c.to_pylist() for c in whole
    ]
    assert fim.gather(whole[4], whole[1]).to_pylist() == texts


def test_a_broken_output_is_an_error():
    with pytest.raises(ValueError):
        fim.gather(pa.array(["<P>no middle<S>here"]), pa.array(["psm"]))
