import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from wardframe.llm import filter_audit as A

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def facts(text):
    words = WORD.findall(text)
    return [
        len(words),
        len(set(words)),
        len(re.findall("[A-Z]", text)),
        len(re.findall(r"[#$%&*|]", text)),
        len(text),
    ]


def brute_force(rows, labels):
    """All rows of the audit, one document and one order at a time; rows of (id, text, source)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    failing = []
    for i, text, source in rows:
        w, d, caps, symbols, points = facts(text or "")
        copy = i is not None and any(
            o is not None and o < i and (t or "") == (text or "") for o, t, _ in rows
        )
        fails = {
            f
            for f, yes in zip("ABCDE", (w < 200, 100 * d < 50 * w, 100 * caps > 2 * points, symbols > 0, copy))
            if yes
        }
        failing.append((source or "", fails, i in good, i in toxic))
    found, shapley = {}, Counter()
    for part in {p for p, *_ in failing}:
        for order in permutations("ABCDE"):
            for step, own in enumerate(order, 1):
                cell = Counter()
                for p, fails, is_good, is_toxic in failing:
                    if p != part:
                        continue
                    gone = fails & set(order[: step - 1])
                    cell["unique"] += fails == {own}
                    if own in fails:
                        cell["redundant" if gone else "removed"] += 1
                        cell["good"] += is_good and not gone
                        cell["toxic"] += is_toxic and not gone
                    else:
                        cell["kept"] += not gone
                shapley[part, own] += cell["removed"]
                found[part, "".join(order), step] = [
                    cell[c] for c in ("kept", "removed", "redundant", "unique", "good", "toxic")
                ]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in found.items()}


def got(df):
    rows = df.collect()
    found = {
        (r.part, r.filter_order, r.step): (
            r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley,
        )
        for r in rows
    }
    assert len(found) == len(rows)
    return found


LONG = " ".join(f"word{i}" for i in range(250))
ROWS = [
    (1, LONG, "a"),
    (2, LONG, "a"),
    (2, LONG, "b"),
    (3, LONG, None),
    (None, LONG, "a"),
    (None, None, "b"),
    (4, None, "a"),
    (5, "", ""),
    (6, "same " * 300, "a"),
    (7, "same " * 300, "b"),
    (8, LONG.upper(), "b"),
    (9, LONG + " #", "a"),
    (10, "FEW | words", "a"),
    (10, "FEW | words", "a"),
    (11, "FEW | words", "a"),
    (12, " ".join(f"w{i}" for i in range(200)), "c"),
    (13, " ".join(f"w{i % 100}" for i in range(200)), "c"),
    (14, " ".join(f"w{i % 99}" for i in range(200)), "c"),
    (15, "A" + " b" * 24 + "c", "c"),
    (16, "é" * 99_990 + " " + "ÀB" * 5000, "c"),
    (17, "sequence of very many words " * 30_000, "c"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (7, None, 1), (9, 0, None), (None, 1, 1), (99, 1, 1), (10, 1, 0), (11, 1, 1)]


@pytest.fixture(scope="module")
def tables(spark):
    extra = ["id", "part", "digest", "four", "n", "good", "toxic", "quality", "first", "failed"]
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("source", T.StringType()),
            *[T.StructField(c, T.StringType()) for c in extra],
        ]
    )
    return lambda rows, labels: (
        spark.createDataFrame([(*r, *extra) for r in rows], schema),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_equals_brute_force(tables):
    found = got(A.audit_filters(*tables(ROWS, LABELS)))
    assert found == brute_force(ROWS, LABELS)
    assert len(found) == 600 * 4


def test_copies_beyond_any_task(tables):
    rows = [(i, LONG, "a" if i % 3 else "b") for i in range(400)] + [(None, LONG, "a")] * 50
    assert got(A.audit_filters(*tables(rows, LABELS))) == brute_force(rows, LABELS)


def test_empty_tables(tables):
    assert A.audit_filters(*tables([], LABELS)).collect() == []
    assert got(A.audit_filters(*tables(ROWS, []))) == brute_force(ROWS, [])


PIECES = ["a", "B", "É", "日", " ", "\n", "\x0b", "\x1c", "\xa0", "#", "|", "%", "word", "🙂", "long" * 9, "", "x" * 1500]
lists = st.lists(st.lists(st.sampled_from(PIECES), max_size=15).map("".join), max_size=8)


@settings(max_examples=150, deadline=None)
@given(lists)
def test_facts_of_many_texts(texts):
    found = A.facts_of(pa.array(texts, pa.string()))
    assert found.tolist() == [facts(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(lists)
def test_blocks_do_not_show(texts):
    whole = A.facts_of(pa.array(texts, pa.string())).tolist()
    before = A.BLOCK
    try:
        A.BLOCK = 3
        assert A.facts_of(pa.array(texts, pa.string())).tolist() == whole
    finally:
        A.BLOCK = before


def test_words_of_one_hash_stay_apart():
    words = ["one", "two", "one", "three", "two", "long" * 20, "long" * 20, "long" * 19 + "none"]
    raw = np.frombuffer((" ".join(words) + " " * 8).encode(), np.uint8)
    length = np.array([len(w) for w in words])
    begin = np.cumsum([0, *(length[:-1] + 1)])
    owner = np.zeros(len(words), np.int64)
    new = A.first_seen(raw, begin, length, owner, hashes=np.full(len(words), 7, np.uint64))
    assert new.tolist() == [True, True, False, True, False, True, False, True]
    # Every word of another owner is new again.
    new = A.first_seen(raw, begin, length, np.arange(8), hashes=np.full(len(words), 7, np.uint64))
    assert new.all()
