import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from wardframe.llm import minhash as M
from wardframe.llm.components import components


def prose(seed, n=120):
    draw = random.Random(seed)
    return [draw.choice("abcdefghij") + str(draw.randrange(500)) for _ in range(n)]


def edited(words, seed, edits):
    words = list(words)
    draw = random.Random(seed)
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return words


def brute_force(df, rows, least=0.8):
    """Classes from the similarity of every pair of rows."""
    idf = M.inverse_frequencies(df)
    vectors = M._vectors(pa.array([t for _, t in rows], pa.string()), idf)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        same = (rows[i][1] or "") == (rows[j][1] or "")
        if same or M.weighted_jaccard(vectors[i], vectors[j]) >= least:
            parent[find(i)] = find(j)
    names = {}
    for i, (doc, _) in enumerate(rows):
        names.setdefault(find(i), []).append(doc)
    return sorted((doc, min(names[find(i)]), len(names[find(i)])) for i, (doc, _) in enumerate(rows))


@pytest.fixture(scope="module")
def copies():
    """A large group of near copies, small groups, exact copies and loners."""
    rows, base = [], prose(0, 200)
    for k in range(60):
        rows.append(" ".join(edited(base, k, k % 4)))
    for group in range(1, 12):
        words = prose(group)
        rows += [" ".join(words), " ".join(edited(words, group, 1)), " ".join(words)]
    rows += [" ".join(prose(1000 + k)) for k in range(40)]
    rows += ["one two", "One  two", "one", "", "", None, " \n"]
    return list(enumerate(rows))


@pytest.mark.parametrize("all_pairs", [32, 2])
def test_classes_equal_brute_force(documents, copies, all_pairs):
    df = documents(copies)
    found = M.near_duplicates(df, all_pairs=all_pairs, centres=2)
    assert found.columns == [*df.columns, "class_id", "class_size", "is_first"]
    got = sorted((r.doc_id, r.class_id, r.class_size) for r in found.collect())
    assert got == brute_force(df, copies)
    assert {r.doc_id for r in found.collect() if r.is_first} == {c for _, c, _ in got}


def test_one_row_of_each_class_stays(documents, copies):
    df = documents(copies + copies)
    kept = M.one_per_class(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted({c for _, c, _ in brute_force(df, copies)})


def test_null_and_repeated_ids(documents):
    text = " ".join(prose(5))
    rows = [(None, text), (7, text), (7, text), (None, "x y z"), (None, "x y z"), (3, "alone here")]
    found = M.near_duplicates(documents(rows)).collect()
    got = sorted((str(r.doc_id), str(r.class_id), r.class_size, r.is_first) for r in found)
    assert got == [
        ("3", "3", 1, True),
        ("7", "7", 3, True),
        ("7", "7", 3, True),
        ("None", "7", 3, False),
        ("None", "None", 2, True),
        ("None", "None", 2, True),
    ]
    assert M.one_per_class(documents(rows)).count() == 3


def test_empty_table(documents):
    assert M.near_duplicates(documents([])).collect() == []
    assert M.one_per_class(documents([])).collect() == []


def test_samples_agree_as_often_as_texts_are_similar():
    idf = np.linspace(1, 9, M.CELLS)
    a = M._vectors(pa.array([" ".join(prose(3, 400))]), idf)[0]
    b = M._vectors(pa.array([" ".join(edited(prose(3, 400), 1, 12))]), idf)[0]
    ends = np.array([0, len(a[0]), len(a[0]) + len(b[0])])
    both = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    drawn = M.samples(*both, ends, 4000)
    assert abs((drawn[0] == drawn[1]).mean() - M.weighted_jaccard(a, b)) < 0.03


def test_heavy_shingles_are_drawn_more_often():
    shingles = np.arange(1, 5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    weights = np.array([1.0, 2.0, 3.0, 4.0])
    drawn = M.samples(shingles, weights, np.array([0, 4]), 6000)
    alone = [M.samples(shingles[i : i + 1], weights[i : i + 1], np.array([0, 1]), 6000) for i in range(4)]
    shares = [(drawn == a).mean() for a in alone]
    assert np.allclose(shares, weights / 10, atol=0.03)


def test_long_texts(documents):
    words = prose(9, 60_000)
    rows = [(1, " ".join(words)), (2, " ".join(edited(words, 2, 100))), (3, " ".join(prose(10, 60_000)))]
    found = {r.doc_id: r.class_id for r in M.near_duplicates(documents(rows)).collect()}
    assert found == {1: 1, 2: 1, 3: 3}


def test_components_of_a_chain_and_a_star(spark):
    chain = [(f"{i:05d}", f"{i + 1:05d}") for i in range(300)]
    star = [("hub", f"leaf{i}") for i in range(50)] + [("hub", "hub")]
    links = spark.createDataFrame(chain + star, "a string, b string")
    roots = {}
    for r in components(links).collect():
        roots.setdefault(r.root, set()).add(r.node)
    assert sorted(map(len, roots.values())) == [51, 301]
    assert components(links.filter("a = b")).collect() == []
