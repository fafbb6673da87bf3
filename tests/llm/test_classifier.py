import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from wardframe.llm import classifier as C


def numeric_gradient(w, x, ends, label, weight, name, at, step=1e-6):
    def loss(delta):
        moved = {k: v.copy() for k, v in w.items()}
        moved[name][at] += delta
        score = C._forward(moved, x, ends)["score"]
        each = -(label * np.log(score) + (1 - label) * np.log(1 - score))
        return (each * weight).sum() / weight.sum()

    return (loss(step) - loss(-step)) / (2 * step)


def test_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(5)
    x, ends = draw.normal(size=(9, 4)), np.array([0, 2, 3, 7, 9])
    label, weight = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 0.5, 1])
    w = {
        "encode": draw.normal(size=(4, 3)),
        "encode_0": draw.normal(size=3),
        "content": draw.normal(size=(3, 2)),
        "gate": draw.normal(size=(3, 2)),
        "energy": draw.normal(size=2),
        "out": draw.normal(size=3),
        "out_0": np.array(0.3),
    }
    found = C._gradients(w, x, ends, label, weight)
    for name, values in w.items():
        for at in np.ndindex(values.shape):
            assert found[name][at] == pytest.approx(
                numeric_gradient(w, x, ends, label, weight, name, at), abs=1e-6
            )


def test_attention_finds_the_passage_that_decides():
    draw = np.random.default_rng(1)
    tables, labels, marked = [], [], []
    for i in range(300):
        table = draw.normal(0, 0.3, (draw.integers(2, 9), C.FEATURES))
        if i % 2:
            marked.append((len(tables), draw.integers(len(table))))
            table[marked[-1][1], 0] += 4
        tables.append(table)
        labels.append(float(i % 2))
    ends = np.cumsum([0, *map(len, tables)])
    model = C.fit(np.concatenate(tables), ends, np.array(labels))
    score, attention = model.attend(np.concatenate(tables), ends)
    assert ((score > 0.5) == np.array(labels)).mean() > 0.97
    share = [attention[ends[i] + k] * len(tables[i]) for i, k in marked]
    assert np.mean(share) > 1.2  # more than an even share


def test_passages_of_odd_texts():
    texts = [None, "", " \n", "One", "w " * 49, "w " * 51, "é" * 10, "A" * 30_000, "x y", "#### | !!"]
    table, ends = C.passage_features(pa.array(texts))
    assert np.diff(ends).tolist() == [1, 1, 1, 1, 1, 2, 1, 1, 1, 1]
    assert np.isfinite(table).all() and (table[:3] == 0).all()
    for i, text in enumerate(texts):
        alone, _ = C.passage_features(pa.array([text], pa.string()))
        assert np.allclose(alone, table[ends[i] : ends[i + 1]])


def test_one_class_or_no_labels(spark, documents):
    df = documents([(i, f"some text {i}") for i in range(20)])
    schema = "doc_id long, quality int, toxic int"
    for rows, share in (([], 0.5), ([(i, 1, 0) for i in range(20)], 0.98), ([(None, 1, None), (3, None, 0)], 0.5)):
        model = C.train(df, spark.createDataFrame(rows, schema))
        scores = [r.score for r in C.score_documents(df, model).collect()]
        assert len(scores) == 20 and all(abs(s - share) < 0.02 for s in scores)


def test_one_passage_of_five_hundred_earns_the_label(spark, documents):
    clean = " ".join(f"some words of a long text {i}." for i in range(5000))
    bad = " ".join(["###### | !!! $$$$ %%%%"] * 10)
    at = [3000 * (i % 10) + 517 * i for i in range(60)]
    w = clean.split()
    rows = [(i, clean if i % 2 else " ".join([*w[: at[i] % len(w)], bad, *w[at[i] % len(w) :]])) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    model = C.train(documents(rows), labels)
    scores = {r.doc_id: r.score for r in C.score_documents(documents(rows), model).collect()}
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert min(scores[i] for i in held if i % 2) > max(scores[i] for i in held if not i % 2)


def test_labels_without_a_document_use_nothing_up(spark, documents):
    rows = [(i, f"text {i} of words" if i % 2 else "### $$ !!" * 20) for i in range(40)]
    schema = "doc_id long, quality int, toxic int"
    own = [(i, i % 2, 0) for i in range(40)]
    none = [(1000 + i, 1 - i % 2, 0) for i in range(400)]
    one = C.train(documents(rows), spark.createDataFrame(own, schema), fit_documents=30)
    other = C.train(documents(rows), spark.createDataFrame(own + none, schema), fit_documents=30)
    assert all(np.array_equal(one.weights[k], other.weights[k]) for k in one.weights)


def plain_features(text):
    """The measures of each passage, one word after the other."""
    kinds = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&<>@^~=+_\\{}[]", "|", "!?", ".,;:", "\"'()-/`"]
    words = [x for x in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode()) if x]
    found = []
    for a in range(0, max(len(words), 1), C.PASSAGE_WORDS):
        own = words[a : a + C.PASSAGE_WORDS]
        if not own:
            return [[0.0] * C.FEATURES]
        raw, sizes = b"".join(own), [len(x) for x in own]
        keys = [(x[:8], len(x)) for x in own]
        # A word echoes the one before it, also across passages.
        before = [(x[:8], len(x)) for x in words[max(a - 1, 0) : a]]
        mean = sum(sizes) / len(own)
        found.append(
            [sum(b in k.encode() for b in raw) / len(raw) for k in kinds]
            + [sum(b >= 128 for b in raw) / len(raw), mean / 10]
            + [max(sum(n * n for n in sizes) / len(own) - mean**2, 0) ** 0.5 / 10]
            + [sum(x == y for x, y in zip([*before, *keys], [*before, *keys][1:])) / len(own)]
            + [sum(65 <= x[0] <= 90 for x in own) / len(own), len(set(keys)) / len(own), len(own) / C.PASSAGE_WORDS]
        )
    return found


def plain_score(model, rows):
    """Attention and score of one bag, passage by passage."""
    w = model.weights
    hidden = [np.tanh((np.array(r) - model.shift) / model.scale @ w["encode"] + w["encode_0"]) for r in rows]
    energy = [float((np.tanh(h @ w["content"]) / (1 + np.exp(-(h @ w["gate"])))) @ w["energy"]) for h in hidden]
    share = [np.exp(e - max(energy)) for e in energy]
    pooled = sum(s / sum(share) * h for s, h in zip(share, hidden))
    return 1 / (1 + np.exp(-(pooled @ w["out"] + w["out_0"])))


def test_features_and_scores_equal_a_plain_version(trained, documents, texts):
    model = trained[2]
    rows = [*list(texts.items())[:40], (-1, None), (-2, ""), (-3, "é Ü| x x x " * 70), (-4, "A" * 5000)]
    for _, text in rows:
        table, _ = C.passage_features(pa.array([text], pa.string()))
        assert np.allclose(table, plain_features(text), atol=1e-5)
    scores = {r.doc_id: r.score for r in C.score_documents(documents(rows), model).collect()}
    for i, text in rows:
        assert scores[i] == pytest.approx(float(plain_score(model, plain_features(text))), abs=1e-4)


@pytest.fixture(scope="module")
def trained(spark, folder):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, C.train(docs, labels)


def test_held_out_accuracy(trained):
    docs, labels, model = trained
    scored = C.score_documents(docs, model).join(labels, "doc_id").collect()
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = [(r.score >= C.THRESHOLD) == (r.quality == 1) for r in held]
    assert len(held) > 50 and sum(right) / len(right) > 0.95
    assert all(0 <= r.score <= 1 and abs(sum(r.attention) - 1) < 1e-3 for r in scored)


def test_labels_of_held_out_documents_are_not_learnt(trained):
    docs, labels, model = trained
    held = "crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"
    turned = labels.selectExpr("doc_id", f"CASE WHEN {held} THEN 1 - quality ELSE quality END AS quality")
    again = C.train(docs, turned)
    assert all(np.array_equal(model.weights[k], again.weights[k]) for k in model.weights)


def test_accepted_rows_are_those_that_score(trained, documents):
    _, _, model = trained
    rows = [(1, "The plain words of a text, and more of them."), (2, "## $$ %% ## **" * 20), (3, None), (1, "JUNK!! JUNK!! " * 50)]
    df = documents(rows * 2)
    scores = {r.doc_id: [] for r in df.collect()}
    for r in C.score_documents(df, model).collect():
        scores[r.doc_id].append(r.score)
    kept = C.accepted(df, model)
    assert kept.columns == df.columns
    assert kept.count() == sum(s >= C.THRESHOLD for many in scores.values() for s in many)
    assert C.accepted(documents([]), model).collect() == []
    assert C.score_documents(documents([]), model).collect() == []
