"""Each stage of the pipeline on the output of the one before it, against plain versions."""

import hashlib
import itertools

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from tests.llm.test_decontaminate import brute_force as contaminated
from tests.llm.test_line_dedup import expected as without_lines
from wardframe.llm import classifier, minhash
from wardframe.llm.queries import tokenizer


@pytest.fixture(scope="module")
def outputs(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = [docs]
    for _, stage in P.STAGES:
        docs = P.stored(stage(spark, docs, folder), "stage")
        found.append(docs)
    return found


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_are_the_named_ones_and_keep_the_columns(outputs):
    assert len(P.STAGES) == 5
    for df in outputs[:5]:
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(r.n_chars == len(r.text) for df in outputs[:5] for r in df.collect())


def test_the_classifier_drops_what_scores_low(spark, folder, outputs):
    model = classifier.train(outputs[0], spark.read.parquet(f"{folder}/labels.parquet"))
    scores = classifier.score_documents(outputs[0], model).collect()
    want = {r.doc_id for r in scores if r.score >= classifier.THRESHOLD}
    assert set(texts(outputs[1])) == want
    assert 0 < len(want) < len(scores)


def test_lines_go(outputs):
    want = {i: t for i, t, _, _ in without_lines(list(texts(outputs[1]).items()))}
    assert texts(outputs[2]) == want


def test_one_of_each_class_stays(outputs):
    rows = sorted(texts(outputs[2]).items())
    idf = minhash.inverse_frequencies(outputs[2])
    vectors = minhash._vectors(pa.array([t for _, t in rows]), idf)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        alike = rows[i][1] == rows[j][1] or minhash.weighted_jaccard(vectors[i], vectors[j]) >= 0.8
        if alike:
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    assert set(texts(outputs[3])) == {rows[i][0] for i in range(len(rows)) if find(i) == i}


def test_contaminated_documents_go(spark, folder, outputs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    before = texts(outputs[3])
    bad = {d for d, _ in contaminated(list(before.items()), items)}
    assert bad and set(texts(outputs[4])) == set(before) - bad


def test_ids_are_the_librarys(outputs):
    library = Tokenizer.from_file(tokenizer())
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for i, text in texts(outputs[4]).items():
        ids = library.encode(text, add_special_tokens=False).ids
        want.add((i, len(ids), digest(",".join(map(str, ids))), digest(text)))
    assert set(map(tuple, outputs[5].collect())) == want


def test_run_is_all_stages(spark, folder, outputs):
    assert sorted(map(tuple, P.run(spark, folder).collect())) == sorted(map(tuple, outputs[5].collect()))


def test_every_stage_takes_odd_and_empty_tables(spark, folder, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "x " * 40_000, None, "s", 1), (1, "", "en", "s", 0)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in P.STAGES:
            docs = P.stored(stage(spark, docs, folder), "stage")
        assert docs.columns[0] == "doc_id"
        if not rows:
            assert docs.collect() == []
