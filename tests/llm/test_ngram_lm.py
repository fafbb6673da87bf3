import collections
import itertools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from wardframe.llm import ngram_lm as N
from wardframe.llm import wordbytes
from wardframe.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), "\n"]


class BruteForce:
    def __init__(self, texts):
        self.words, self.pairs = collections.Counter(), collections.Counter()
        for text in texts:
            w = tokens(text)
            self.words.update(w)
            self.pairs.update(zip([None, *w], w))
        self.total, self.size = sum(self.words.values()), len(self.words)
        self.before = collections.Counter(b for _, b in self.pairs)
        self.follow = collections.defaultdict(lambda: [0, 0, 0, 0])
        for (a, _), n in self.pairs.items():
            self.follow[a][0] += n
            self.follow[a][min(n, 3)] += 1
        self.d2 = N.discounts([sum(n == k for n in self.pairs.values()) for k in (1, 2, 3, 4)])
        self.d1 = N.discounts([sum(n == k for n in self.before.values()) for k in (1, 2, 3, 4)])
        self.taken = sum(self.d1[min(n, 3) - 1] for n in self.before.values())

    def lower(self, w):
        types = len(self.pairs)
        if not types:
            return 1 / (self.size + 1)
        left = self.taken / types
        n = self.before.get(w, 0)
        return (max(n - self.d1[min(n, 3) - 1], 0) / types if n else 0) + left / (self.size + 1)

    def of(self, a, w):
        if a not in self.follow:
            return self.lower(w)
        total, *seen = self.follow[a]
        n = self.pairs.get((a, w), 0)
        own = max(n - self.d2[min(n, 3) - 1], 0) / total if n else 0
        return own + sum(d * k for d, k in zip(self.d2, seen)) / total * self.lower(w)

    def score(self, text):
        w = tokens(text)
        known = [self.words.get(x, 0) for x in w]
        base = sum(math.log10((c + 0.1) / (self.total + 0.1 * (self.size + 1))) for c in known)
        return len(w), sum(c > 0 for c in known), base, sum(math.log10(self.of(a, b)) for a, b in zip([None, *w], w))


def check(spark, documents, train, rows, **layout):
    folder = scratch_path(spark, "ngram-test")
    summary = N.train(documents(list(enumerate(train))), folder, **layout)
    model = BruteForce(train)
    assert (summary.tokens, summary.vocabulary) == (model.total, model.size)
    found = N.score_documents(documents(rows), folder, summary).collect()
    got = sorted((r.doc_id or 0, r.n_tokens, r.n_known, r.base_score, r.score) for r in found)
    want = sorted((i or 0, *model.score(t)) for i, t in rows)
    for a, b in zip(got, want, strict=True):
        assert a == pytest.approx(b, rel=1e-9, abs=1e-9)
    return model


ODD = ["a b a b A B", "the the the", None, "", " \t\x0b\x0c\r\n", "é É ÄB äb", "x " * 700, "x\xa0y", "w" * 9000]


def test_scores_of_odd_texts(spark, documents):
    rows = list(enumerate([*ODD, "unknown words here", "a unknown b", "x" * 20_000])) + [(None, "a b"), (0, ODD[0])]
    check(spark, documents, ODD * 2, rows)


def test_scores_of_the_table(spark, documents, texts):
    train = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10]
    model = check(spark, documents, train, list(texts.items()))
    assert min(model.d2) > 0 and model.d2 != N.FALLBACK


@pytest.mark.parametrize("spare", [1, 3])
def test_ids_beyond_32_bits(spark, documents, texts, spare):
    train = [*ODD, *list(texts.values())[:80]]
    check(spark, documents, train, [*enumerate(ODD), *list(texts.items())[60:110], (0, "never seen")], spare=spare)


@pytest.mark.parametrize("words, spare", [(0, 0), (2**32 - 2, 0), (2**32 - 1, 1), (2**33 - 2, 1), (2**36, 5)])
def test_ids_and_keys_of_any_vocabulary(words, spare):
    ids = N.Ids.of(words)
    assert ids.spare == spare and ids.unknown >= words
    some = [0, 1, 5, words // 3, max(words - 1, 0), ids.unknown, ids.begin]
    before, after = (np.array(x, np.uint64) for x in zip(*itertools.product(some, some)))
    keys, parts = ids.keys(before, after)
    assert parts.max() < ids.parts
    distinct = {(int(a), int(b)) for a, b in zip(before, after)}
    assert len({(int(k), int(p)) for k, p in zip(keys, parts)}) == len(distinct)
    for k, p, a, b in zip(keys, parts, before, after):
        first, second = ids.pairs(np.array([k]), int(p))
        assert (first[0], second[0]) == (a, b)


def test_probabilities_sum_to_one(texts):
    model = BruteForce(list(texts.values())[:60])
    for a in [None, "the", "\n", "never seen"]:
        every = sum(model.of(a, w) for w in model.words) + model.of(a, "unknown")
        assert every == pytest.approx(1)


def test_a_large_count_is_exact(spark, documents):
    check(spark, documents, ["again " * 40_000, "again once"], [(1, "again again once"), (2, "once again")])


def test_empty_tables(spark, documents):
    check(spark, documents, [], [(1, "any words"), (2, None)])
    folder = scratch_path(spark, "ngram-test")
    summary = N.train(documents([(1, "a b")]), folder)
    assert N.score_documents(documents([]), folder, summary).collect() == []


def test_training_leaves_out_a_tenth_and_keeps_null_ids(documents):
    df = documents([(i, "x") for i in range(200)] + [(None, "x")])
    kept = {r.doc_id for r in N.training_part(df).collect()}
    assert kept == {i for i in range(200) if zlib.crc32(str(i).encode()) % 10} | {None}


def test_a_folder_that_cannot_be_mapped_is_refused(documents):
    with pytest.raises(ValueError, match="mounted"):
        N.train(documents([]), "hdfs://host/model")


def test_word_hashes_tell_words_apart():
    words = [f"{p}{'x' * n}" for p in ("", "a", "b", "é") for n in range(40)] + ["y" * 5000, "y" * 5001]
    words = [w for w in words if w]
    hashes, upto = wordbytes.word_hashes(pa.array([" ".join(words), "\n".join(words), None, *words]))
    n = len(words)
    assert len(set(hashes[:n].tolist())) == n
    assert hashes[:n].tolist() == hashes[n : 2 * n].tolist() == hashes[2 * n :].tolist()
    assert upto[:4].tolist() == [0, n, 2 * n, 2 * n]
