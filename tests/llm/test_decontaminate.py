import re

import pytest
from pyspark.sql import functions as F

from wardframe.llm import decontaminate as D

WORD = re.compile(r"[^\W_]+")


def words(text):
    return WORD.findall((text or "").lower())


def shingles(w):
    return {tuple(w[k : k + 5]): sum(map(len, w[k : k + 5])) for k in range(len(w) - 4)}


def brute_force(rows, items, least=0.8):
    """The best similarity of each document and item over all windows of the item's size."""
    found = {}
    for doc, text in rows:
        w = words(text)
        for item, its_text in items:
            its = words(its_text)
            target = shingles(its)
            if not target:
                continue
            for start in range(-len(its) + 5, len(w)):
                own = shingles(w[max(start, 0) : start + len(its)])
                if own.keys() & target.keys():
                    common = sum(n for s, n in own.items() if s in target)
                    similarity = common / sum({**own, **target}.values())
                    if similarity >= least:
                        found[doc, item] = max(found.get((doc, item), 0), similarity)
    return found


PASSAGE = " ".join(f"passage{i} of{i % 7}" for i in range(20))
SHORT = "seven words that make up this item"
ITEMS = [(1, PASSAGE), (2, SHORT), (3, "four words are few"), (4, None), (5, ""), (1, PASSAGE), (6, PASSAGE + " and one more thing")]


def around(text):
    return " ".join(f"before{i}" for i in range(30)) + " " + text + " " + " ".join(f"after{i}" for i in range(30))


def without(text, at):
    w = text.split()
    return " ".join(w[:at] + w[at + 1 :])


def changed(text, at):
    w = text.split()
    return " ".join([*w[:at], "other", *w[at + 1 :]])


ROWS = [
    (1, around(PASSAGE)),
    (2, around(PASSAGE.upper().replace(" ", ", "))),
    (3, around(changed(PASSAGE, 20))),
    (4, around(changed(PASSAGE, 0))),
    (5, around(changed(changed(PASSAGE, 8), 30))),
    (6, around(without(PASSAGE, 39))),
    (7, around(without(PASSAGE, 20))),
    (8, PASSAGE),
    (9, SHORT),
    (10, around(SHORT) + " " + around(SHORT)),
    (11, around("seven words that make up")),
    (12, None),
    (13, ""),
    (14, "few words only"),
    (15, around(PASSAGE) + " " + SHORT),
    (16, " ".join(PASSAGE.split()[:35])),
    (17, " ".join(f"long{i}" for i in range(30_000)) + " " + PASSAGE),
    (None, SHORT),
    (8, PASSAGE),
    (9, "another text with the same id"),
]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_matches_equal_brute_force(documents, benchmark):
    found = D.benchmark_matches(documents(ROWS), benchmark).collect()
    got = {(r.doc_id, r.item_id): r.similarity for r in found}
    assert len(got) == len(found)
    assert got == pytest.approx(brute_force(ROWS, ITEMS))
    assert {d for d, _ in got} >= {1, 2, 8, 9, 10, 15, 17, None}


def test_clean_rows_stay_whole(documents, benchmark):
    df = documents(ROWS)
    kept = D.decontaminate(df, benchmark)
    bad = {(d, t) for d, t in ROWS for i, _ in ITEMS if (d, i) in brute_force([(d, t)], ITEMS)}
    assert kept.columns == df.columns
    rows = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert rows == sorted((r for r in ROWS if r not in bad), key=repr)


def test_empty_tables(documents, benchmark):
    assert D.benchmark_matches(documents([]), benchmark).collect() == []
    assert D.decontaminate(documents(ROWS), benchmark.filter("false")).count() == len(ROWS)


def test_blocks_find_every_fingerprint_within_the_radius(spark):
    df = spark.range(4000).select((F.xxhash64("id")).alias("a"))
    flips = F.lit(0).cast("long")
    for k in range(D.RADIUS):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.pmod(F.xxhash64("a", F.lit(k)), F.lit(64))).cast("int"))
        flips = flips.bitwiseOR(bit)
    pairs = df.select("a", F.col("a").bitwiseXOR(flips).alias("b")).filter(
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= D.RADIUS
    )
    one = pairs.select("a", "b", F.col("a").alias("print")).select("a", "b", D._blocks(D.RADIUS).alias("key"))
    other = pairs.select("a", "b", F.col("b").alias("print")).select("a", "b", D._blocks(D.RADIUS).alias("key"))
    assert one.join(other, ["a", "b", "key"]).select("a").distinct().count() == 4000


def test_a_large_benchmark_of_one_size_is_pruned(spark, documents):
    # 10,000 items of 24 words, of which 12 are the same in all and 4 more in a hundred each.
    def item(i):
        own = [f"own{i}a", f"own{i}b", f"own{i}c", f"own{i}d", f"own{i}e", f"own{i}f", f"own{i}g", f"own{i}h"]
        return " ".join([*(f"common{k}" for k in range(12)), *(f"group{i % 100}x{k}" for k in range(4)), *own])

    items = spark.createDataFrame([(i, item(i)) for i in range(10_000)], "item_id long, text string")
    rows = [(i, around(item(37 * i))) for i in range(60)]
    rows += [(100 + i, around(changed(item(11 * i), 3))) for i in range(60)]
    rows += [(200 + i, around(" ".join(item(i).split()[:16]))) for i in range(60)]
    texts = D.benchmark_items(items).drop("item").cache()
    shingles = D.item_shingles(texts).cache()
    docs = documents(rows).selectExpr("struct(doc_id as id, xxhash64(text) as version) as doc", "text as body")
    windows = D._windows(docs, shingles, 0.8).cache()
    # Of a document with one passage, a few windows meet one item each; all others meet none.
    assert windows.select("doc").distinct().count() <= 120
    assert windows.count() <= 120 * 8
    assert D.candidates(windows, texts).count() <= 120 * 8
    found = {(r.doc_id, r.item_id) for r in D.benchmark_matches(documents(rows), items).collect()}
    want = {(i, 37 * i) for i in range(60)}
    some = [(i, item(i)) for i in range(0, 660, 11)]
    want |= {k for k in brute_force(rows[60:120], some)}
    assert want == found


def test_a_similarity_of_exactly_the_least_counts(spark, documents):
    # Nine of ten shingles are shared and one more is in either: 9 / 11, then the same as the limit.
    text = " ".join(f"w{i:02d}" for i in range(14))
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    docs = documents([(1, changed(text, 0))])
    exact = brute_force([(1, changed(text, 0))], [(1, text)])[1, 1]
    for least, expected in ((exact, 1), (exact + 1e-9, 0)):
        assert D.benchmark_matches(docs, items, similarity=least).count() == expected


def test_documents_that_hold_very_many_items(spark, documents):
    items = [(i, f"item {i} with seven words of {i * i} own") for i in range(300)]
    rows = [(1, " ".join(t for _, t in items)), (2, " ".join(t for _, t in items[::-1])), (3, None)]
    found = D.benchmark_matches(documents(rows), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == set(brute_force(rows, items))


def test_fingerprint_is_the_majority_of_each_bit(spark):
    rows = spark.createDataFrame([([1, 3, 2],), ([-1],), ([],)], "h array<long>")
    found = [r[0] for r in rows.select(D.fingerprint(F.col("h"))).collect()]
    assert found == [3, -1, 0]


def test_no_python_in_the_plan(spark, folder):
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    assert "Python" not in D.benchmark_matches(docs, items)._jdf.queryExecution().toString()


def test_parts_in_another_order_are_found(documents, benchmark):
    # The window that holds both parts lines up with the item in none of its shared shingles.
    w = PASSAGE.split()
    rows = [
        (i, around(" ".join(w[at:] + w[:at])))
        for i, at in enumerate((1, 3, 20, 37))
    ]
    rows.append((9, around(" ".join(w[13:26] + w[:13] + w[26:]))))
    rows.append((10, around(" ".join(w[20:] + ["between"] + w[:20]))))
    found = D.benchmark_matches(documents(rows), benchmark).collect()
    want = brute_force(rows, ITEMS)
    assert {(r.doc_id, r.item_id): r.similarity for r in found} == pytest.approx(want)
    assert (2, 1) in want


def edited(text, least=0.8):
    """The text with as many words replaced at its start, or its end, as keep the similarity."""
    w = text.split()
    for turn in (lambda x: x, lambda x: x[::-1]):
        last = None
        for k in range(1, len(w)):
            cut = " ".join(turn([f"edit{j}" for j in range(k)] + turn(w)[k:]))
            if not brute_force([(0, around(cut))], [(0, text)], least):
                break
            last = cut
        if last:
            yield last


def test_items_edited_at_their_ends_are_all_found(spark, documents, folder):
    rows = spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()
    of_rows = [(r.item_id, t) for r in rows for t in edited(r.text or "")]
    docs = [(n, around(t)) for n, (_, t) in enumerate(of_rows)]
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = D.benchmark_matches(documents(docs), items).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert docs and {(n, i) for n, (i, _) in enumerate(of_rows)} <= got
