"""Benchmark passages in documents, found by SimHash and verified by shingles.

A window of an item's size gets a SimHash fingerprint of its weighted shingles, if
it shares enough letters with that item to reach the similarity. Two steps tell
this beforehand, and neither loses a match. A match shares one of the item's
rarest shingles at least, those that together weigh more than what a match may
lack; only items met that way are looked at. One running sum per document and
item then counts the letters that each window shares with it.

Fingerprints are cut into one block more than the radius: two within the radius
agree in one block at least, so joining windows and items on their blocks finds
all of them. What is found is verified by the exact weighted similarity of
shingles.

A shingle enters the fingerprint with the root of its weight. The cosine of two
windows of similarity 0.8 is then 0.889 or more, so that each of the 64 bits
differs with a probability of 0.152 at most, and a radius of 24 loses about three
in a million of the pairs at the very limit.

All steps are built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardframe.llm.common import closed, let, opened, quoted, stored

WORDS_PER_SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 24
# Roots of weights are rounded to such parts, so that sums do not depend on their order.
ROOT_PARTS = 1024
# Items and the shingles that documents share with them meet by such blocks of places.
PLACES_PER_BLOCK = 64
# Bits of the map of documents that have a window: 512 rows of 4 KB.
MAP_BITS = 1 << 24
WORD = r"[\p{L}\p{N}]+"


def _words(body: Column) -> Column:
    """The runs of letters and digits, in lower case."""
    return F.regexp_extract_all(F.lower(F.coalesce(body, F.lit(""))), F.lit(WORD), F.lit(0))


def _shingles(hashes: Column) -> Column:
    """One hash per five neighbouring words; none of fewer."""
    places = F.sequence(F.lit(0), F.size(hashes) - WORDS_PER_SHINGLE)
    none = F.array().cast("array<bigint>")
    one = lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WORDS_PER_SHINGLE)])
    return F.when(F.size(hashes) >= WORDS_PER_SHINGLE, F.transform(places, one)).otherwise(none)


def _weighted_shingles(hashes: Column, sizes: Column) -> Column:
    """The distinct shingles as (h, w); a shingle weighs as many as it has letters."""

    def weigh(h: Column, at: Column) -> Column:
        letters = [F.get(sizes, at + k) for k in range(WORDS_PER_SHINGLE)]
        return F.struct(h.alias("h"), sum(letters[1:], letters[0]).alias("w"))

    return F.array_distinct(F.transform(_shingles(hashes), weigh))


def _total(shingles: Column) -> Column:
    return F.aggregate(shingles, F.lit(0).cast("long"), lambda acc, s: acc + s["w"])


def fingerprint(hashes: Column, weights: Column | None = None) -> Column:
    """64 bits: for each, whether the hashes with it weigh more than those without."""
    weights = F.transform(hashes, lambda _: F.lit(1).cast("long")) if weights is None else weights
    total = F.aggregate(weights, F.lit(0).cast("long"), lambda acc, w: acc + w)

    def of(x: Column) -> Column:
        def bit(b: Column) -> Column:
            having = F.aggregate(
                x["pairs"],
                F.lit(0).cast("long"),
                lambda acc, p: acc + F.getbit(p["hashes"], b) * p["weights"],
            )
            return F.when(2 * having > x["total"], F.lit(1)).otherwise(F.lit(0)).cast("long")

        return F.aggregate(
            F.sequence(F.lit(63), F.lit(0)),
            F.lit(0).cast("long"),
            lambda acc, b: F.shiftleft(acc, 1).bitwiseOR(bit(b)),
        )

    pairs = F.arrays_zip(hashes.alias("hashes"), weights.alias("weights"))
    return let(F.struct(pairs.alias("pairs"), total.alias("total")), of)


def _printed(hashes: Column, sizes: Column) -> Column:
    """(own, print): the weighted shingles of a list of words, and their fingerprint."""
    root = lambda s: F.round(F.sqrt(s["w"]) * ROOT_PARTS).cast("long")
    of = lambda s: fingerprint(F.transform(s, lambda x: x["h"]), F.transform(s, root))
    return let(_weighted_shingles(hashes, sizes), lambda s: F.struct(s.alias("own"), of(s).alias("print")))


def _blocks(radius: int) -> Column:
    """(block, value) for each of radius + 1 parts of ``print``, as even as can be."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    parts = []
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        value = F.shiftrightunsigned(F.col("print"), a).bitwiseAND((1 << (b - a)) - 1)
        parts.append(F.struct(F.lit(i).alias("block"), value.alias("value")))
    return F.explode(F.array(*parts))


def benchmark_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Rows (item, of, n, own, print) of items with five words or more.

    ``of`` stands for the words of an item; equal items are looked for once.
    """
    rows = benchmark.select(quoted(id_col).alias("item"), _words(quoted(text_col)).alias("words"))
    hashed = rows.select(
        "item",
        F.size("words").alias("n"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
        F.transform("words", lambda w: F.char_length(w)).alias("sizes"),
    ).filter(F.col("n") >= WORDS_PER_SHINGLE)
    printed = hashed.select("item", F.xxhash64("hashes").alias("of"), "n", _printed(F.col("hashes"), F.col("sizes")).alias("x"))
    return printed.select("item", "of", "n", "x.*").distinct()


def _rare(shingles: DataFrame, similarity: float) -> DataFrame:
    """The rows of ``shingles`` (of, n, total, h, w) that one shared shingle at least of any match is among.

    A match lacks ``1 - similarity`` of the item's weight at most. Of each item
    those shingles stay that the fewest items have, until they weigh more.
    """
    holders = shingles.groupBy("h").agg(F.count("*").alias("holders"))
    upto = Window.partitionBy("of").orderBy("holders", "h").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("w").over(upto), F.lit(0))
    may_lack = (1 - similarity) * F.col("total") + 1e-6
    ranked = shingles.join(holders, "h").withColumn("before", before)
    return ranked.filter(F.col("before") <= may_lack).select("of", "n", "h")


def _runs(rows: DataFrame, shingles: DataFrame, similarity: float) -> DataFrame:
    """Rows (doc, of, n, start, next): runs of windows that share enough with an item.

    ``rows`` holds ``doc`` and ``body``. Windows from ``start`` to before ``next``
    share the same weight. A shared shingle counts for the windows from the one
    that ends with it to the one that starts with it. Items and shared shingles
    meet by blocks of places, so a document that holds very many items is no
    more work than as many documents.
    """
    hashes = F.transform(_words(F.col("body")), lambda w: F.xxhash64(w))
    # An outer explode has no condition that the planner would compute beforehand.
    placed = rows.select("doc", F.posexplode_outer(let(hashes, _shingles))).select(
        "doc", F.col("pos").alias("at"), F.col("col").alias("h")
    )
    # The documents come first: a shingle that very many of them share may then be split.
    shared = stored(placed.join(shingles.select("h").distinct(), "h").distinct(), "shared-shingles")
    block = lambda at: F.floor(at / PLACES_PER_BLOCK)
    reach = F.sequence(block(F.col("at") - F.col("n")), block(F.col("at") + F.col("n")))
    met = (
        shared.join(_rare(shingles, similarity), "h")
        .select("doc", "of", F.explode(reach).alias("block"))
        .distinct()
    )
    common = (
        shared.withColumn("block", block(F.col("at"))).join(met, ["doc", "block"]).join(shingles, ["of", "h"])
    )
    begins = F.struct((F.col("at") + WORDS_PER_SHINGLE - F.col("n")).alias("start"), F.col("w").alias("w"))
    ends = F.struct((F.col("at") + 1).alias("start"), (-F.col("w")).alias("w"))
    steps = (
        common.select("doc", "of", "n", "total", F.explode(F.array(begins, ends)).alias("x"))
        .groupBy("doc", "of", "n", "total", "x.start")
        .agg(F.sum("x.w").alias("w"))
    )
    along = Window.partitionBy("doc", "of").orderBy("start")
    lasting = steps.select(
        "doc",
        "of",
        "n",
        "total",
        "start",
        F.sum("w").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("shares"),
        F.lead("start").over(along).alias("next"),
    )
    # Sums are whole numbers; the small allowance is for the product with the similarity.
    enough = (F.col("shares") > 0) & (F.col("shares") >= F.col("total") * similarity - 1e-6)
    return lasting.filter(enough).select("doc", "of", "n", "start", "next")


def _listed(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` with ``listed``: whether their ``doc`` may be among ``keys``.

    It is for all that are, and for few others. The keys become one bit each of a
    map of 2 MB, whatever their number, which every task gets; so only the rows
    that are listed have to meet the keys, not the whole table.
    """
    bit = lambda: F.pmod(F.xxhash64("doc"), F.lit(MAP_BITS))
    marks = keys.groupBy(F.bitmap_bucket_number(bit()).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit())).alias("marks")
    )
    at = F.bitmap_bit_position(bit())
    byte = F.conv(F.hex(F.substring(F.col("marks"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    listed = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    marked = rows.withColumn("part", F.bitmap_bucket_number(bit())).join(F.broadcast(marks), "part", "left")
    return marked.withColumn("listed", listed).drop("part", "marks")


def _windows(rows: DataFrame, shingles: DataFrame, similarity: float) -> DataFrame:
    """Rows (doc, of, start, n, own, print): windows that share enough with the item ``of``.

    A window that would reach beyond its document ends there.
    """
    per_document = stored(
        _runs(rows, shingles, similarity)
        .groupBy("doc")
        .agg(F.collect_list(F.struct("of", "start", "next", "n")).alias("runs")),
        "runs",
    )

    def cut(words: Column) -> Column:
        first = lambda at: F.greatest(at, F.lit(0))

        def of_run(run: Column) -> Column:
            return F.transform(
                F.sequence(run["start"], run["next"] - 1),
                lambda at: F.struct(
                    run["of"].alias("of"),
                    at.alias("start"),
                    run["n"].alias("n"),
                    F.slice(words["hashes"], first(at) + 1, at + run["n"] - first(at)).alias("hashes"),
                    F.slice(words["sizes"], first(at) + 1, at + run["n"] - first(at)).alias("sizes"),
                ),
            )

        return F.flatten(F.transform("runs", of_run))

    def hashed(words: Column) -> Column:
        return F.struct(
            F.transform(words, lambda w: F.xxhash64(w)).alias("hashes"),
            F.transform(words, lambda w: F.char_length(w)).alias("sizes"),
        )

    # Repeated documents have the same windows; one of them is enough. The number
    # of tasks is stated, as few bytes are much work here.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = _listed(rows, per_document).filter("listed").drop("listed").dropDuplicates(["doc"]).repartition(tasks, "doc")
    found = texts.join(per_document.repartition(tasks, "doc").hint("merge"), "doc")
    windows = found.select("doc", F.explode_outer(let(let(_words(F.col("body")), hashed), cut)).alias("x"))
    return windows.select(
        "doc", "x.of", "x.start", "x.n", _printed(F.col("x.hashes"), F.col("x.sizes")).alias("y")
    ).select("doc", "of", "start", "n", "y.*")


def candidates(windows: DataFrame, texts: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Rows (doc, of, start) of windows whose fingerprint is within the radius of their item's."""
    keyed = windows.select("doc", "of", "start", "print", _blocks(radius).alias("key"))
    keyed_texts = texts.select("of", "print", _blocks(radius).alias("key")).withColumnRenamed("print", "its_print")
    near = F.bit_count(F.col("print").bitwiseXOR(F.col("its_print"))) <= radius
    return keyed.join(keyed_texts, ["of", "key"]).filter(near).select("doc", "of", "start").distinct()


def item_shingles(texts: DataFrame) -> DataFrame:
    """Rows (of, n, total, h, w), one per shingle of each text of the benchmark."""
    total = _total(F.col("own")).alias("total")
    return texts.select("of", "n", total, F.explode("own").alias("s")).select("of", "n", "total", "s.*")


def benchmark_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Rows (id, version, item, start, n_words, similarity): the best window of each match.

    Words are runs of letters and digits in lower case, so case and punctuation
    do not hide a passage. ``version`` is the hash of the text that has it.
    Items and documents of fewer than five words, null and empty texts match
    nothing. A similarity of exactly the least is a match. Of equally good
    windows the first counts. Repeated documents match alike and give one row;
    so do repeated items. Other columns are not looked at; an empty table on
    either side gives an empty table.
    """
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("body"))
    # A struct equals another with a null in the same place.
    rows = rows.select(F.struct("id", F.xxhash64("body").alias("version")).alias("doc"), "body")
    items = stored(benchmark_items(benchmark, item_col, item_text_col), "items")
    texts = stored(items.drop("item").dropDuplicates(["of"]), "item-texts")
    shingles = stored(item_shingles(texts), "item-shingles")
    windows = stored(_windows(rows, shingles, similarity), "windows")
    its = texts.select("of", F.col("own").alias("its"))
    worded = windows.join(candidates(windows, texts, radius), ["doc", "of", "start"]).join(its, "of")
    alike = _total(F.array_intersect("own", "its")) / F.greatest(_total(F.array_union("own", "its")), F.lit(1))
    scored = worded.select("doc", "of", "start", "n", alike.alias("similarity"))
    found = scored.filter(F.col("similarity") >= similarity).join(items.select("of", "item"), "of")
    best = F.min(F.struct((-F.col("similarity")).alias("worst"), F.col("start"), F.col("n")))
    return (
        found.groupBy("doc", "item")
        .agg(best.alias("best"))
        .select(
            F.col("doc.id").alias(id_col),
            F.col("doc.version").alias("version"),
            F.col("item").alias(item_col),
            F.greatest(F.col("best.start"), F.lit(0)).alias("start"),
            F.col("best.n").alias("n_words"),
            (-F.col("best.worst")).alias("similarity"),
        )
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage, with all columns.

    Null and empty texts, and texts of fewer than five words, stay. A row goes
    for its own text: another row of the same id stays, repeated rows go or stay
    alike. With an empty benchmark all rows stay; an empty table stays empty.
    """
    matches = benchmark_matches(docs, benchmark, similarity, radius, id_col, text_col)
    key = F.struct(quoted(id_col).alias("id"), "version").alias("doc")
    bad = stored(matches.select(key).distinct(), "contaminated")
    rows = opened(docs, id_col, text_col)
    rows = _listed(rows.withColumn("doc", F.struct("id", F.xxhash64("body").alias("version"))), bad)
    doubtful = rows.filter("listed").join(bad.hint("merge"), "doc", "left_anti")
    clean = rows.filter(~F.col("listed")).unionByName(doubtful.select(*rows.columns))
    return closed(clean, docs, id_col, text_col, {})
