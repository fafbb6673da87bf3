"""Near duplicates by consistent weighted sampling of TF-IDF shingles.

A text is a vector of five-word shingles. A shingle weighs its count times the
mean inverse document frequency of its words, so what is common everywhere
says little. Improved consistent weighted sampling draws one shingle per
sample such that two texts draw the same one with the probability of their
weighted Jaccard similarity. Bands of samples give candidates, and each
candidate pair is verified by the exact weighted Jaccard similarity.

Equal texts are one node throughout. Within a bucket of a band, few texts are
compared with each other. In a large bucket a few centres are compared with all
others first, which joins most copies of one text. The texts of buckets that are
then still of several classes are joined on the rare shingles that two similar
ones must share; this finds every link that is left, without all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardframe.llm import wordbytes
from wardframe.llm.bpe import slices
from wardframe.llm.common import closed, opened, quoted, stored
from wardframe.llm.components import components
from wardframe.llm.wordbytes import mixed
from wardframe.llm.worker import serve

WORDS_PER_SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 14, 3
# Words are counted in this many cells: a table of fixed size, whatever the corpus.
CELLS = 1 << 20
# Texts of one bucket that are all compared with each other, and how many are
# compared with all others in a larger one.
ALL_PAIRS = 32
CENTRES = 8
SLICE_BYTES = 1 << 19

_MULTIPLIERS = np.array(
    [
        0x9E3779B97F4A7C15,
        0xC2B2AE3D27D4EB4F,
        0x165667B19E3779F9,
        0xD6E8FEB86659FD93,
        0xA0761D6478BD642F,
    ],
    dtype=np.uint64,
)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and where each text's words end."""
    return wordbytes.word_hashes(pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string())))


def shingle_vector(words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles in ascending order and their weights.

    A text of fewer than five words has one shingle of all its words, a text
    without words none.
    """
    if not len(words):
        return np.empty(0, np.uint64), np.empty(0, np.float64)
    width = min(WORDS_PER_SHINGLE, len(words))
    count = len(words) - width + 1
    rare = idf[(words & np.uint64(CELLS - 1)).astype(np.int64)]
    shingles, weights = np.full(count, np.uint64(width)), np.zeros(count)
    for k in range(width):
        shingles += words[k : k + count] * _MULTIPLIERS[k]
        weights += rare[k : k + count]
    distinct, first, times = np.unique(mixed(shingles), return_index=True, return_counts=True)
    return distinct, times * weights[first] / width


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the lesser over sum of the greater weights; 0 where a vector is empty."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    lesser = np.minimum(a[1][at], b[1][bt]).sum()
    return float(lesser / (a[1].sum() + b[1].sum() - lesser))


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of Gamma(2, 1), 2^16 of them, and 2^20 of its logarithm.

    Draws come from tables, so every machine draws the same.
    """
    grid = np.concatenate([np.geomspace(1e-7, 1e-2, 50_000), np.linspace(0.0101, 30, 500_000)])
    upto = -np.expm1(-grid) - grid * np.exp(-grid)
    scale = np.interp((np.arange(1 << 16) + 0.5) / (1 << 16), upto, grid)
    offset = np.log(np.interp((np.arange(1 << 20) + 0.5) / (1 << 20), upto, grid))
    return scale.astype(np.float32), offset.astype(np.float32)


def samples(shingles: np.ndarray, weights: np.ndarray, ends: np.ndarray, count: int) -> np.ndarray:
    """One row per text and one column per sample: the drawn (shingle, level) as 64 bits.

    ``ends`` bounds each text's shingles; every text has at least one.
    """
    scale, offset = _tables()
    starts, sizes = ends[:-1], np.diff(ends)
    log_weight = np.log(weights).astype(np.float32)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    drawn = np.empty((len(sizes), count), np.uint64)
    # The same room for every sample: fresh arrays of this size cost more than the sums.
    h, part = np.empty_like(shingles), np.empty_like(shingles)
    score, level, shift = (np.empty(len(shingles), np.float32) for _ in range(3))

    def bits(above: int, mask: int) -> np.ndarray:
        np.right_shift(h, np.uint64(above), out=part)
        return np.bitwise_and(part, np.uint64(mask), out=part)

    for sample in range(count):
        np.add(shingles, np.uint64((sample + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF), out=h)
        for turn, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xBF58476D1CE4E5B9)):
            np.right_shift(h, np.uint64(turn), out=part)
            np.bitwise_xor(h, part, out=h)
            np.multiply(h, np.uint64(factor), out=h)
        # The upper 20, 16 and 24 bits of 60 draw the offset, the scale and the shift.
        r = scale[bits(28, 0xFFFF)]
        np.copyto(shift, bits(4, 0xFFFFFF))
        np.multiply(shift, np.float32(2.0**-24), out=shift)
        np.divide(log_weight, r, out=level)
        np.floor(np.add(level, shift, out=level), out=level)
        np.subtract(level, shift, out=score)
        np.multiply(np.add(score, np.float32(1), out=score), r, out=score)
        np.subtract(offset[bits(44, 0xFFFFF)], score, out=score)
        least = np.minimum.reduceat(score, starts)
        hit = np.flatnonzero(score == np.repeat(least, sizes))
        of_level = level[hit].astype(np.int64).astype(np.uint64) * _MULTIPLIERS[1]
        drawn[owner[hit], sample] = mixed(shingles[hit] + of_level)
    return drawn


def _cell_batches(batches) -> Iterator[pa.RecordBatch]:
    """Per task: in how many texts a word of each cell occurs, and the number of texts."""
    serve("minhash")
    counts, texts = np.zeros(CELLS, np.int64), 0
    for batch in batches:
        for a, b in slices(batch.column(0), SLICE_BYTES):
            hashes, ends = word_hashes(batch.column(0).slice(a, b - a))
            cell = (hashes & np.uint64(CELLS - 1)).astype(np.int32)
            once = [np.unique(cell[s:e]) for s, e in zip(ends, ends[1:])]
            counts += np.bincount(np.concatenate(once), minlength=CELLS)
            texts += b - a
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([[-1], used]).astype(np.int32)),
            pa.array(np.concatenate([[texts], counts[used]]).astype(np.int64)),
        ],
        names=["cell", "n"],
    )


def inverse_frequencies(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """ln((1 + texts) / (1 + texts with the cell)) + 1 for each of the CELLS cells.

    Every text of the corpus counts. The table that reaches the driver has a
    fixed size, however many words there are.
    """
    counts = docs.select(quoted(text_col)).mapInArrow(_cell_batches, "cell int, n long")
    found = counts.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cells, n = found["cell"].to_numpy(), found["n"].to_numpy()
    frequency = np.zeros(CELLS)
    frequency[cells[cells >= 0]] = n[cells >= 0]
    return np.log((1 + n[cells < 0].sum()) / (1 + frequency)) + 1


def _vectors(texts: pa.Array, idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    hashes, ends = word_hashes(texts)
    return [shingle_vector(hashes[s:e], idf) for s, e in zip(ends, ends[1:])]


def _signed(shared_idf, bands: int, rows: int):
    def run(batches):
        serve("minhash")
        idf = shared_idf.value
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE_BYTES):
                vectors = _vectors(batch.column(1).slice(a, b - a), idf)
                some = [i for i, v in enumerate(vectors) if len(v[0])]
                if not some:
                    continue
                shingles = np.concatenate([vectors[i][0] for i in some])
                weights = np.concatenate([vectors[i][1] for i in some])
                ends = np.cumsum([0, *(len(vectors[i][0]) for i in some)])
                drawn = samples(shingles, weights, ends, bands * rows)
                keys = np.empty((len(some), bands), np.uint64)
                for band in range(bands):
                    key = np.full(len(some), np.uint64(band + 1))
                    for k in range(rows):
                        key = mixed(key * _MULTIPLIERS[2] + drawn[:, band * rows + k])
                    keys[:, band] = key
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).take(pa.array(some)),
                        batch.column(2).slice(a, b - a).take(pa.array(some)),
                        pa.array([float(vectors[i][1].sum()) for i in some]),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(some) + 1, dtype=np.int32) * bands),
                            pa.array(keys.ravel().view(np.int64)),
                        ),
                    ],
                    names=["node", "pick", "weight", "keys"],
                )

    return run


def _verified(shared_idf, least: float):
    def run(batches):
        serve("minhash")
        idf = shared_idf.value
        kept: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        nodes = [(name, pa.binary()) for name in ("a", "b", "root_a", "root_b")]
        schema = pa.schema([*nodes, ("similarity", pa.float64())])

        def vector(node: bytes, text: str):
            if node not in kept:
                if len(kept) >= 256:
                    kept.clear()
                kept[node] = _vectors(pa.array([text]), idf)[0]
            return kept[node]

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                found = []
                columns = [c.to_pylist() for c in batch.slice(start, 256).columns]
                for a, b, text_a, text_b, root_a, root_b in zip(*columns):
                    similarity = weighted_jaccard(vector(a, text_a), vector(b, text_b))
                    if similarity >= least:
                        found.append(dict(zip(schema.names, (a, b, root_a, root_b, similarity))))
                yield pa.RecordBatch.from_pylist(found, schema=schema)

    return run


def _buckets(signed: DataFrame) -> DataFrame:
    """Rows (key, node, pick, weight, n, turn): buckets of two texts or more.

    ``pick`` is that of one of a text's copies.

    ``turn`` is spread evenly over 0 to ``n`` by a hash of text and key, so the
    first few turns are a few texts of any bucket, others in each band.
    """
    members = stored(
        signed.select("node", "pick", "weight", F.explode("keys").alias("key"))
        .groupBy("key", "node")
        .agg(F.min("pick").alias("pick"), F.min("weight").alias("weight")),
        "band-members",
    )
    shared = stored(
        members.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "shared-buckets"
    )
    spread = F.pmod(F.xxhash64("key", "node"), F.lit(1 << 40)) / float(1 << 40)
    return stored(members.join(shared, "key").withColumn("turn", spread * F.col("n")), "buckets")


def _side(rows: DataFrame, side: str) -> DataFrame:
    return rows.select(
        "key", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "weight", "shared", "root")]
    )


def _most(one: Column, other: Column, shared_one: Column, shared_other: Column) -> Column:
    """The greatest similarity that two weights and the parts they can share allow."""
    common = F.least(one, other, shared_one, shared_other)
    return common / (one + other - common)


def _pairs(members: DataFrame, partners: DataFrame, least: float) -> DataFrame:
    """Distinct (a, b, root_a, root_b): pairs of a bucket in different classes.

    Pairs that cannot be similar enough by their weights are left out.
    """
    most = _most(F.col("weight_a"), F.col("weight_b"), F.col("shared_a"), F.col("shared_b"))
    apart = F.col("root_a") != F.col("root_b")
    joined = _side(members, "a").join(_side(partners, "b"), "key")
    return _ordered(joined.filter(apart & (most >= least - 1e-9)))


def _ordered(joined: DataFrame) -> DataFrame:
    """Each pair once, the lesser node first."""
    turned = F.col("node_a") > F.col("node_b")
    return joined.select(
        F.when(turned, F.col("node_b")).otherwise(F.col("node_a")).alias("a"),
        F.when(turned, F.col("node_a")).otherwise(F.col("node_b")).alias("b"),
        F.when(turned, F.col("root_b")).otherwise(F.col("root_a")).alias("root_a"),
        F.when(turned, F.col("root_a")).otherwise(F.col("root_b")).alias("root_b"),
    ).distinct()


def _shingle_rows(shared_idf):
    def run(batches):
        serve("minhash")
        idf = shared_idf.value
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE_BYTES):
                vectors = _vectors(batch.column(1).slice(a, b - a), idf)
                nodes = batch.column(0).slice(a, b - a).to_numpy()
                sizes = [len(v[0]) for v in vectors]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(nodes, sizes)),
                        pa.array(np.concatenate([v[0] for v in vectors]).view(np.int64)),
                        pa.array(np.concatenate([v[1] for v in vectors])),
                    ],
                    names=["number", "shingle", "part"],
                )

    return run


def _shingles_of(members: DataFrame, bodies: DataFrame, shared_idf) -> DataFrame:
    """Rows (number, shingle, part): the weighted shingles of the texts of ``members``."""
    nodes = members.select("node").distinct()
    return stored(
        bodies.join(nodes, "node", "left_semi")
        .select(F.xxhash64("node").alias("number"), "body")
        .mapInArrow(_shingle_rows(shared_idf), "number long, shingle long, part double"),
        "shingles",
    )


def _with_shared(members: DataFrame, shingles: DataFrame) -> DataFrame:
    """Adds ``shared``: the weight of the shingles that another text of these buckets has too.

    In a large group of copies each text has edits of its own. Their weight
    bounds its similarity to all others, so most pairs need no comparison.
    """
    own = (
        shingles.groupBy("shingle")
        .agg(F.count("*").alias("n"), F.min("number").alias("number"), F.min("part").alias("part"))
        .filter("n = 1")
        .groupBy("number")
        .agg(F.sum("part").alias("own"))
    )
    numbered = members.withColumn("number", F.xxhash64("node"))
    joined = numbered.join(stored(own, "own-weights"), "number", "left")
    return joined.withColumn("shared", F.col("weight") - F.coalesce("own", F.lit(0.0))).drop("own")


def _pairs_by_prefix(members: DataFrame, shingles: DataFrame, least: float) -> DataFrame:
    """Distinct (a, b, root_a, root_b): all pairs of ``members`` that can still be links.

    Shingles are put in one order, rare ones first. At the first one that two
    similar texts share, neither can have passed more weight than it may differ
    by, so only such prefixes are joined, and only between classes: of the
    holders of a shingle those outside its largest class meet all others.
    """
    texts = members.select("number", "node", "root", "weight").distinct()
    held = stored(shingles.join(texts, "number"), "held")
    holders = held.groupBy("shingle").agg(
        F.count("*").alias("n"), F.min("root").alias("first_root"), F.max("root").alias("last_root")
    )
    earlier = Window.partitionBy("number").orderBy("n", "shingle").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.coalesce(F.sum("part").over(earlier), F.lit(0.0))
    ranked = held.join(stored(holders, "holders"), "shingle").withColumn(
        "left", F.col("weight") - passed
    )
    within = F.col("left") >= (least - 1e-9) * F.col("weight")
    prefix = stored(
        ranked.filter(within & (F.col("first_root") != F.col("last_root"))).select(
            "shingle", "node", "root", "weight", "left"
        ),
        "prefixes",
    )
    of_class = prefix.groupBy("shingle", "root").agg(F.count("*").alias("n"))
    largest = of_class.groupBy("shingle").agg(F.max(F.struct("n", "root")).alias("largest"))
    outside = prefix.join(stored(largest, "largest-classes"), "shingle").filter("root <> largest.root")
    names = ("node", "root", "weight", "left")
    one = prefix.select("shingle", *[F.col(c).alias(f"{c}_a") for c in names])
    other = outside.select("shingle", *[F.col(c).alias(f"{c}_b") for c in names])
    most = _most(F.col("weight_a"), F.col("weight_b"), F.col("left_a"), F.col("left_b"))
    apart = F.col("root_a") != F.col("root_b")
    return _ordered(one.join(other, "shingle").filter(apart & (most >= least - 1e-9)))


def _most_shared(members: DataFrame) -> DataFrame:
    """One text of each bucket: the one with the least part of its weight for itself."""
    own = 1 - F.col("shared") / F.col("weight")
    first = members.groupBy("key").agg(F.min(F.struct(own.alias("own"), "turn", "node")).alias("first"))
    return members.join(stored(first, "most-shared"), "key").filter("node = first.node").drop("first")


def _open(members: DataFrame, least: float) -> DataFrame:
    """Members that may still have a partner: in buckets of several classes, by their weights."""
    bucket = members.groupBy("key").agg(
        F.min("root").alias("first_root"),
        F.max("root").alias("last_root"),
        F.min("weight").alias("lightest"),
    )
    # The best partner is as light as what is shared, if the bucket has one as light.
    best = F.greatest(F.col("shared"), F.col("lightest"))
    most = _most(F.col("weight"), best, F.col("shared"), best)
    return (
        members.join(stored(bucket, "bucket-roots").filter("first_root <> last_root"), "key")
        .filter(most >= least - 1e-9)
        .drop("first_root", "last_root", "lightest")
    )


def _renamed(rows: DataFrame, renaming: DataFrame) -> DataFrame:
    """``root`` replaced by the root of its class."""
    later = renaming.select(F.col("node").alias("root"), F.col("root").alias("later"))
    return rows.join(later, "root", "left").withColumn("root", F.coalesce("later", "root")).drop("later")


def near_duplicate_links(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    all_pairs: int = ALL_PAIRS,
    centres: int = CENTRES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b, similarity) between different texts, and (node, root) of classes.

    A node is the MD5 of a text, 16 bytes. The links suffice to join every class;
    pairs that are already in one class are not verified again.
    """
    spark = docs.sparkSession
    body = F.coalesce(quoted(text_col), F.lit(""))
    pick = F.xxhash64(quoted(id_col))
    texts = docs.select(text_node(body).alias("node"), body.alias("body"), pick.alias("pick"))
    idf = spark.sparkContext.broadcast(inverse_frequencies(docs, text_col))
    signed = texts.mapInArrow(
        _signed(idf, bands, rows), "node binary, pick long, weight double, keys array<long>"
    )
    buckets = _buckets(signed)
    # One copy of each text, found by its pick, so that copies do not meet in one task.
    wanted = buckets.select("node", "pick").distinct()
    bodies = stored(
        texts.join(wanted, ["node", "pick"], "left_semi")
        .groupBy("node")
        .agg(F.first("body").alias("body")),
        "bodies",
    )

    def verified(pairs: DataFrame) -> DataFrame:
        # The pairs come first: a text with very many partners may then be split.
        with_a = pairs.join(bodies.withColumnsRenamed({"node": "a", "body": "body_a"}), "a")
        with_b = with_a.join(bodies.withColumnsRenamed({"node": "b", "body": "body_b"}), "b")
        return stored(
            with_b.select("a", "b", "body_a", "body_b", "root_a", "root_b").mapInArrow(
                _verified(idf, similarity),
                "a binary, b binary, root_a binary, root_b binary, similarity double",
            ),
            "verified",
        )

    alone = buckets.withColumn("root", F.col("node"))
    small = alone.filter(F.col("n") <= all_pairs).withColumn("shared", F.col("weight"))
    links = [verified(_pairs(small, small, similarity).filter("a < b"))]
    renamings = [_classes(links[0])]
    large = stored(_renamed(alone.filter(F.col("n") > all_pairs), renamings[0]), "large-buckets")
    if not large.isEmpty():
        shingles = _shingles_of(large, bodies, idf)
        large = stored(_open(stored(_with_shared(large, shingles), "shared"), similarity), "open")
        # First the text of least own weight, often what the others are copies of,
        # then a few more, then whatever pair is left.
        turn = F.col("turn") < centres
        rounds = (
            lambda: _pairs(large, _most_shared(large), similarity),
            lambda: _pairs(large, large.filter(turn), similarity),
            lambda: _pairs_by_prefix(large, shingles, similarity),
        )
        for pairs in rounds:
            if large.isEmpty():
                break
            links.append(verified(pairs()))
            renamings.append(_classes(links[-1]))
            if pairs is not rounds[-1]:
                left = stored(_renamed(large, renamings[-1]), "left")
                large = stored(_open(left, similarity), "open")

    found = links[0]
    for more in links[1:]:
        found = found.unionByName(more)
    nodes = found.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    classes = nodes.withColumn("root", F.col("node"))
    for renaming in renamings:
        classes = _renamed(classes, renaming)
    return found.select("a", "b", "similarity"), stored(classes, "classes")


def _classes(links: DataFrame) -> DataFrame:
    return stored(
        components(links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))), "renaming"
    )


def text_node(body):
    return F.unhex(F.md5(body.cast("binary")))


def _verdicts(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Per distinct text its class: (node, class_id, class_size, lead_id, lead_rows, leads).

    The lead of a class is its text with the least id; ``lead_rows`` says how
    many rows repeat that id and text.
    """
    per_row = rows.groupBy("node", "id").agg(F.count("*").alias("n"))
    # Null ids come after all others.
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "n")
    per_text = per_row.groupBy("node").agg(F.min(order).alias("own"), F.sum("n").alias("n"))
    rooted = stored(
        per_text.join(classes, "node", "left").withColumn("root", F.coalesce("root", "node")),
        "texts",
    )
    lead = F.struct(F.col("own.no_id"), F.col("own.id"), F.col("node"), F.col("own.n").alias("rows"))
    summary = rooted.groupBy("root").agg(F.min(lead).alias("lead"), F.sum("n").alias("class_size"))
    return stored(
        rooted.join(stored(summary, "class-names"), "root").select(
            "node",
            F.col("lead.id").alias("class_id"),
            "class_size",
            F.col("lead.rows").alias("lead_rows"),
            (F.col("node") == F.col("lead.node")).alias("leads"),
        ),
        "verdicts",
    )


def _with_verdicts(
    docs: DataFrame, id_col: str, text_col: str, **settings
) -> tuple[DataFrame, DataFrame]:
    _, classes = near_duplicate_links(docs, id_col=id_col, text_col=text_col, **settings)
    body = F.coalesce(F.col("body"), F.lit(""))
    rows = opened(docs, id_col, text_col).withColumn("node", text_node(body))
    return rows, _verdicts(rows, classes)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings
) -> DataFrame:
    """``docs`` with ``class_id``, ``class_size`` and ``is_first``, one row per row.

    A class holds the documents joined by chains of equal or similar texts, and
    is named by its least id. ``is_first`` marks the document with that id; if
    several texts of a class share it, the one with the least MD5. Settings are
    those of ``near_duplicate_links``.

    Equal texts are one class whatever they hold; a null text counts as empty.
    A text of fewer than five words has one shingle of all its words. Rows that
    repeat in id and text are marked alike. Null ids come after all others, and
    a class without any has a null name. Input columns with the name of a
    result are replaced. An empty table gives an empty table.
    """
    rows, verdicts = _with_verdicts(docs, id_col, text_col, **settings)
    joined = rows.join(verdicts, "node")
    is_first = F.col("leads") & F.col("id").eqNullSafe(F.col("class_id"))
    added = {"class_id": F.col("class_id"), "class_size": F.col("class_size"), "is_first": is_first}
    return closed(joined, docs, id_col, text_col, added)


def one_per_class(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings
) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` marks as first, one of each class.

    Of rows that repeat in id and text one stays; only if there are any is
    another pass made to choose it.
    """
    rows, verdicts = _with_verdicts(docs, id_col, text_col, **settings)
    leads = verdicts.filter("leads")
    kept = rows.join(leads, "node").filter(F.col("id").eqNullSafe(F.col("class_id")))
    if not leads.filter("lead_rows > 1").isEmpty():
        kept = kept.dropDuplicates(["node"])
    return closed(kept, docs, id_col, text_col, {})
