"""What filters remove together, alone and in every order.

The facts of a text come from one pass of a table-driven transducer over its
bytes: a byte leads to a state (in a gap, or in a word), and state and next byte
give the marks to write: word begins, word ends, capital, symbol, code point.
Counts are running sums of the marks. Word spans go into a hash table with open
addressing, all at once; a word counts as seen only if its bytes equal those of
the word in the slot, so a hash collision changes nothing.

All the rest is aggregation: documents become counts per part and set of failed
filters, 32 at most, and the orders are worked out from those.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wardframe.llm.bpe import slices
from wardframe.llm.common import quoted, stored
from wardframe.llm.wordbytes import bytes_of, mixed

# White space and symbols of the filters.
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#$%&*|"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 2
FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]

SLICE_BYTES = 2 << 20
BLOCK = 1 << 20
# Words beyond this many bytes are hashed and compared one by one.
LONG_WORD = 1024

BEGINS, ENDS, CAPITAL, SYMBOL, POINT = 1, 2, 4, 8, 16
GAP, WORD = 0, 1
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FIRST_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], np.uint64)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The state after each byte, and the marks for (state, byte)."""
    state = np.full(256, WORD, np.uint8)
    state[list(SPACES)] = GAP
    marks = np.zeros((2, 256), np.uint8)
    for byte in range(256):
        own = POINT if byte & 0xC0 != 0x80 else 0
        own |= CAPITAL if ord("A") <= byte <= ord("Z") else 0
        own |= SYMBOL if byte in SYMBOLS else 0
        marks[:, byte] = own
        if state[byte] == WORD:
            marks[GAP, byte] |= BEGINS
        else:
            marks[WORD, byte] |= ENDS
    return state, marks.ravel()


AFTER, MARKS = _tables()


def transduce(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts (capitals, symbols, code points) per text, and where words begin and end.

    Blocks hand on their last state, so a text may be of any length.
    """
    size, before = int(bounds[-1]), GAP
    counts = np.zeros((len(bounds) - 1, 3), np.int64)
    begins, ends = [], []
    for a in range(0, size, BLOCK):
        b = min(a + BLOCK, size)
        after = AFTER[raw[a:b]]
        state = np.empty(b - a, np.int64)
        state[0], state[1:] = before, after[:-1]
        before = after[-1]
        first, last = np.searchsorted(bounds, [a, b])
        # A text starts in a gap; a word that runs up to its end ends there.
        starts = bounds[first:last]
        open_end = starts[(starts > 0) & (state[starts - a] == WORD)]
        state[starts - a] = GAP
        marks = MARKS[(state << 8) | raw[a:b]]
        begins.append(np.flatnonzero(marks & BEGINS) + a)
        ends.append(np.union1d(np.flatnonzero(marks & ENDS) + a, open_end))
        inside = np.clip(bounds, a, b) - a
        for k, mark in enumerate((CAPITAL, SYMBOL, POINT)):
            upto = np.zeros(b - a + 1, np.int64)
            np.cumsum((marks & mark) != 0, out=upto[1:])
            counts[:, k] += np.diff(upto[inside])
    if before == WORD:
        ends.append(np.array([size]))
    none = np.empty(0, np.int64)
    return counts, np.concatenate([none, *begins]), np.concatenate([none, *ends])


def span_hashes(raw: np.ndarray, begin: np.ndarray, length: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of bytes, eight bytes at a time."""
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    found = mixed(seeds.astype(np.uint64) * _STEP ^ length.astype(np.uint64))
    own, at, left = np.flatnonzero(length <= LONG_WORD), begin, length
    at, left = at[own], left[own]
    while len(own):
        found[own] = mixed(found[own] * _STEP ^ (eight[at] & _FIRST_BYTES[np.minimum(left, 8)]))
        more = left > 8
        own, at, left = own[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(length > LONG_WORD):
        own_hash = hash(raw[begin[i] : begin[i] + length[i]].tobytes()) & (2**64 - 1)
        found[i] ^= np.uint64(own_hash)
    return found


def _same_bytes(raw: np.ndarray, one: np.ndarray, other: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether spans of one length, starting at ``one`` and at ``other``, are equal."""
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    same = np.ones(len(one), bool)
    own = np.flatnonzero(length <= LONG_WORD)
    done = 0
    while len(own):
        part = _FIRST_BYTES[np.minimum(length[own] - done, 8)]
        differ = ((eight[one[own] + done] ^ eight[other[own] + done]) & part) != 0
        same[own[differ]] = False
        done += 8
        own = own[~differ & (length[own] > done)]
    for i in np.flatnonzero(length > LONG_WORD):
        a, b, n = one[i], other[i], length[i]
        same[i] = np.array_equal(raw[a : a + n], raw[b : b + n])
    return same


def first_seen(
    raw: np.ndarray, begin: np.ndarray, length: np.ndarray, owner: np.ndarray, hashes: np.ndarray | None = None
) -> np.ndarray:
    """Which words are the first of their owner with their bytes, by a verified hash table.

    Each round every waiting word looks at its slot. The first to come takes a
    free one; a word equal to the one that holds the slot is not new; any other
    moves on to the next slot.
    """
    if hashes is None:
        hashes = span_hashes(raw, begin, length, owner)
    slots = np.full(1 << (2 * len(begin)).bit_length(), -1, np.int32)
    last = np.uint64(len(slots) - 1)
    new = np.zeros(len(begin), bool)
    waiting, at = np.arange(len(begin), dtype=np.int32), (hashes & last).astype(np.int64)
    while len(waiting):
        free = slots[at] < 0
        # The earliest of those that want one slot is written last.
        slots[at[free][::-1]] = waiting[free][::-1]
        holder = slots[at]
        placed = holder == waiting
        new[waiting[placed]] = True
        waiting, at, holder = waiting[~placed], at[~placed], holder[~placed]
        alike = (
            (hashes[holder] == hashes[waiting])
            & (owner[holder] == owner[waiting])
            & (length[holder] == length[waiting])
        )
        maybe = np.flatnonzero(alike)
        one, other = waiting[maybe], holder[maybe]
        alike[maybe] = _same_bytes(raw, begin[one], begin[other], length[one])
        waiting, at = waiting[~alike], (at[~alike] + 1) & int(last)
    return new


def facts_of(texts: pa.Array) -> np.ndarray:
    """Per text: words, distinct words, capitals, symbols, code points."""
    raw, bounds = bytes_of(texts)
    counts, begin, end = transduce(raw, bounds)
    owner = np.searchsorted(bounds, begin, "right") - 1
    new = first_seen(raw, begin, end - begin, owner)
    n = len(bounds) - 1
    words, distinct = np.bincount(owner, minlength=n), np.bincount(owner[new], minlength=n)
    return np.column_stack([words, distinct, counts])


FACTS = ("n_words", "n_distinct", "n_capitals", "n_symbols", "n_points")


def text_facts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Rows (id, part, digest, then the five counts), one per document.

    A null text is empty, a null part an empty string. ``digest`` is the SHA-256
    of the text. An empty table gives an empty table.
    """
    text = F.coalesce(quoted(text_col), F.lit(""))
    part = F.coalesce(quoted(part_col).cast("string"), F.lit(""))
    digest = F.unhex(F.sha2(text.cast("binary"), 256))
    rows = docs.select(
        quoted(id_col).alias("id"), part.alias("part"), digest.alias("digest"), text.alias("body")
    )
    kept = [rows.schema[c] for c in ("id", "part", "digest")]
    schema = T.StructType([*kept, *[T.StructField(c, T.LongType()) for c in FACTS]])

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(3), SLICE_BYTES):
                own = batch.slice(a, b - a)
                found = facts_of(own.column(3))
                counts = [pa.array(found[:, k], pa.int64()) for k in range(len(FACTS))]
                yield pa.RecordBatch.from_arrays([*own.columns[:3], *counts], names=schema.names)

    return rows.mapInArrow(run, schema)


def _failed(conditions: list[Column]) -> Column:
    """One bit per condition that holds, the first lowest."""
    bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """Rows (part, failed, n, good, toxic): documents per set of failed filters.

    Equal texts fail the same of the first four filters, and all but those with
    their smallest id fail the fifth. So they are counted by digest, part and
    label before they meet, and no task gets the copies of a text one by one.
    """
    facts = text_facts(docs, id_col, text_col, part_col)
    four = _failed(
        [
            F.col("n_words") < MIN_WORDS,
            100 * F.col("n_distinct") < MIN_DISTINCT_PERCENT * F.col("n_words"),
            100 * F.col("n_capitals") > MAX_CAPITAL_PERCENT * F.col("n_points"),
            F.col("n_symbols") > 0,
        ]
    )
    facts = stored(facts.select("id", "part", "digest", four.alias("four")), "audit-facts")
    yes = lambda c: F.max(F.coalesce(quoted(c) == 1, F.lit(False)))
    marked = (
        labels.filter(quoted(id_col).isNotNull())
        .groupBy(quoted(id_col).alias("of_id"))
        .agg(yes("quality").alias("good"), yes("toxic").alias("toxic"))
    )
    # Equal rows are one from here on, however many there are.
    rows = facts.groupBy(*facts.columns).agg(F.count("*").alias("n"))
    no = F.lit(False)
    named = rows.filter(F.col("id").isNotNull()).join(
        marked.hint("merge"), F.col("id") == F.col("of_id"), "left"
    )
    named = named.select(
        *rows.columns, F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")
    )
    # Rows without an id have no label; joined, they would all meet in one task.
    nameless = rows.filter(F.col("id").isNull()).select("*", no.alias("good"), no.alias("toxic"))
    kinds = ["digest", "part", "four", "good", "toxic"]
    cells = (
        named.unionByName(nameless)
        .groupBy(*kinds)
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
            F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first"),
        )
    )
    smallest = F.min("first.id").over(Window.partitionBy("digest"))
    # Neither a row without an id nor those with the smallest one have a smaller one.
    stays = F.col("nameless") + F.when(F.col("first.id") == smallest, F.col("first.n")).otherwise(0)
    split = cells.withColumn("stays", stays).select(
        "part",
        "good",
        "toxic",
        F.explode(
            F.array(
                F.struct(F.col("four").alias("failed"), F.col("stays").alias("n")),
                F.struct(F.col("four").bitwiseOR(1 << 4).alias("failed"), (F.col("n") - F.col("stays")).alias("n")),
            )
        ).alias("x"),
    )
    of = lambda c: F.sum(F.when(F.col(c), F.col("x.n")).otherwise(0)).alias(c)
    return split.groupBy("part", F.col("x.failed").alias("failed")).agg(
        F.sum("x.n").alias("n"), of("good"), of("toxic")
    )


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """Rows (part, filter_order, step, kept, removed, ...) for all orders of the five filters.

    ``shapley`` of a filter is what it removes, summed over all orders. A
    document goes to the first of the filters that it fails, and each of these
    comes first in an equal share of the orders; the sum needs no order spelled out.

    A null text is empty; a null part counts as the part ''. A row without an id
    is nobody's copy and nobody copies it, and it has no label. Repeated rows
    count each; equal ids are not smaller than each other. Several labels of one
    id count as good, or toxic, if any is. An empty table gives an empty table.
    """
    counts = failure_counts(docs, labels, id_col, text_col, part_col)
    # At most 32 sets of failed filters per part.
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("sets"))
    orders = parts.select("*", F.explode(F.array(*map(F.lit, ORDERS))).alias("filter_order"))
    steps = orders.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    letter = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    bits = {f: 1 << i for i, f in enumerate(FILTERS)}
    bit_of = F.create_map(*[F.lit(x) for pair in bits.items() for x in pair])
    earlier = F.aggregate(
        F.slice(F.split("filter_order", ""), F.lit(1), F.col("step") - 1),
        F.lit(0),
        lambda acc, f: acc.bitwiseOR(F.element_at(bit_of, f)),
    )
    steps = steps.withColumns({"own": F.element_at(bit_of, letter), "earlier": earlier})
    fails = lambda s: s["failed"].bitwiseAND(F.col("own")) != 0
    gone = lambda s: s["failed"].bitwiseAND(F.col("earlier")) != 0

    def total(what, of) -> Column:
        add = lambda acc, s: acc + F.when(what(s), of(s)).otherwise(F.lit(0).cast("long"))
        return F.aggregate("sets", F.lit(0).cast("long"), add)

    n = lambda s: s["n"]
    removed = lambda s: fails(s) & ~gone(s)
    share = lambda s: s["n"] * F.element_at(
        F.array(*[F.lit(len(ORDERS) // k) for k in range(1, len(FILTERS) + 1)]),
        F.greatest(F.bit_count(s["failed"]), F.lit(1)).cast("int"),
    )
    return steps.select(
        "part",
        "filter_order",
        "step",
        total(lambda s: ~fails(s) & ~gone(s), n).alias("kept"),
        total(removed, n).alias("removed"),
        total(lambda s: fails(s) & gone(s), n).alias("redundant"),
        total(lambda s: s["failed"] == F.col("own"), n).alias("unique_fails"),
        total(removed, lambda s: s["good"]).alias("good_lost"),
        total(removed, lambda s: s["toxic"]).alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )
