"""Documents packed into sequences by a grouping genetic algorithm.

A chromosome is a list of bins, each a list of sizes; documents of one size are
the same to it. Crossover takes whole well-filled bins of one parent into the
other, removes the bins that now hold what is used up, and puts the displaced
documents by best fit.

Pieces are dealt out to islands at random; each island breeds its own population
in one task. An epoch ends with migration: the filled bins that occur most often
anywhere are handed to all islands of the next epoch, which start from them where
they have such sizes. Filled bins are settled; the documents of all others are
dealt out anew, so what one island could not fill meets the leftovers of others.
A share of the filled bins is dealt out with them, whose small documents are what
the leftovers lack. In the last epoch every bin is settled.

Only ids and sizes are dealt out. The token ids move once, to their sequence.
"""

from __future__ import annotations

import random
import struct
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardframe.llm.bpe import encoder, slices
from wardframe.llm.common import quoted, stored

CAPACITY = 1024
END_ID = 2
EPOCHS = 3
ISLAND_ITEMS = 32_768
POPULATION = 4
GENERATIONS = 6
# Migrating bins: as many as these, whatever the corpus.
ELITE = 512
# A parent's bins that may be injected: the best filled of it.
INJECTED_SHARE = 0.5
# Of the filled bins, those dealt out again with the leftovers.
REOPENED_SHARE = 0.2
MUTATED_SHARE = 0.03

Bin = list[int]


class Packing:
    """Bins under construction; the bin with the least room that is enough is found at once."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_room: list[list[Bin]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0

    def add(self, own: Bin, room: int) -> None:
        self.by_room[room].append(own)
        self.rooms |= 1 << room

    def put(self, size: int) -> None:
        """Best fit: into the fullest bin with room for it, else into a new one."""
        enough = self.rooms >> size
        if enough:
            room = size + (enough & -enough).bit_length() - 1
            own = self.by_room[room].pop()
            if not self.by_room[room]:
                self.rooms ^= 1 << room
        else:
            room, own = self.capacity, []
        own.append(size)
        self.add(own, room - size)

    def bins(self) -> list[Bin]:
        """All bins, the best filled first."""
        return [own for bins in self.by_room for own in bins]


def best_fit(sizes: Sequence[int], capacity: int, kept: Sequence[Bin] = ()) -> list[Bin]:
    """``kept`` bins, and ``sizes`` put one after the other by best fit."""
    packing = Packing(capacity)
    for own in kept:
        packing.add(list(own), capacity - sum(own))
    for size in sizes:
        packing.put(size)
    return packing.bins()


def fitness(bins: Sequence[Bin]) -> tuple[int, int]:
    """Fewer bins are fitter; of as many, those where full and empty bins differ most."""
    return -len(bins), sum(sum(own) ** 2 for own in bins)


def inherit(injected: Sequence[Bin], others: Sequence[Bin], left: Counter, capacity: int) -> list[Bin]:
    """A child: ``injected`` bins, those ``others`` that are still whole, and the displaced by best fit.

    ``left`` counts the sizes to be packed. A bin with a size that is used up
    already is removed, and what else it held is displaced.
    """
    left = Counter(left)
    kept: list[Bin] = []
    for own in (*injected, *others):
        for i, size in enumerate(own):
            if left[size] > 0:
                left[size] -= 1
            else:
                for used in own[:i]:
                    left[used] += 1
                break
        else:
            kept.append(own)
    displaced = sorted(left.elements(), reverse=True)
    return best_fit(displaced, capacity, kept)


def cross(one: Sequence[Bin], other: Sequence[Bin], sizes: Counter, capacity: int, draw: random.Random) -> list[Bin]:
    """A child of two parents, whose bins stand with the best filled first."""
    best = other[: max(1, int(len(other) * INJECTED_SHARE))]
    a, b = sorted((draw.randint(0, len(best)), draw.randint(0, len(best))))
    return inherit(best[a : b + 1], one, sizes, capacity)


def mutate(bins: Sequence[Bin], capacity: int, draw: random.Random) -> list[Bin]:
    """Dissolves the worst bin and a few drawn ones, and puts their documents anew."""
    gone = {len(bins) - 1} | {i for i in range(len(bins)) if draw.random() < MUTATED_SHARE}
    displaced = [size for i in gone for size in bins[i]]
    draw.shuffle(displaced)
    return best_fit(displaced, capacity, [own for i, own in enumerate(bins) if i not in gone])


def evolve(
    sizes: Sequence[int],
    capacity: int = CAPACITY,
    elite: Sequence[Bin] = (),
    seed: int = 0,
    population: int = POPULATION,
    generations: int = GENERATIONS,
) -> list[Bin]:
    """The fittest packing of one island; never more bins than best fit of falling sizes."""
    if not sizes:
        return []
    draw, counts = random.Random(seed), Counter(sizes)
    least = -(-sum(sizes) // capacity)
    falling = sorted(sizes, reverse=True)
    people = [best_fit(falling, capacity)]
    if len(people[0]) == least and fitness(people[0])[1] >= (least - 1) * capacity**2:
        return people[0]
    if elite:
        people.append(inherit([], elite, counts, capacity))
    while len(people) < population:
        people.append(best_fit(draw.sample(falling, len(falling)), capacity))
    people.sort(key=fitness, reverse=True)
    for _ in range(generations):
        one, other = draw.sample(people, 2)
        for child in (cross(one, other, counts, capacity, draw), cross(other, one, counts, capacity, draw)):
            if draw.random() < 0.5:
                child = mutate(child, capacity, draw)
            people.append(child)
        people.sort(key=fitness, reverse=True)
        del people[population:]
    return people[0]


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows (key, id, piece, start, length, ids): the token ids of documents, cut to ``capacity``.

    Only a longer document is cut, from its end, so its first piece may be
    shorter. ``key`` differs in all rows of one run; ``ids`` are little-endian
    unsigned 32-bit integers.
    """
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("body"))
    schema = T.StructType(
        [
            T.StructField("key", T.LongType()),
            rows.schema["id"],
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def run(batches):
        from pyspark import TaskContext

        own, key = encoder(tokenizer_path), TaskContext.get().partitionId() << 40
        end = struct.pack("<I", end_id)
        for batch in batches:
            for a, b in slices(batch.column(1)):
                ids, bounds = own.encode(pc.fill_null(batch.column(1).slice(a, b - a), ""))
                of, piece, start, raw = [], [], [], []
                for i, (s, e) in enumerate(zip(bounds, bounds[1:])):
                    whole = ids[s:e].tobytes() + end
                    n = len(whole) // 4
                    cuts = [0, *range(n % capacity or capacity, n, capacity), n]
                    for k, (x, y) in enumerate(zip(cuts, cuts[1:])):
                        of.append(i)
                        piece.append(k)
                        start.append(x)
                        raw.append(whole[4 * x : 4 * y])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(key, key + len(of)), pa.int64()),
                        batch.column(0).slice(a, b - a).take(pa.array(of, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array([len(r) // 4 for r in raw], pa.int64()),
                        pa.array(raw, pa.binary()),
                    ],
                    names=schema.names,
                )
                key += len(of)

    return rows.mapInArrow(run, schema)


PLACED = "key long, length long, sequence_id long, offset long, fill long, pattern string"


def _island(capacity: int, epoch: int, elite: list[Bin]):
    """Packs one island; the first piece of a bin names its sequence and carries its sizes."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key")
        bins = evolve(group["length"].tolist(), capacity, elite, seed=epoch * 1_000_003 + int(group["island"].iloc[0]))
        keys: dict[int, list[int]] = {}
        for key, length in zip(group["key"].tolist(), group["length"].tolist()):
            keys.setdefault(length, []).append(key)
        rows = []
        for own in bins:
            fill, offset, first = sum(own), 0, None
            for size in own:
                key = keys[size].pop()
                pattern = " ".join(map(str, sorted(own, reverse=True))) if first is None else None
                first = key if first is None else first
                rows.append((key, size, first, offset, fill, pattern))
                offset += size
        return pd.DataFrame(rows, columns=["key", "length", "sequence_id", "offset", "fill", "pattern"])

    return run


def place(
    items: DataFrame,
    capacity: int = CAPACITY,
    epochs: int = EPOCHS,
    island_items: int = ISLAND_ITEMS,
) -> DataFrame:
    """Rows (key, sequence_id, offset): pieces (key, length) packed into sequences.

    Each epoch takes one pass over the
    pieces that are not settled, written and read back; an island holds about
    ``island_items`` of them, whatever the table. Migrants are the commonest
    filled bins, ``ELITE`` at most, each of ``capacity`` sizes at most.
    """
    result = ["key", "sequence_id", "offset"]
    settled = items.select("key", F.col("key").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    settled = settled.filter("false")
    tasks = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    free, elite = items.select("key", "length"), []
    for epoch in range(epochs):
        islands = -(-free.count() // island_items)
        if not islands:
            break
        dealt = free.withColumn("island", F.pmod(F.xxhash64("key", F.lit(epoch)), F.lit(islands)))
        # As many tasks as islands: their rows are few bytes, their work is not.
        dealt = dealt.repartition(max(islands, tasks), "island")
        placed = stored(
            dealt.groupBy("island").applyInPandas(_island(capacity, epoch, elite), PLACED), f"epoch-{epoch}"
        )
        if epoch + 1 == epochs:
            settled = settled.unionByName(placed.select(*result))
            break
        drawn = F.pmod(F.xxhash64("sequence_id", F.lit(epoch)), F.lit(1000)) >= int(1000 * REOPENED_SHARE)
        full = F.col("fill") == capacity
        settled = settled.unionByName(placed.filter(full & drawn).select(*result))
        common = placed.filter(full & F.col("pattern").isNotNull()).groupBy("pattern").count()
        best = common.orderBy(F.desc("count"), "pattern").limit(ELITE).collect()
        # A bin that occurs once in an island of the last epoch may do so in the next.
        elite = [list(map(int, r["pattern"].split())) for r in best for _ in range(max(1, r["count"] // islands))]
        free = placed.filter(~(full & drawn)).select("key", "length")
    return settled


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    epochs: int = EPOCHS,
    island_items: int = ISLAND_ITEMS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows (id, piece, start, length, ids, sequence_id, offset) of all pieces of all documents.

    A sequence is its pieces in the order of ``offset``, without gaps, at most
    ``capacity`` ids long. A null text is empty: it is packed as ``end_id``
    alone. Repeated rows and null ids are packed each by itself; other columns
    are not looked at, and an empty table gives an empty table. Runs over the
    same files place alike; ``sequence_id`` has no order.
    """
    pieces = stored(token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pieces")
    # A piece that fills a sequence is one, wherever it lies.
    alone = F.col("length") >= capacity
    filled = pieces.filter(alone).select("*", F.col("key").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    others = pieces.filter(~alone)
    placed = place(others.select("key", "length"), capacity, epochs, island_items)
    # The same join at every size: placements grow with the documents.
    packed = filled.unionByName(others.join(placed.hint("merge"), "key"))
    return packed.select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids", "sequence_id", "offset"
    )
