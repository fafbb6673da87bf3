"""An interpolated modified Kneser-Ney bigram model, counted in Spark.

The model is a folder of sorted arrays that workers map into memory:

* ``words-*``: sorted 64-bit word hashes of one range and how often each occurs.
  A word's id is its place among all of them.
* ``pairs-*``: sorted keys of one bucket, previous id and next id, and counts.
  The bucket follows from a hash of the key, so no word makes a bucket large.
  A key has 32 bits of either id. Of ids that need more, the lowest bits are the
  key's part, and each part has buckets of its own.
* ``context-*`` and ``before-*``: per id, for a range of ids, what follows it
  (tokens, and types seen once, twice, more often) and how many different ids
  come before it.

Each task counts its own texts first and ships one packed, sorted block per
bucket. Nothing is pruned: the model grows with the corpus.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardframe.llm.bpe import slices
from wardframe.llm.common import crc32_rest, quoted, stored
from wardframe.llm.wordbytes import NO_WORD, mixed, word_hashes
from wardframe.llm.worker import remembers, serve

HELD_OUT_PARTS = 10
ADDED = 0.1
HALF = np.uint64(32)
LOWER_HALF = np.uint64(0xFFFFFFFF)
PAIRS_PER_BUCKET = 4_000_000
IDS_PER_RANGE = 1 << 18
SLICE_BYTES = 2 << 20
# Discounts where the counts of counts are too few to estimate them.
FALLBACK = (0.5, 1.0, 1.5)

def local_path(folder: str) -> str:
    """The folder as workers open it; it has to be mounted on all of them."""
    path = folder.removeprefix("file://").removeprefix("file:")
    if "://" in path:
        raise ValueError(f"the model folder must be a mounted one to be mapped into memory: {folder}")
    return path


def _save(folder: str, name: str, *arrays: np.ndarray) -> None:
    """Arrays one after the other; the file has its name only once it is whole."""
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with open(draft, "wb") as out:
        for array in arrays:
            out.write(np.ascontiguousarray(array).tobytes())
    os.replace(draft, f"{folder}/{name}")


def _mapped(path: str, *dtypes: str) -> list[np.ndarray]:
    """Arrays of equal length, mapped from one file."""
    width = sum(np.dtype(d).itemsize for d in dtypes)
    size = os.path.getsize(path)
    if not size:
        return [np.empty(0, d) for d in dtypes]
    raw, count, at, found = np.memmap(path, np.uint8, "r"), size // width, 0, []
    for dtype in dtypes:
        end = at + count * np.dtype(dtype).itemsize
        found.append(raw[at:end].view(dtype))
        at = end
    return found


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' tokens, A-Z lower-cased, each text closed by the end, and bounds."""
    hashes, bounds = word_hashes(texts, ascii_lower=True)
    ends = bounds + np.arange(len(bounds))
    found = np.full(len(hashes) + len(texts), NO_WORD)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    found[np.arange(len(hashes)) + owner] = hashes
    return found, ends


def _word_batches(batches):
    seen: list[tuple[np.ndarray, np.ndarray]] = []

    def merged():
        hashes = np.concatenate([s[0] for s in seen])
        counts = np.concatenate([s[1] for s in seen])
        distinct, where = np.unique(hashes, return_inverse=True)
        return distinct, np.bincount(where, counts, len(distinct)).astype(np.int64)

    for batch in batches:
        for a, b in slices(batch.column(0), SLICE_BYTES):
            hashes, _ = tokens(batch.column(0).slice(a, b - a))
            seen.append(np.unique(hashes, return_counts=True))
            if len(seen) == 16:
                seen = [merged()]
    if seen:
        hashes, counts = merged()
        for a in range(0, len(hashes), 100_000):
            part = slice(a, a + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[part].view(np.int64)), pa.array(counts[part])], names=["h", "n"]
            )


def _word_writer(folder: str):
    def run(batches):
        from pyspark import TaskContext

        hashes, counts = [], []
        for batch in batches:
            hashes.append(batch.column(0).to_numpy())
            counts.append(batch.column(1).to_numpy())
        if not hashes or not sum(map(len, hashes)):
            return
        h, n = np.concatenate(hashes), np.concatenate(counts)
        name = f"words-{TaskContext.get().partitionId():06d}"
        _save(folder, name, h.astype("<i8"), n.astype("<i8"))
        yield pa.RecordBatch.from_pylist(
            [{"name": name, "least": int(h[0]), "size": len(h), "total": int(n.sum())}]
        )

    return run


@dataclass(frozen=True)
class Ids:
    """How ids are laid out: ``spare`` is how many bits they have beyond 32."""

    spare: int

    @classmethod
    def of(cls, vocabulary: int) -> Ids:
        """The last two ids are no words: see ``begin`` and ``unknown``."""
        return cls(max(0, (vocabulary + 1).bit_length() - 32))

    @property
    def begin(self) -> int:
        """The place before the first word."""
        return (1 << 32 + self.spare) - 1

    @property
    def unknown(self) -> int:
        return (1 << 32 + self.spare) - 2

    @property
    def parts(self) -> int:
        return 1 << 2 * self.spare

    def keys(self, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The key of each pair of ids, and the part it belongs to."""
        s, low = np.uint64(self.spare), np.uint64((1 << self.spare) - 1)
        return before >> s << HALF | after >> s, (before & low) << s | after & low

    def pairs(self, keys: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of keys of one part."""
        s = np.uint64(self.spare)
        first, second = np.uint64(part >> self.spare), np.uint64(part & (1 << self.spare) - 1)
        return keys >> HALF << s | first, (keys & LOWER_HALF) << s | second


class Words:
    """The vocabulary: from word hashes to ids and counts."""

    def __init__(self, folder: str, shards: list[dict], ids: Ids):
        self.unknown = ids.unknown
        self.least = np.array([s["least"] for s in shards], np.int64)
        self.parts = [_mapped(f"{folder}/{s['name']}", "<i8", "<i8") for s in shards]
        self.before = np.cumsum([0, *(s["size"] for s in shards)])

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id, or that of unknown words, and count of each token; each distinct one is looked up once."""
        distinct, where = np.unique(hashes.view(np.int64), return_inverse=True)
        ids = np.full(len(distinct), self.unknown, np.uint64)
        counts = np.zeros(len(distinct), np.int64)
        edges = np.searchsorted(distinct, self.least)
        for i, (known, n) in enumerate(self.parts):
            own = slice(edges[i], edges[i + 1] if i + 1 < len(edges) else len(distinct))
            at = np.minimum(np.searchsorted(known, distinct[own]), len(known) - 1)
            hit = known[at] == distinct[own]
            ids[own] = np.where(hit, self.before[i] + at, self.unknown)
            counts[own] = np.where(hit, n[at], 0)
        return ids[where], counts[where]


def _previous(ids: np.ndarray, ends: np.ndarray, begin: int) -> np.ndarray:
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[ends[:-1]] = begin
    return before


def _buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(keys) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as steps of their upper half and plain lower half, small counts as bytes."""
    import zstandard

    upper = np.diff((keys >> np.uint64(32)).astype(np.int64), prepend=0).astype("<u4")
    lower = (keys & np.uint64(0xFFFFFFFF)).astype("<u4")
    small = np.minimum(counts, 255).astype(np.uint8)
    large = counts[counts >= 255].astype("<i8")
    # The bytes of a place stand together, so the many zeros do too.
    planes = [x.view(np.uint8).reshape(-1, 4).T.tobytes() for x in (upper, lower)]
    head = np.array([len(keys), len(large)], "<i8").tobytes()
    body = b"".join([*planes, small.tobytes(), large.tobytes()])
    return head + zstandard.ZstdCompressor(level=1).compress(body)


def _unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    size, n_large = np.frombuffer(block[:16], "<i8")
    body = zstandard.ZstdDecompressor().decompress(block[16:])
    halves = [
        np.ascontiguousarray(
            np.frombuffer(body, np.uint8, 4 * size, at).reshape(4, size).T
        ).view("<u4").ravel().astype(np.uint64)
        for at in (0, 4 * size)
    ]
    counts = np.frombuffer(body, np.uint8, size, 8 * size).astype(np.int64)
    counts[counts == 255] = np.frombuffer(body, "<i8", n_large, 9 * size)
    return np.cumsum(halves[0]) << np.uint64(32) | halves[1], counts


def _summed(blocks: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([b[0] for b in blocks])
    counts = np.concatenate([b[1] for b in blocks])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _spans(sorted_values: np.ndarray) -> list[tuple[int, slice]]:
    """Each value that occurs, with its span."""
    values, first = np.unique(sorted_values, return_index=True)
    bounds = [*first.tolist(), len(sorted_values)]
    return [(int(v), slice(a, b)) for v, a, b in zip(values, bounds, bounds[1:])]


def _pair_batches(folder: str, shards: list[dict], layout: Ids, per_part: int):
    def run(batches):
        serve("ngram")
        words, seen, held = Words(folder, shards, layout), {}, 0

        def blocks():
            for part, own in sorted(seen.items()):
                keys, counts = _summed(own)
                bucket = part * per_part + _buckets_of(keys, per_part).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                keys, counts, spans = keys[order], counts[order], _spans(bucket[order])
                for a in range(0, len(spans), 64):
                    some = spans[a : a + 64]
                    raw = [_packed(keys[span], counts[span]) for _, span in some]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b for b, _ in some], pa.int64()), pa.array(raw, pa.binary())],
                        names=["bucket", "block"],
                    )

        for batch in batches:
            for a, b in slices(batch.column(0), SLICE_BYTES):
                hashes, ends = tokens(batch.column(0).slice(a, b - a))
                ids, _ = words.find(hashes)
                keys, parts = layout.keys(_previous(ids, ends, layout.begin), ids)
                order = np.argsort(parts, kind="stable") if layout.spare else slice(None)
                keys = keys[order]
                for part, span in _spans(parts[order]):
                    seen.setdefault(part, []).append(np.unique(keys[span], return_counts=True))
                    held += len(seen[part][-1][0])
                if held > PAIRS_PER_BUCKET:
                    yield from blocks()
                    seen, held = {}, 0
        if seen:
            yield from blocks()

    return run


def _ranged(ids: np.ndarray, columns: list[np.ndarray], kind: str):
    """Rows (kind, span, raw): the ids and columns of each range of ids."""
    span = ids // IDS_PER_RANGE
    edges = np.flatnonzero(np.concatenate([[True], span[1:] != span[:-1], [True]]))
    for a, b in zip(edges, edges[1:]):
        parts = [(ids[a:b] - span[a] * IDS_PER_RANGE).astype("<u4")]
        parts += [c[a:b].astype("<u4") for c in columns]
        yield {"kind": kind, "span": int(span[a]), "raw": _squeezed(parts), "counts": []}


def _squeezed(parts: list[np.ndarray]) -> bytes:
    import zstandard

    steps = [np.diff(parts[0], prepend=np.uint32(0)), *parts[1:]]
    planes = b"".join(p.view(np.uint8).reshape(-1, 4).T.tobytes() for p in steps)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _spread(raw: bytes, columns: int) -> list[np.ndarray]:
    import zstandard

    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    size = len(body) // (4 * columns)
    parts = [
        np.ascontiguousarray(body[4 * size * k : 4 * size * (k + 1)].reshape(4, size).T).view("<u4").ravel()
        for k in range(columns)
    ]
    return [np.cumsum(parts[0], dtype=np.uint32), *parts[1:]]


def _count_of_counts(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5].tolist()


_PAIR_SCHEMA = "kind string, span long, raw binary, counts array<long>"


def _pair_writer(folder: str, layout: Ids, per_part: int):
    def run(group):
        import pandas as pd

        keys, counts = _summed([_unpacked(b) for b in group["block"]])
        small = np.minimum(counts, 255).astype(np.uint8)
        over = counts >= 255
        bucket = int(group["bucket"].iloc[0])
        _save(folder, f"pairs-{bucket:06d}", keys.astype("<u8"), small)
        _save(folder, f"more-{bucket:06d}", keys[over].astype("<u8"), counts[over].astype("<i8"))
        before, after = layout.pairs(keys, bucket // per_part)
        first = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        kinds = (counts, counts == 1, counts == 2, counts > 2)
        columns = [np.add.reduceat(x.astype(np.int64), first) for x in kinds]
        rows = list(_ranged(before[first].astype(np.int64), columns, "context"))
        ids, types = np.unique(after.astype(np.int64), return_counts=True)
        rows += _ranged(ids, [types], "before")
        found = _count_of_counts(counts) + [len(keys)]
        rows.append({"kind": "counts", "span": 0, "raw": b"", "counts": found})
        return pd.DataFrame(rows, columns=["kind", "span", "raw", "counts"])

    return run


def _range_writer(folder: str):
    def run(group):
        import pandas as pd

        kind, span = group["kind"].iloc[0], int(group["span"].iloc[0])
        columns = 4 if kind == "context" else 1
        table = np.zeros((columns, IDS_PER_RANGE), np.int64)
        for raw in group["raw"]:
            ids, *values = _spread(raw, columns + 1)
            for k, v in enumerate(values):
                table[k, ids] += v
        # Written as 64-bit integers: a count over the corpus may be large.
        _save(folder, f"{kind}-{span:08d}", table.astype("<i8"))
        seen = table[0][table[0] > 0]
        found = _count_of_counts(seen) + [int(seen.sum()), int((seen > 2).sum())]
        return pd.DataFrame({"kind": [kind], "span": [span], "counts": [found]})

    return run


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """For types seen once, twice and more often, from the counts of counts 1 to 4."""
    n1, n2, n3, n4 = counts
    if not (n1 and n2 and n3):
        return FALLBACK
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    good = all(0 <= d <= k for k, d in enumerate(found, 1))
    return found if good else FALLBACK


@dataclass
class Summary:
    """What a worker needs to know besides the arrays; small, and kept as JSON."""

    shards: list[dict]
    spare: int  # see Ids
    per_part: int  # buckets of each part
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    types: int  # different pairs
    shared: tuple[int, int, int]  # words with one, two and more different ids before them

    @property
    def vocabulary(self) -> int:
        return sum(s["size"] for s in self.shards)

    @property
    def tokens(self) -> int:
        return sum(s["total"] for s in self.shards)


def train(docs: DataFrame, folder: str, text_col: str = "text", spare: int | None = None) -> Summary:
    """Counts all texts of ``docs`` into a model in ``folder``.

    Ids have ``spare`` bits beyond 32; by default as many as there are words for.

    A null text is empty; it still has its end. The driver gets one row per
    file. A file is written again as it was if its task runs again. An empty
    table gives a model without words.
    """
    path = local_path(folder)
    os.makedirs(path, exist_ok=True)
    texts = docs.select(quoted(text_col).cast("string"))
    counts = texts.mapInArrow(_word_batches, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    written = (
        counts.repartitionByRange("h")
        .sortWithinPartitions("h")
        .mapInArrow(_word_writer(path), "name string, least long, size long, total long")
    )
    shards = [r.asDict() for r in sorted(written.collect(), key=lambda r: r.least)]
    total = sum(s["total"] for s in shards)
    layout = Ids.of(sum(s["size"] for s in shards)) if spare is None else Ids(spare)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_part = -(-max(tasks, -(-total // PAIRS_PER_BUCKET)) // layout.parts)
    blocks = texts.mapInArrow(_pair_batches(path, shards, layout, per_part), "bucket long, block binary")
    written = blocks.groupBy("bucket").applyInPandas(_pair_writer(path, layout, per_part), _PAIR_SCHEMA)
    pairs = stored(written, "pair-counts")
    ranges = (
        pairs.filter("kind <> 'counts'")
        .groupBy("kind", "span")
        .applyInPandas(_range_writer(path), "kind string, span long, counts array<long>")
        .collect()
    )
    of_pairs = np.zeros(5, np.int64)
    per_bucket = pairs.filter("kind = 'counts'").select(F.posexplode("counts"))
    for row in per_bucket.groupBy("pos").agg(F.sum("col").alias("n")).collect():
        of_pairs[row.pos] = row.n
    of_words = np.sum([[0] * 6, *(r.counts for r in ranges if r.kind == "before")], axis=0)
    summary = Summary(
        shards,
        layout.spare,
        per_part,
        discounts(of_pairs[:4].tolist()),
        discounts(of_words[:4].tolist()),
        int(of_pairs[4]),
        (int(of_words[0]), int(of_words[1]), int(of_words[5])),
    )
    with open(f"{path}/summary.json", "w") as out:
        json.dump(vars(summary), out)
    return summary


class Model:
    """A trained model, its arrays mapped when they are first needed."""

    def __init__(self, folder: str, summary: Summary):
        self.path, self.summary = local_path(folder), summary
        self.ids = Ids(summary.spare)
        self.words = Words(self.path, summary.shards, self.ids)
        self.files: dict[str, list[np.ndarray] | None] = {}

    def _file(self, name: str, *dtypes: str) -> list[np.ndarray] | None:
        if name not in self.files:
            path = f"{self.path}/{name}"
            self.files[name] = _mapped(path, *dtypes) if os.path.exists(path) else None
        return self.files[name]

    def _of_ids(self, kind: str, columns: int, ids: np.ndarray) -> np.ndarray:
        """The columns of some ids, sorted ones; zero for ids without a file."""
        found = np.zeros((columns, len(ids)), np.int64)
        span = ids // IDS_PER_RANGE
        edges = np.flatnonzero(np.concatenate([[True], span[1:] != span[:-1], [True]])) if len(ids) else []
        for a, b in zip(edges, edges[1:]):
            file = self._file(f"{kind}-{int(span[a]):08d}", *["<i8"] * columns)
            if file is not None:
                at = ids[a:b] - span[a] * IDS_PER_RANGE
                for k in range(columns):
                    found[k, a:b] = file[k][at]
        return found

    def _pair_counts(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The counts of distinct pairs of ids."""
        keys, parts = self.ids.keys(before, after)
        per_part = self.summary.per_part
        bucket = parts.astype(np.int64) * per_part + _buckets_of(keys, per_part).astype(np.int64)
        order = np.lexsort((keys, bucket))
        sorted_keys, found = keys[order], np.zeros(len(keys), np.int64)
        for i, own in _spans(bucket[order]):
            file = self._file(f"pairs-{i:06d}", "<u8", "u1")
            if file is None:
                continue
            known, small = file
            wanted = sorted_keys[own]
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            count = np.where(known[at] == wanted, small[at], 0).astype(np.int64)
            large = np.flatnonzero(count == 255)
            if len(large):
                over, exact = self._file(f"more-{i:06d}", "<u8", "<i8")
                count[large] = exact[np.searchsorted(over, wanted[large])]
            found[order[own]] = count
        return found

    def log10(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log10 of each token's probability after the one before it."""
        s = self.summary
        cut = lambda c, d: np.maximum(c - np.choose(np.minimum(c, 3), (0.0, *d)), 0)
        word, of_word = np.unique(ids, return_inverse=True)
        types = self._of_ids("before", 1, word.astype(np.int64))[0]
        uniform = 1 / (s.vocabulary + 1)
        if s.types:
            left = sum(d * n for d, n in zip(s.word_discounts, s.shared)) / s.types
            lower = cut(types, s.word_discounts) / s.types + left * uniform
        else:
            lower = np.full(len(word), uniform)
        context, in_context = np.unique(_previous(ids, ends, self.ids.begin), return_inverse=True)
        # Pairs by the places of their ids among those of this slice.
        places = in_context.astype(np.uint64) << HALF | of_word.astype(np.uint64)
        pairs, of_pair = np.unique(places, return_inverse=True)
        of_context, after = (pairs >> HALF).astype(np.int64), (pairs & LOWER_HALF).astype(np.int64)
        total, *seen = self._of_ids("context", 4, context.astype(np.int64))
        known = total > 0
        some = np.maximum(total, 1)
        left = np.where(known, sum(d * n for d, n in zip(s.pair_discounts, seen)) / some, 1.0)
        own = cut(self._pair_counts(context[of_context], word[after]), s.pair_discounts) / some[of_context]
        return np.log10(own[of_pair] + left[in_context] * lower[of_word])


_MODELS: dict[str, Model] = {}
remembers("ngram", _MODELS.clear)


def _score_batches(folder: str, summary: Summary):
    def run(batches):
        serve("ngram")
        if folder not in _MODELS:
            _MODELS.clear()
            _MODELS[folder] = Model(folder, summary)
        model = _MODELS[folder]
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE_BYTES):
                hashes, ends = tokens(batch.column(1).slice(a, b - a))
                ids, counts = model.words.find(hashes)
                scale = summary.tokens + ADDED * (summary.vocabulary + 1)
                base = np.add.reduceat(np.log10((counts + ADDED) / scale), ends[:-1])
                score = np.add.reduceat(model.log10(ids, ends), ends[:-1])
                known = np.add.reduceat((counts > 0).astype(np.int64), ends[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(np.diff(ends).astype(np.int64)),
                        pa.array(known),
                        pa.array(base),
                        pa.array(score),
                        pa.array(10 ** np.minimum(-score / np.diff(ends), 300)),
                    ],
                    names=["id", "n_tokens", "n_known", "base_score", "score", "perplexity"],
                )

    return run


def score_documents(
    docs: DataFrame, folder: str, summary: Summary, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (id, n_tokens, n_known, base_score, score, perplexity), one per row.

    A text's tokens are its words, A-Z lower-cased, and its end. ``score`` is the
    log10 probability of the whole text under the model, ``base_score`` that
    under smoothed word counts, ``n_known`` counts tokens seen in training. A
    null text is empty and has its end only. Repeated rows score alike; other
    columns are not looked at, and an empty table gives an empty table.
    """
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("body"))
    schema = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            *[T.StructField(c, T.DoubleType()) for c in ("base_score", "score", "perplexity")],
        ]
    )
    return rows.mapInArrow(_score_batches(folder, summary), schema).withColumnRenamed("id", id_col)


def training_part(docs: DataFrame, id_col: str = "doc_id", parts: int = HELD_OUT_PARTS) -> DataFrame:
    """The documents that are not held out; a null id is never held out."""
    return docs.filter(~F.coalesce(crc32_rest(quoted(id_col), parts) == 0, F.lit(False)))
