"""Document quality by attention over passages.

A document is a bag of passages. Each passage becomes a few shape measures, an
encoder turns them into a hidden vector, and gated attention, learnt from the
labels of whole documents, decides how much each passage counts. The weighted
passage vector gives the score (gated attention for multiple-instance learning).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardframe.llm.bpe import slices
from wardframe.llm.common import crc32_rest, quoted
from wardframe.llm.wordbytes import bytes_of, word_bounds
from wardframe.llm.worker import serve

PASSAGE_WORDS = 50
THRESHOLD = 0.3
HELD_OUT_PARTS = 5
# The fit sees this many labelled documents, those of the least hashed ids, with all their passages.
FIT_DOCUMENTS = 4_000

_BYTES = np.arange(256)
# Kinds of bytes that are counted in each passage.
_KINDS = np.stack(
    [
        (_BYTES >= 65) & (_BYTES <= 90),
        (_BYTES >= 48) & (_BYTES <= 57),
        np.isin(_BYTES, list(b"#*$%&<>@^~=+_\\{}[]")),
        _BYTES == ord("|"),
        np.isin(_BYTES, list(b"!?")),
        np.isin(_BYTES, list(b".,;:")),
        np.isin(_BYTES, list(b"\"'()-/`")),
        _BYTES >= 128,
    ]
)
# Kinds, word length and its spread, echoes, capitals at word starts, distinct words, size.
FEATURES = len(_KINDS) + 6


def passage_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One row of measures per passage, and where each text's passages end.

    A text without words is one passage of zeros.
    """
    raw, ends = bytes_of(texts)
    size = int(ends[-1])
    begin, stop, words = word_bounds(raw, ends)
    counts = np.diff(words)
    rank = np.arange(len(begin)) - np.repeat(words[:-1], counts)
    first = np.flatnonzero(rank % PASSAGE_WORDS == 0)
    per_text = np.maximum(-(-counts // PASSAGE_WORDS), 1)
    upto = np.concatenate([[0], np.cumsum(per_text)])
    table = np.zeros((int(upto[-1]), FEATURES), np.float32)
    if not len(begin):
        return table, upto
    row = np.repeat(upto[:-1], counts) + rank // PASSAGE_WORDS
    rows = row[first]
    n_words = np.add.reduceat(np.ones(len(begin), np.int32), first)
    length = stop - begin
    letters = np.add.reduceat(length, first)
    # Byte ranges of the passages, from their first word to that of the next.
    edges = begin[first]
    for k, kind in enumerate(_KINDS):
        # The part behind a passage's last word is white space, or the next text's.
        table[rows, k] = np.add.reduceat(kind[raw[:size]], edges, dtype=np.int32) / letters
    eight = np.ndarray((size,), "<u8", raw, strides=(1,))
    mask = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], np.uint64)
    key = (eight[begin] & mask[np.minimum(length, 8)]) * np.uint64(31) + length.astype(np.uint64)
    echo = np.zeros(len(begin), bool)
    echo[1:] = (key[1:] == key[:-1]) & (rank[1:] > 0)
    capital = _KINDS[0][raw[begin]]
    order = np.lexsort((key, row))
    fresh = np.ones(len(begin), bool)
    fresh[1:] = (key[order][1:] != key[order][:-1]) | (row[order][1:] != row[order][:-1])
    distinct = np.add.reduceat(fresh.astype(np.int32), first)
    mean = letters / n_words
    square = np.add.reduceat(length.astype(np.float64) ** 2, first) / n_words
    k = len(_KINDS)
    table[rows, k] = mean / 10
    table[rows, k + 1] = np.sqrt(np.maximum(square - mean**2, 0)) / 10
    table[rows, k + 2] = np.add.reduceat(echo.astype(np.int32), first) / n_words
    table[rows, k + 3] = np.add.reduceat(capital.astype(np.int32), first) / n_words
    table[rows, k + 4] = distinct / n_words
    table[rows, k + 5] = n_words / PASSAGE_WORDS
    return table, upto


@dataclass
class Model:
    """Encoder, gated attention and output weights."""

    shift: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def attend(self, table: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The score of each text and the attention on each of its passages."""
        found = _forward(self.weights, (table - self.shift) / self.scale, ends)
        return found["score"], found["attention"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    hidden = np.tanh(x @ w["encode"] + w["encode_0"])
    content, gate = np.tanh(hidden @ w["content"]), _sigmoid(hidden @ w["gate"])
    energy = (content * gate) @ w["energy"]
    starts, sizes = ends[:-1], np.diff(ends)
    energy = energy - np.repeat(np.maximum.reduceat(energy, starts), sizes)
    attention = np.exp(energy)
    attention /= np.repeat(np.add.reduceat(attention, starts), sizes)
    pooled = np.add.reduceat(hidden * attention[:, None], starts, axis=0)
    score = _sigmoid(pooled @ w["out"] + w["out_0"])
    return {
        "hidden": hidden,
        "content": content,
        "gate": gate,
        "attention": attention,
        "pooled": pooled,
        "score": score,
    }


def _gradients(w, x, ends, label, weight) -> dict[str, np.ndarray]:
    """Of the weighted mean log loss, by the chain rule from the output back."""
    f = _forward(w, x, ends)
    starts, sizes = ends[:-1], np.diff(ends)
    out = (f["score"] - label) * weight / weight.sum()
    pooled = np.repeat(out[:, None] * w["out"][None, :], sizes, axis=0)
    of_attention = (pooled * f["hidden"]).sum(axis=1)
    mean = np.add.reduceat(of_attention * f["attention"], starts)
    energy = f["attention"] * (of_attention - np.repeat(mean, sizes))
    gated = energy[:, None] * w["energy"][None, :]
    content = gated * f["gate"] * (1 - f["content"] ** 2)
    gate = gated * f["content"] * f["gate"] * (1 - f["gate"])
    hidden = pooled * f["attention"][:, None] + content @ w["content"].T + gate @ w["gate"].T
    inner = hidden * (1 - f["hidden"] ** 2)
    return {
        "encode": x.T @ inner,
        "encode_0": inner.sum(axis=0),
        "content": f["hidden"].T @ content,
        "gate": f["hidden"].T @ gate,
        "energy": (f["content"] * f["gate"]).T @ energy,
        "out": f["pooled"].T @ out,
        "out_0": out.sum(),
    }


def fit(
    table: np.ndarray,
    ends: np.ndarray,
    label: np.ndarray,
    hidden: int = 16,
    attention: int = 8,
    steps: int = 300,
    rate: float = 0.02,
    decay: float = 1e-4,
    seed: int = 7,
) -> Model:
    """Adam on the whole sample; the two classes weigh alike.

    A sample of one class only, or of none, gives a model that scores all texts
    by that class's share, one half without labels.
    """
    shift = table.mean(axis=0) if len(table) else np.zeros(FEATURES)
    scale = table.std(axis=0) + 1e-3 if len(table) else np.ones(FEATURES)
    x = (table - shift) / scale
    draw = np.random.default_rng(seed)
    w = {
        "encode": draw.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)),
        "encode_0": np.zeros(hidden),
        "content": draw.normal(0, hidden**-0.5, (hidden, attention)),
        "gate": draw.normal(0, hidden**-0.5, (hidden, attention)),
        "energy": draw.normal(0, attention**-0.5, attention),
        "out": draw.normal(0, hidden**-0.5, hidden),
        "out_0": np.zeros(()),
    }
    share = label.mean() if len(label) else 0.5
    if share in (0.0, 1.0) or not len(label):
        w["out"][:] = 0
        w["out_0"] = np.array(np.log((share + 0.01) / (1.01 - share)))
        return Model(shift, scale, w)
    weight = np.where(label == 1, 0.5 / share, 0.5 / (1 - share))
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, steps + 1):
        for k, g in _gradients(w, x, ends, label, weight).items():
            g = g + decay * w[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            w[k] = w[k] - rate * move
    return Model(shift, scale, w)


def _fit_batches(batches) -> Iterator[pa.RecordBatch]:
    """The passages of each text as one row of bytes, beside its label and turn."""
    for batch in batches:
        for a, b in slices(batch.column(0)):
            table, ends = passage_features(batch.column(0).slice(a, b - a))
            for i, (s, e) in enumerate(zip(ends, ends[1:])):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([table[s:e].astype("<f4").tobytes()], pa.binary()),
                        batch.column(1).slice(a + i, 1),
                        batch.column(2).slice(a + i, 1),
                    ],
                    names=["passages", "label", "turn"],
                )


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    fit_documents: int = FIT_DOCUMENTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    **settings,
) -> Model:
    """Fits on labelled documents that are not held out, at most ``fit_documents`` of them.

    Those of the least hashed ids are taken, so the sample is the same in every
    run. What reaches the driver is the measures of that many documents, 56 bytes
    for every 50 words. Null labels and ids are left out, and so are labels whose
    document is not there.
    """
    usable = labels.select(quoted(id_col).alias("of"), quoted(label_col).cast("int").alias("label"))
    learnt = crc32_rest(F.col("of"), HELD_OUT_PARTS) != 0
    usable = usable.filter(F.col("label").isin(0, 1) & learnt).withColumn("turn", F.xxhash64("of"))
    there = docs.select(quoted(id_col).alias("of"))
    sample = usable.join(there, "of", "left_semi").orderBy("turn", "of", "label").limit(fit_documents)
    # A bounded number of ids: the documents stay where they are.
    texts = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("body")).join(
        F.broadcast(sample), F.col("id") == F.col("of")
    )
    found = (
        texts.select("body", "label", "turn")
        .mapInArrow(_fit_batches, "passages binary, label int, turn long")
        .orderBy("turn", "label", F.xxhash64("passages"))
        .limit(fit_documents)
        .toArrow()
    )
    parts = [np.frombuffer(p, "<f4").reshape(-1, FEATURES) for p in found["passages"].to_pylist()]
    table = np.concatenate(parts) if parts else np.empty((0, FEATURES), np.float32)
    ends = np.cumsum([0, *(len(p) for p in parts)])
    return fit(table.astype(np.float64), ends, found["label"].to_numpy().astype(float), **settings)


def _scores(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    table, ends = passage_features(texts)
    if len(ends) < 2:
        return np.empty(0), np.empty(0), ends
    score, attention = model.attend(table, ends)
    return score, attention, ends


def score_documents(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (id, score, attention), one per row: the score and the weight of each passage.

    Every passage of the whole text counts. A null or empty text is one passage
    of zeros and has a score too. Only the text is looked at. Repeated rows
    score alike; an empty table gives an empty table.
    """
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("body"))
    schema = T.StructType(
        [
            T.StructField(id_col, rows.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
            T.StructField("attention", T.ArrayType(T.FloatType())),
        ]
    )

    def run(batches):
        serve("classifier")
        for batch in batches:
            for a, b in slices(batch.column(1)):
                score, attention, ends = _scores(model, batch.column(1).slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(score, pa.float64()),
                        pa.ListArray.from_arrays(
                            pa.array(ends.astype(np.int32)), pa.array(attention.astype(np.float32))
                        ),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)


def accepted(
    docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, with all columns."""
    at = [c.lower() for c in docs.columns].index(text_col.lower())

    def run(batches):
        serve("classifier")
        for batch in batches:
            for a, b in slices(batch.column(at)):
                part = batch.slice(a, b - a)
                score, _, _ = _scores(model, part.column(at))
                yield part.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)
