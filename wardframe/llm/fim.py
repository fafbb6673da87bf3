"""Fill-in-middle by displacement scatter.

A text is cut into prefix, middle and suffix between its units (runs of ASCII
letters, or one other code point). For many texts at once a scan over the bytes
finds the cuts; the distance that a byte moves changes only at the bounds of the
three parts, so a difference array holds the changes, its running sum the
distance of every byte, and one scatter writes all outputs. Restoring finds the
marks in the output, and gathers the bytes back by the same sums.

Bytes are moved in blocks, so the sums need a fixed amount of memory whatever
the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardframe.llm.bpe import slices
from wardframe.llm.common import quoted
from wardframe.llm.wordbytes import bytes_of

# The marks of prefix, suffix and middle, and the names of the orders.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED = "1:"
CHANGED_PERCENT = 90
SPM_PERCENT = 20
SLICE_BYTES = 2 << 20
BLOCK = 1 << 20
SCAN_BLOCK = 4096

_BYTES = np.arange(256)
_LETTER = ((_BYTES | 32) >= ord("a")) & ((_BYTES | 32) <= ord("z")) & (_BYTES < 128)
_LEADS = (_BYTES & 0xC0) != 0x80


class Scan:
    """Flags of bytes, counted per block: how many lie before a place, and where the k-th is."""

    def __init__(self, flags: np.ndarray):
        self.flags = flags
        starts = np.arange(0, len(flags), SCAN_BLOCK)
        each = [np.count_nonzero(flags[a : a + SCAN_BLOCK]) for a in starts]
        self.upto = np.concatenate([[0], np.cumsum(each, dtype=np.int64)])

    def before(self, places: np.ndarray) -> np.ndarray:
        blocks = places // SCAN_BLOCK
        inner = [np.count_nonzero(self.flags[b * SCAN_BLOCK : p]) for b, p in zip(blocks, places)]
        return self.upto[blocks] + np.array(inner, np.int64)

    def places(self, ranks: np.ndarray) -> np.ndarray:
        """The place of the flag with each rank; the end where there are not so many."""
        blocks = np.searchsorted(self.upto, ranks, "right") - 1
        found = np.full(len(ranks), len(self.flags), np.int64)
        for i, (block, rank) in enumerate(zip(blocks, ranks)):
            if rank < self.upto[-1]:
                start = block * SCAN_BLOCK
                own = np.flatnonzero(self.flags[start : start + SCAN_BLOCK])
                found[i] = start + own[rank - self.upto[block]]
        return found


def unit_starts(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Flags of the bytes where a unit of any text starts."""
    size = int(bounds[-1])
    flags = _LEADS[raw[:size]]
    if size:
        letter = _LETTER[raw[:size]]
        runs_on = letter[1:] & letter[:-1]
        edges = bounds[1:-1]
        runs_on[edges[(edges > 0) & (edges < size)] - 1] = False
        flags[1:] &= ~runs_on
    return flags


def displacements(at: np.ndarray, shifts: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first byte, distances) of each block, where ``shifts[i]`` holds from byte ``at[i]`` on.

    Of several shifts at one place the last holds.
    """
    steps, carry = np.diff(shifts, prepend=0), 0
    for a in range(0, size, BLOCK):
        b = min(a + BLOCK, size)
        first, last = np.searchsorted(at, [a, b])
        change = np.zeros(b - a, np.int64)
        np.add.at(change, at[first:last] - a, steps[first:last])
        change[0] += carry
        moved = np.cumsum(change)
        carry = moved[-1]
        yield a, moved


def _strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer(bounds.astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, offsets, pa.py_buffer(data)])


def _ends(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def scatter(texts: pa.Array, draws: np.ndarray, changed_percent: int, spm_percent: int) -> list[pa.Array]:
    """Columns n, form, prefix_chars, middle_chars and output of texts with four draws each."""
    raw, bounds = bytes_of(texts)
    size, begin, end = int(bounds[-1]), bounds[:-1], bounds[1:]
    units, leads = Scan(unit_starts(raw, bounds)), Scan(_LEADS[raw[:size]])
    ranks = units.before(bounds)
    n = np.diff(ranks)
    two = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    cuts = [
        np.where(k == n, end, units.places(np.where(k == n, units.upto[-1], ranks[:-1] + k))) for k in two.T
    ]
    marked = np.zeros(len(texts), bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= pc.fill_null(pc.match_substring(texts, mark), False).to_numpy(zero_copy_only=False)
    plain = (begin == end) | marked | (draws[:, 2] % 100 >= changed_percent)
    spm = ~plain & (draws[:, 3] % 100 < spm_percent)

    head, inner, tail = cuts[0] - begin, cuts[1] - cuts[0], end - cuts[1]
    out_bounds = _ends(end - begin + np.where(plain, 0, 9))
    start = out_bounds[:-1]
    # Where the parts go, and the marks that stand before them.
    to_head = start + np.where(spm, 3 + tail + 3, 3)
    to_tail = start + np.where(spm, 3, 3 + head + 3)
    to_inner = start + 9 + head + tail
    shifts = np.stack([to_head - begin, to_inner - cuts[0], to_tail - cuts[1]], axis=1)
    shifts[plain] = (start - begin)[plain, None]
    out = np.empty(int(out_bounds[-1]), np.uint8)
    at = np.stack([begin, cuts[0], cuts[1]], axis=1).ravel()
    for a, moved in displacements(at, shifts.ravel(), size):
        out[moved + np.arange(a, a + len(moved))] = raw[a : a + len(moved)]
    for mark, place in ((PREFIX, to_head), (SUFFIX, to_tail), (MIDDLE, to_inner)):
        for k, byte in enumerate(mark.encode()):
            out[place[~plain] - 3 + k] = byte

    chars = np.diff([leads.before(p) for p in (begin, *cuts)], axis=0)
    form = np.where(plain, PLAIN, np.where(spm, SPM, PSM))
    return [
        pa.array(n, pa.int64()),
        pa.array(form.tolist(), pa.string()),
        pa.array(chars[0], pa.int64(), mask=plain),
        pa.array(chars[1], pa.int64(), mask=plain),
        _strings(out, out_bounds),
    ]


def gather(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    """The texts that the outputs were made of, from output and form alone."""
    raw, bounds = bytes_of(outputs)
    size, begin, end = int(bounds[-1]), bounds[:-1], bounds[1:]
    names = np.array(pc.fill_null(forms, PLAIN).to_pylist(), object)
    plain, spm = names == PLAIN, names == SPM
    tip = np.flatnonzero(raw[:size] == ord("<"))
    tip = tip[(raw[tip + 2] == ord(">")) & np.isin(raw[tip + 1], list(b"PSM"))]
    owner = np.searchsorted(bounds, tip, "right") - 1
    whole = (tip + 3 <= end[owner]) & ~plain[owner]
    tip, owner = tip[whole], owner[whole]
    if not np.array_equal(owner, np.repeat(np.flatnonzero(~plain), 3)):
        raise ValueError("an output does not hold its three marks")
    first, second, third = tip.reshape(-1, 3).T
    here = np.flatnonzero(~plain)
    turned = spm[here]
    # Places of the parts in the output: the two outer ones in either order, then the middle.
    from_head, from_tail, from_inner = begin.copy(), begin.copy(), begin.copy()
    from_head[here] = np.where(turned, second, first) + 3
    from_tail[here] = np.where(turned, first, second) + 3
    from_inner[here] = third + 3
    head, inner = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
    head[here] = np.where(turned, third, second) - from_head[here]
    inner[here] = end[here] - from_inner[here]
    old = _ends(end - begin - np.where(plain, 0, 9))
    at = np.stack([old[:-1], old[:-1] + head, old[:-1] + head + inner], axis=1)
    shifts = np.stack([from_head, from_inner, from_tail], axis=1) - at
    shifts[plain] = (begin - old[:-1])[plain, None]
    text = np.empty(int(old[-1]), np.uint8)
    for a, moved in displacements(at.ravel(), shifts.ravel(), len(text)):
        text[a : a + len(moved)] = raw[moved + np.arange(a, a + len(moved))]
    return _strings(text, old)


def draws_of(id_col, seed: str = SEED) -> list:
    """The first four 8-digit groups of the hash of an id, as unsigned integers."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def fill_in_middle(
    docs: DataFrame,
    seed: str = SEED,
    changed_percent: int = CHANGED_PERCENT,
    spm_percent: int = SPM_PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows (id, n, form, prefix_chars, middle_chars, output), one per document.

    Cuts and order follow from the hash of ``seed`` and the id, so a document
    comes out alike in every run. ``n`` counts units. A text that is empty,
    holds a mark, or is not drawn stays as it is: its form is ``plain`` and its
    counts are null. A null text is empty; a null id draws as an empty one.
    Repeated rows come out alike, one each. Other columns are not looked at; an
    empty table gives an empty table.
    """
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("body"))
    schema = T.StructType(
        [
            T.StructField(id_col, rows.schema["id"].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("form", T.StringType()),
            T.StructField("prefix_chars", T.LongType()),
            T.StructField("middle_chars", T.LongType()),
            T.StructField("output", T.StringType()),
        ]
    )

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE_BYTES):
                part = batch.slice(a, b - a)
                draws = np.stack([part.column(2 + k).to_numpy() for k in range(4)], axis=1)
                made = scatter(part.column(1), draws, changed_percent, spm_percent)
                yield pa.RecordBatch.from_arrays([part.column(0), *made], names=schema.names)

    return rows.select("id", "body", *draws_of(F.col("id"), seed)).mapInArrow(run, schema)


def restore(cut: DataFrame) -> DataFrame:
    """The rows of ``cut`` with ``restored``, rebuilt from ``output`` and ``form``.

    A null output is empty, a null form plain. An output that its form does not
    fit is an error.
    """
    names = cut.columns
    schema = T.StructType([*cut.schema.fields, T.StructField("restored", T.StringType())])
    output, form = names.index("output"), names.index("form")

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(output), SLICE_BYTES):
                part = batch.slice(a, b - a)
                text = gather(part.column(output), part.column(form))
                yield pa.RecordBatch.from_arrays([*part.columns, text], names=[*names, "restored"])

    return cut.mapInArrow(run, schema)
