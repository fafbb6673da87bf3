"""Byte-level BPE encoding and decoding, long texts by tree concatenation.

A text beyond ``leaf_chars`` is cut into halves until the parts are short. The
parts are rows of their own, encoded in parallel wherever Spark puts them, and
joined pairwise: around each join a window is encoded again and grows until
its first and last ids are those that both sides had. Within one run of
characters a sequence of BPE ids is right if each neighbouring pair is, so the
outer ids of both sides may then stay.

Short texts are encoded piece by piece. No pre-token spans the place between a
character that is no white space and a space after it, so pieces cut there
have the same ids alone as within their text, and equal pieces are encoded once.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardframe.llm.common import quoted
from wardframe.llm.worker import remembers, serve

LEAF_CHARS = 32_768
SLICE_BYTES = 4 << 20
MEMO_PIECES = 600_000
MEMO_PIECE_CHARS = 64
TOGETHER = 64
FIRST_WINDOW = 32
AGREEING = 4
# White space before a space: the cut there would not be between pre-tokens.
UNSAFE_CUT = r"[\x09-\x0d\x20\x{85}\p{Z}] "

_ENCODERS: dict[str, "Encoder"] = {}


remembers("bpe", _ENCODERS.clear)


def encoder(path: str) -> "Encoder":
    """One encoder per worker process and file."""
    serve("bpe")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Encoder:
    """The tokenizers library over Arrow arrays of texts, with a bounded memo of pieces."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_pieces = self._cuts_at_spaces(json.loads(self.tokenizer.to_str()))
        self.memo: dict[str, bytes] = {}

    @staticmethod
    def _cuts_at_spaces(spec: dict) -> bool:
        before = spec["pre_tokenizer"] or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True)
        added = all(
            not (t["lstrip"] or t["rstrip"]) and not any(c.isspace() for c in t["content"])
            for t in spec["added_tokens"]
        )
        return (
            plain
            and added
            and not before.get("add_prefix_space")
            and not spec["normalizer"]
            and not spec["post_processor"]
            and not spec["model"].get("ignore_merges")
        )

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _together(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that start with a space and end without white space.

        Put behind each other they stay apart, so many are encoded as one text,
        and the ids are dealt out again by the bytes they stand for.
        """
        texts = ["".join(pieces[i : i + TOGETHER]) for i in range(0, len(pieces), TOGETHER)]
        ids = np.frombuffer(b"".join(self.whole(texts)), "<u4")
        upto = np.cumsum(self.id_sizes()[ids])
        ends = np.cumsum([len(p.encode()) for p in pieces])
        at = np.searchsorted(upto, ends)
        if len(pieces) and not (upto[-1] == ends[-1] and np.array_equal(upto[at], ends)):
            return self.whole(pieces)
        raw, cuts = ids.tobytes(), [0, *(4 * (at + 1)).tolist()]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def _spaced(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces, each with a space before it."""
        found = list(map(self.memo.get, pieces))
        new = [i for i, ids in enumerate(found) if ids is None]
        plain = [i for i in new if pieces[i] and not pieces[i][-1].isspace()]
        if len(plain) < len(new):
            odd = [i for i in new if not pieces[i] or pieces[i][-1].isspace()]
            for i, ids in zip(odd, self.whole([" " + pieces[i] for i in odd])):
                found[i] = ids
        for i, ids in zip(plain, self._together([" " + pieces[i] for i in plain])):
            found[i] = ids
        if len(self.memo) + len(new) > MEMO_PIECES:
            self.memo.clear()
        self.memo.update((pieces[i], found[i]) for i in new if len(pieces[i]) <= MEMO_PIECE_CHARS)
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's ids start and end."""
        texts = texts.cast(pa.large_string())
        if len(texts) == 0:
            return np.empty(0, "<u4"), np.zeros(1, np.int64)
        safe = np.zeros(len(texts), bool)
        if self.by_pieces:
            safe = ~pc.match_substring_regex(texts, UNSAFE_CUT).to_numpy(zero_copy_only=False)
        if safe.all():
            return self._by_pieces(texts)
        parts: list[bytes] = [b""] * len(texts)
        odd = np.flatnonzero(~safe)
        for i, ids in zip(odd, self.whole(texts.take(pa.array(odd)).to_pylist())):
            parts[i] = ids
        even = np.flatnonzero(safe)
        if len(even):
            ids, bounds = self._by_pieces(texts.take(pa.array(even)))
            raw = ids.tobytes()
            for n, i in enumerate(even):
                parts[i] = raw[4 * bounds[n] : 4 * bounds[n + 1]]
        ends = np.cumsum([0, *(len(p) // 4 for p in parts)], dtype=np.int64)
        return np.frombuffer(b"".join(parts), dtype="<u4"), ends

    def _by_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.split_pattern(texts, " ")
        starts = split.offsets.to_numpy()[:-1]
        ends = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).copy()
        # The first piece of a text has no space before it and a code of its own.
        firsts = _plain(split.flatten().take(pa.array(starts)))
        pool = self._spaced(_plain(coded.dictionary))
        codes[starts] = len(pool) + np.arange(len(firsts))
        pool += self.whole(firsts)
        # A slice has far fewer than 2^31 ids.
        sizes = np.array([len(p) // 4 for p in pool], dtype=np.int32)
        begins = np.cumsum(sizes, dtype=np.int32) - sizes
        each = sizes[codes]
        upto = np.cumsum(each, dtype=np.int64)
        shift = (begins[codes] - (upto - each)).astype(np.int32)
        take = np.repeat(shift, each) + np.arange(upto[-1], dtype=np.int32)
        ids = np.frombuffer(b"".join(pool), dtype="<u4")[take]
        return ids, np.concatenate([[0], upto])[ends]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)

    def id_bytes(self) -> list[bytes]:
        """The bytes that each id stands for."""
        if not hasattr(self, "_id_bytes"):
            byte_of = _byte_of_char()
            added = self.tokenizer.get_added_tokens_decoder()
            found = [b""] * self.tokenizer.get_vocab_size()
            for token, i in self.tokenizer.get_vocab().items():
                own = i in added
                found[i] = token.encode() if own else bytes(byte_of[c] for c in token)
            self._id_bytes = found
        return self._id_bytes

    def id_sizes(self) -> np.ndarray:
        if not hasattr(self, "_id_sizes"):
            self._id_sizes = np.array([len(b) for b in self.id_bytes()], dtype=np.int64)
        return self._id_sizes

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids of two neighbouring texts taken as one."""
        spelled = self.id_bytes()
        inner = lambda i: spelled[i][:1] and spelled[i][0] & 0xC0 == 0x80
        width = FIRST_WINDOW
        while True:
            start, stop = max(0, len(left) - width), min(len(right), width)
            while start > 0 and inner(left[start]):
                start -= 1
            while stop < len(right) and inner(right[stop]):
                stop += 1
            window = b"".join(spelled[i] for i in (*left[start:], *right[:stop])).decode()
            again = np.frombuffer(self.whole([window])[0], dtype="<u4")
            agree = min(AGREEING, len(again))
            on_left = start == 0 or np.array_equal(again[:agree], left[start : start + agree])
            on_right = stop == len(right) or np.array_equal(again[-agree:], right[stop - agree : stop])
            if on_left and on_right:
                return np.concatenate([left[:start], again, right[stop:]])
            width *= 2

    def join_all(self, parts: list[np.ndarray]) -> np.ndarray:
        """Neighbours joined pairwise, level by level."""
        while len(parts) > 1:
            pairs = [parts[i : i + 2] for i in range(0, len(parts), 2)]
            parts = [self.join(*p) if len(p) == 2 else p[0] for p in pairs]
        return parts[0]


def _plain(strings: pa.Array) -> list[str]:
    """A list of strings without nulls; through numpy, which makes no scalar of each."""
    return strings.to_numpy(zero_copy_only=False).tolist()


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, others follow from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


def halves(text: str, most: int) -> list[str]:
    """The text cut in the middle, again and again, until no part is longer than ``most``."""
    if len(text) <= most:
        return [text]
    middle = len(text) // 2
    return halves(text[:middle], most) + halves(text[middle:], most)


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    begin = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield begin, i
            begin, total = i, 0
        total += int(size) + 16
    if begin < len(sizes):
        yield begin, len(sizes)


def _lists(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))


def _encoded_batches(path: str):
    def run(batches):
        own = encoder(path)
        for batch in batches:
            for a, b in slices(batch.column(1)):
                texts = pc.fill_null(batch.column(1).slice(a, b - a), "")
                ids, ends = own.encode(texts)
                decoded = []
                # A few texts at a time: lists of numbers take much more room than arrays.
                for s in range(0, b - a, TOGETHER):
                    bounds = ends[s : s + TOGETHER + 1]
                    decoded += own.decode([ids[x:y].tolist() for x, y in zip(bounds, bounds[1:])])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        _lists(ids, ends),
                        pa.array(decoded, pa.string()),
                    ],
                    names=["key", "ids", "decoded"],
                )

    return run


def _leaves(most: int):
    def run(batches):
        for batch in batches:
            for digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts = halves(text, most)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([digest] * len(parts), pa.string()),
                        pa.array(range(len(parts)), pa.int32()),
                        pa.array(parts, pa.string()),
                    ],
                    names=["key", "at", "part"],
                )

    return run


def _encoded_leaves(path: str):
    def run(batches):
        own = encoder(path)
        for batch in batches:
            for a, b in slices(batch.column(2)):
                ids, ends = own.encode(batch.column(2).slice(a, b - a))
                raw = [ids[s:e].tobytes() for s, e in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.array(raw, pa.binary()),
                    ],
                    names=["key", "at", "raw"],
                )

    return run


def _joined(path: str):
    def run(group):
        own = encoder(path)
        group = group.sort_values("at")
        ids = own.join_all([np.frombuffer(raw, dtype="<u4") for raw in group["raw"]]).tolist()
        import pandas as pd

        return pd.DataFrame(
            {"key": [group["key"].iloc[0]], "ids": [ids], "decoded": own.decode([ids])}
        )

    return run


def encode_documents(
    docs: DataFrame,
    tokenizer_path: str,
    leaf_chars: int = LEAF_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows (id, ids, decoded): the ids of each whole text and the text they decode to.

    ``tokenizer_path`` is a tokenizers file that every executor can open. No
    special tokens are added, but their strings in a text are special, as in
    the library. A null text is empty and has no ids. Texts beyond
    ``leaf_chars`` code points go through the tree; equal ones among them are
    encoded once, so their copies are not computed again. Repeated rows and
    null ids come back as they are, one row each; other columns are not looked
    at, and an empty table gives an empty table.
    """
    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("body"))
    is_long = F.coalesce(F.char_length("body"), F.lit(0)) > leaf_chars
    of_id = rows.schema["id"].dataType
    fields = [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType()),
    ]
    short = rows.filter(~is_long).mapInArrow(
        _encoded_batches(tokenizer_path), T.StructType([T.StructField("key", of_id), *fields])
    )
    digest = F.sha2(F.col("body").cast("binary"), 256).alias("digest")
    long = rows.filter(is_long).select("id", digest, "body")
    texts = long.groupBy("digest").agg(F.first("body").alias("body"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = texts.mapInArrow(_leaves(leaf_chars), "key string, at int, part string")
    encoded = leaves.repartition(tasks, "key", "at").mapInArrow(
        _encoded_leaves(tokenizer_path), "key string, at int, raw binary"
    )
    joined = encoded.groupBy("key").applyInPandas(
        _joined(tokenizer_path), "key string, ids array<int>, decoded string"
    )
    of_long = long.select("id", "digest").join(joined, F.col("digest") == F.col("key"))
    return short.unionByName(of_long.select(F.col("id").alias("key"), "ids", "decoded")).select(
        F.col("key").alias(id_col), "ids", "decoded"
    )
