import os

import numpy as np
import pytest
from tokenizers import Tokenizer

from wardframe.llm import token_files as F
from wardframe.llm.queries import tokenizer
from wardframe.session import scratch_path

LIBRARY = Tokenizer.from_file(tokenizer())


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [0]


ROWS = [(i * 7 % 101 - 20, f"text {i} " * (i % 13) if i % 5 else None) for i in range(101)]


@pytest.fixture(scope="module")
def written(spark, documents):
    folder = scratch_path(spark, "token-test")
    index = F.write_token_files(documents(ROWS), folder, tokenizer(), frame_bytes=200)
    return folder, index


def test_files_hold_all_ids_in_order(written):
    folder, index = written
    found = sorted(F.read_token_files(folder, index).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted(i for i, _ in ROWS)
    start, texts = 0, dict(ROWS)
    for r in found:
        assert np.frombuffer(r.ids, "<u4").tolist() == ids(texts[r.doc_id])
        assert (r.start, r.n_tokens) == (start, len(r.ids) // 4)
        start += r.n_tokens


def test_only_the_frames_asked_for_are_read(written):
    folder, index = written
    row = index.filter("frame > 0").first()
    path = f"{folder.removeprefix('file://')}/{row.shard}"
    sizes = F.FrameReader(folder, row.shard).table
    whole = open(path, "rb").read()
    # Any other frame of the file may be broken; the one asked for is still read.
    begin = sum(s[0] for s in sizes[: row.frame])
    broken = bytearray(len(whole))
    broken[begin : begin + sizes[row.frame][0]] = whole[begin : begin + sizes[row.frame][0]]
    tail = sum(s[0] for s in sizes)
    broken[tail:] = whole[tail:]
    try:
        open(path, "wb").write(broken)
        found = F.read_token_files(folder, F.pick(index, [row.doc_id])).collect()
        assert np.frombuffer(found[0].ids, "<u4").tolist() == ids(dict(ROWS)[row.doc_id])
        broken[begin + sizes[row.frame][0] // 2] ^= 1
        open(path, "wb").write(broken)
        with pytest.raises(Exception):
            F.FrameReader(folder, row.shard).frame(row.frame)
    finally:
        open(path, "wb").write(whole)


def test_zstandard_reads_the_file_as_one_stream(written):
    import zstandard

    folder, index = written
    for shard in {r.shard for r in index.collect()}:
        with open(f"{folder.removeprefix('file://')}/{shard}", "rb") as file:
            reader = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True)
            raw = reader.read()
        assert len(raw) == sum(4 * r.n_tokens for r in index.filter(f"shard = '{shard}'").collect())


def test_no_drafts_are_left(written):
    names = os.listdir(written[0].removeprefix("file://"))
    assert not [n for n in names if n.startswith(".") and "zst" in n]


def test_null_and_repeated_ids(spark, documents):
    rows = [(None, "b"), (5, "x"), (5, "x"), (5, "y"), (None, None)]
    folder = scratch_path(spark, "token-test")
    index = F.write_token_files(documents(rows), folder, tokenizer())
    found = sorted(F.read_token_files(folder, index).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, None, 5, 5, 5]
    assert sorted(r.ids for r in found) == sorted(np.array(ids(t), "<u4").tobytes() for _, t in rows)


def test_empty_table(spark, documents):
    folder = scratch_path(spark, "token-test")
    index = F.write_token_files(documents([]), folder, tokenizer())
    assert F.read_token_files(folder, index).collect() == []
