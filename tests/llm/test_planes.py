"""Bit planes: exact round trips, ranges, and whole tables against the tokenizers library."""

import io
import os
import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from test_llm_operators import ROWS, docs, empty  # noqa: E402, F401

from newsflow.llm import planes, queries  # noqa: E402


class Held(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def reader(data):
    return planes.PlaneReader(Held(data))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=40), max_size=20), st.integers(1, 33), st.sampled_from([True, False, None]))
def test_round_trip(lists, chunk, bits):
    held = [(None if i % 5 == 4 else -i, np.array(x, np.uint32)) for i, x in enumerate(lists)]
    r = reader(planes.to_bytes(held, chunk, bits))
    every = np.concatenate([np.zeros(0, np.uint32), *[x for _, x in held]])
    assert r.index["n_ids"] == len(every)
    assert [d for b in range(len(r.blocks)) for d in r.documents(b)] == [(d, len(x)) for d, x in held]
    for start in range(0, len(every) + 1, 7):
        for stop in (start, start + 1, start + chunk, len(every)):
            stop = min(stop, len(every))
            assert r.ids(start, stop).tolist() == every[start:stop].tolist()


def test_blocks_end_at_their_limits():
    held = [(i, np.full(3, i, np.uint32)) for i in range(planes.BLOCK_DOCS + 5)] + [(-1, np.zeros(planes.BLOCK_IDS + 9, np.uint32)), (-2, np.ones(1, np.uint32))]
    r = reader(planes.to_bytes(held))
    assert [b["n_docs"] for b in r.blocks] == [planes.BLOCK_DOCS, 6, 1]
    assert r.ids(r.index["n_ids"] - 1, r.index["n_ids"]).tolist() == [1]


def test_a_cut_or_changed_file_is_refused():
    data = planes.to_bytes([(1, np.arange(5000, dtype=np.uint32))])
    with pytest.raises(ValueError):
        reader(data[:-1])
    at = len(planes.MAGIC) + 30
    broken = data[:at] + bytes([data[at] ^ 255]) + data[at + 1 :]
    with pytest.raises(Exception):  # noqa: B017
        reader(broken).ids(0, 5000)


def test_query_equals_the_library(spark, docs):  # noqa: F811
    library = Tokenizer.from_file(queries.WORD_TOKENIZER)
    ids = lambda t: np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
    found = queries.op11_binary_ids(spark, docs).collect()
    order = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in order] == sorted((d for d, _ in ROWS), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in order:
        assert r.start == at
        at += r.n_tokens
    want = sorted((str(d), len(x), zlib.crc32(x.tobytes())) for d, x in ((d, ids(t)) for d, t in ROWS))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in found) == want


def test_files_that_the_manifest_does_not_list_are_not_read(spark, docs, tmp_path):  # noqa: F811
    frame = spark.read.parquet(f"{docs}/documents.parquet")
    first = planes.write(frame, queries.WORD_TOKENIZER, str(tmp_path))
    again = planes.write(frame, queries.WORD_TOKENIZER, str(tmp_path))  # as if every task had run twice
    assert first.select("file").distinct().count() * 2 == len(list(tmp_path.glob("*.planes")))
    for manifest in (first, again):
        assert planes.read(manifest).count() == len(ROWS)


def test_empty_table(spark, empty):  # noqa: F811
    assert queries.op11_binary_ids(spark, empty).collect() == []
