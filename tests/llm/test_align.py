"""Token alignment against a plain version that walks both token lists."""

import hashlib
import os
import sys
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from test_llm_operators import ROWS, docs, empty  # noqa: E402, F401

from newsflow.llm import align, queries  # noqa: E402

VOCAB = align.vocabularies(queries.BYTE_TOKENIZER, queries.PIECE_MODEL)
A = Tokenizer.from_file(queries.BYTE_TOKENIZER)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)


def plain(text):
    """Groups of ids, or None where a side does not give the text back."""
    if not text:
        return None
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    sides, whole = [], (" " + text).encode()
    for ids, names in ((a, VOCAB.a_bytes), (b, VOCAB.b_bytes)):
        ends, at = [], 0
        for i in ids:
            at += len(names[i])
            ends.append(at)
        if b"".join(names[i] for i in ids) != whole:
            return None
        sides.append((ids, ends))
    shared = sorted(set(sides[0][1]) & set(sides[1][1]))
    groups, at = [], [0, 0]
    for end in shared:
        stops = [ends.index(end, start) + 1 for (_, ends), start in zip(sides, at, strict=True)]
        groups.append(tuple(ids[start:stop] for (ids, _), start, stop in zip(sides, at, stops, strict=True)))
        at = stops
    return groups


def shown(groups):
    return hashlib.sha256(";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups).encode()).hexdigest() if groups else ""


@pytest.fixture(scope="module")
def aligner():
    return align.Aligner(VOCAB, VOCAB.pairs)


ODD = ["a", "  two  spaces ", " x", "tab\there", "line\n\nend \n", "naïve Étre 日本語 ß", "<|endoftext|><s></s>", "▁ mark", "a▁b", "\x00", "'ll we're 12345", "　wide\xa0", "é", "🙂🙂", "x" * 700, "\x1c s"]


def test_odd_texts(aligner):
    for text, (n_a, n_b, n_groups, sha, links) in zip(ODD, aligner.align(ODD), strict=True):
        groups = plain(text)
        want = (0, 0, 0, "") if groups is None else (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), shown(groups))
        assert (n_a, n_b, n_groups, sha) == want, text
        codes = VOCAB.pairs[np.frombuffer(links, "<u4")].tolist()
        assert codes == [a[-1] << 32 | b[-1] for a, b in groups or []]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60) | st.text("ab é\n\t<|>日▁", max_size=40), max_size=5))
def test_any_text(texts):
    held = test_any_text.aligner
    for text, (_, _, n_groups, sha, _) in zip(texts, held.align(texts), strict=True):
        groups = plain(text)
        assert (n_groups, sha) == (len(groups or []), shown(groups)), text


test_any_text.aligner = align.Aligner(VOCAB, VOCAB.pairs)


def test_long_texts_go_in_windows(monkeypatch):
    text = " ".join(f"word{i % 97} naïve{i}" for i in range(3000))
    whole = align.Aligner(VOCAB, VOCAB.pairs).align([text])
    monkeypatch.setattr(align, "WINDOW", 50)
    assert align.Aligner(VOCAB, VOCAB.pairs).align([text]) == whole
    assert whole[0][3] == shown(plain(text))


@given(st.lists(st.tuples(st.lists(st.integers(1, 5), min_size=1, max_size=12), st.lists(st.integers(1, 5), min_size=1, max_size=12)), min_size=1, max_size=4))
def test_overlaps_are_all_pairs_that_share_bytes(texts):
    sides, base = [[], []], 0
    for i, pair in enumerate(texts):
        size = max(map(sum, pair))
        for side, sizes in zip(sides, pair, strict=True):
            at = base
            for n in [*sizes, size - sum(sizes)]:
                if n:
                    side.append((i, at, at + n))
                at += n
        base += size
    a, b = (pd.DataFrame(s, columns=["doc", "start", "end"]) for s in sides)
    want = [(i, j) for i, x in enumerate(sides[0]) for j, y in enumerate(sides[1]) if max(x[1], y[1]) < min(x[2], y[2])]
    assert list(align.overlaps(a, b).itertuples(index=False, name=None)) == want


def test_query_equals_the_plain_version(spark, docs):  # noqa: F811
    groups = {}
    for _, text in ROWS:
        if text not in groups:
            groups[text] = plain(text) or []
    count = Counter((a[-1], b[-1]) for _, text in ROWS for a, b in groups[text])
    highest = {}
    for (_, b), n in count.items():
        highest[b] = max(n, highest.get(b, 0))
    want = []
    for doc, text in ROWS:
        g = groups[text]
        links = [(a[-1], b[-1]) for a, b in g]
        want.append((doc, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
                     sum(count[x] == highest[x[1]] for x in links), sum(count[x] for x in links), shown(g)))
    found = [tuple(r) for r in queries.op13_token_alignment(spark, docs).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    frame = spark.read.parquet(f"{docs}/documents.parquet")
    pairs = align.id_pairs(align.pair_counts(align.align(frame, VOCAB), VOCAB), VOCAB).collect()
    assert {(r.a, r.b): r.n for r in pairs} == dict(count)


def test_empty_table(spark, empty):  # noqa: F811
    assert queries.op13_token_alignment(spark, empty).collect() == []
