"""Phrase mining against a plain version that counts everything in one dictionary."""

import os
import random
import re
import sys
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from test_llm_operators import docs, empty  # noqa: E402, F401

from newsflow.llm import collocations, queries  # noqa: E402

LOWER = {i: i + 32 for i in range(65, 91)}


def plain(rows, min_count, per_lang=2000, percent=100):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            ws = [w for w in re.split("[\x20\x09]+", piece) if w]
            n[lang] += len(ws)
            for size in range(1, 6):
                f.update((lang, tuple(ws[i : i + size])) for i in range(len(ws) - size + 1))
    held = {p: a for p, a in f.items() if a >= min_count and len(p[1]) > 1}
    inside = Counter()
    for (lang, ws), a in held.items():
        for size in range(2, len(ws)):
            for i in range(len(ws) - size + 1):
                key = (lang, ws[i : i + size])
                inside[key] = max(inside[key], a)
    out = []
    for (lang, ws), a in held.items():
        if inside[lang, ws] and 100 * inside[lang, ws] >= percent * a:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws))]
        score, k = min(cuts)
        out.append((lang, " ".join(ws), a, f[lang, ws[:k]], f[lang, ws[k:]], n[lang], score))
    found = []
    for lang in {x[0] for x in out}:
        mine = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:per_lang]
        found += [(lang, i + 1, *x[1:]) for i, x in enumerate(mine)]
    return sorted(found)


def rows():
    rng = random.Random(3)
    words = ["new", "york", "city", "is", "a", "big", "Apple", "naïve", "日本", "x\x00y", "<b>", "of"]
    out = []
    for i in range(300):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))
        text = text.replace("of a", "of,a").replace("is big", rng.choice(["is\tbig", "is  big", "IS big", "is\nbig", "is.big"]))
        if i % 3 == 0:
            text += " New York City is big! new york city IS big\x0b"
        out.append((rng.choice(["en", "fr", None, "und"]), text))
    return out + [("en", None), ("en", ""), ("fr", ". , ;"), ("xx", "a"), ("en", "hot " * 500)]


def frame(spark, held):
    df = spark.createDataFrame(held, "lang string, text string")
    for name in ("n", "key", "phrase", "word", "words", "k", "a", "l", "r", "score", "rank", "trie", "doc_id"):
        df = df.withColumn(name, F.lit("1"))
    return df.repartition(5)


@pytest.mark.parametrize("percent, per_lang", [(100, 2000), (60, 7)])
def test_equals_the_plain_version(spark, percent, per_lang):
    held = rows()
    found = collocations.mine(frame(spark, held), 8, per_lang, percent)
    assert sorted(map(tuple, found.collect())) == plain(held, 8, per_lang, percent)


def test_many_tries_and_crowded_bitmaps_change_nothing(spark, monkeypatch):
    """With 64 bits nearly everything is let through; the tries' counts stay exact."""
    held = rows()
    want = plain(held, 8)
    found, _ = collocations.phrase_counts(frame(spark, held), 8)
    texts = frame(spark, held).select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    every = collocations.candidates(texts, np.full(1 << collocations.BITS - 3, 255, np.uint8))
    assert every.count() > found.count()
    again = collocations.count_phrases(texts, every, nodes=2000).where("n >= 8")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, found.collect()))
    assert want


@settings(max_examples=100, deadline=None)
@given(st.sets(st.lists(st.sampled_from("abcdefgh"), min_size=2, max_size=5).map(" ".join), max_size=40), st.lists(st.sampled_from("abcdefghz\n"), max_size=80))
def test_trie_counts_every_occurrence(phrases, text):
    held = [("en", p) for p in sorted(phrases)]
    if not held:
        return
    trie = collocations.Trie(held)
    counts = trie.count(trie.encode([("en", [w.encode() for w in text]), ("fr", [b"a", b"b"])]))
    for (_, phrase), n in zip(held, counts.tolist(), strict=True):
        ws = phrase.split(" ")
        assert n == sum(text[i : i + len(ws)] == ws for i in range(len(text)))


def test_bitmap_holds_its_keys_and_no_others(spark):
    keys = np.array([0, 1, 2**63, 2**64 - 1, 12345678901234567890, 1 << 37, (1 << 37) * 32767, (1 << 37) * 32768], np.uint64)
    bitmap = collocations.bitmap_of(spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "key long"))
    assert collocations.holds(bitmap, keys).all()
    assert int(np.unpackbits(bitmap).sum()) == len(np.unique(collocations.bit(keys)))


def test_scores_are_exact_beyond_64_bits(spark):
    big = [("en", "a b", 9_007_199_254_740_993), ("en", "a b c", 4_611_686_018_427_387)]
    words = [("en", "a", 9_107_199_254_740_993, 1), ("en", "b", 9_207_199_254_740_997, 2), ("en", "c", 8_611_686_018_427_389, 3)]
    found = collocations.scores(spark.createDataFrame(big, "lang string, phrase string, n long"), spark.createDataFrame(words, "lang string, word string, n long, key long")).collect()
    n, f = sum(w[2] for w in words), {p: a for _, p, a in big} | {w[1]: w[2] for w in words}
    want = {"a b": 1000 * f["a b"] * n // (f["a"] * f["b"]), "a b c": 1000 * f["a b c"] * n // (f["a b"] * f["c"])}
    assert {r.phrase: r.score for r in found if r.phrase != "a b c" or r.k == 2} == {p: s for p, s in want.items() if p == "a b" or len(found) == 2}


def test_query_over_awkward_tables(spark, docs, empty):  # noqa: F811
    held = [(r.lang, r.text) for r in spark.read.parquet(f"{docs}/documents.parquet").select("lang", "text").collect()]
    assert sorted(map(tuple, queries.op12_collocations(spark, docs).collect())) == plain(held, 100)
    assert queries.op12_collocations(spark, empty).collect() == []
