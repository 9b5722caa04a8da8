"""op12 reads the runs once for several tries, and handles only a block's distinct words one by one."""

import random

import pyarrow as pa
import pytest

from newsflow.llm import collocations


def test_runs_are_read_once_for_several_tries(spark, monkeypatch):
    rng = random.Random(5)
    texts = [(rng.choice(["en", "fr"]), " ".join(rng.choice("abcdefghij") for _ in range(30))) for _ in range(40)]
    phrases = sorted({(lang, t[i : i + n]) for lang, t in texts for n in (3, 5, 9) for i in range(0, len(t) - n + 1, 2)})
    passes, counted = [], collocations._counted
    monkeypatch.setattr(collocations, "_counted", lambda *args: passes.append(1) or counted(*args))
    frame = spark.createDataFrame(texts, "lang string, text string").repartition(3)
    found = collocations.count_phrases(frame, spark.createDataFrame(phrases, "lang string, phrase string"), nodes=len(phrases))
    got = {(r.lang, r.phrase): r.n for r in found.collect()}
    assert got == {(lang, p): sum(t[i:].startswith(p) for x, t in texts if x == lang for i in range(0, len(t), 2)) for lang, p in phrases}
    assert len(passes) == 1  # five tries


@pytest.mark.parametrize("texts", [[], [""], ["", "a"], ["a", "", "A b\tc.d", "", "\n", "e"], ["x" * 9, " y ", ". ,z\x0bz", "日本 naïve\x00 É"], [" ", "  "]])
def test_cut(texts):
    for held in (pa.array(texts, pa.string()), pa.array(["q q", *texts, "q"], pa.string()).slice(1, len(texts))):
        block = collocations.cut("en", held)
        lower = [t.translate({i: i + 32 for i in range(65, 91)}) for t in texts]
        want, owners = [], []
        for i, t in enumerate(lower):
            for c in ".,;:!?\x0b\x0c\x0d":
                t = t.replace(c, "\n")
            for piece in t.split("\n"):
                found = [w.encode() for w in piece.replace("\t", " ").split(" ") if w]
                want += [None, *found] if found else []
                owners += [i] * len(found)
        assert [block.distinct[c - 1] if c else None for c in block.codes.tolist()] == [*want, None]
        assert block.owners.tolist() == owners and (block.codes[block.places] > 0).all()
