"""What op7 hands on from its short lists: few ties, and none lost."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import plain  # noqa: E402

from newsflow.llm import near_dup  # noqa: E402
from newsflow.llm.components import components  # noqa: E402

LISTS = "node long, n long, shingle long, long boolean, crowded long"


def text(rng, n):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def test_copies_of_a_text_are_no_candidates(spark):
    rng = random.Random(3)
    texts = [text(rng, 80) for _ in range(6)]
    frame = spark.createDataFrame([(i, texts[i % 6]) for i in range(24)], "doc_id long, text string").repartition(24, "doc_id")
    firsts = near_dup.first_shingles(frame, near_dup.frequent_shingles(frame))
    assert firsts.count() > 6  # copies lie in several batches
    assert near_dup.shared_lists(firsts).count() == 0


def test_pairs_are_tied_by_what_they_share_together(spark):
    # sets of 100 must share 6 lists: 1 and 2 share five, 2 and 3 six
    lists = [(node, 100, s, False, 0) for s in range(5) for node in (1, 2)] + [(node, 100, s, False, 0) for s in range(10, 16) for node in (2, 3)]
    assert [tuple(r) for r in near_dup.ties(spark.createDataFrame(lists, LISTS)).collect()] == [(2, 3)]


def test_long_lists_tie_those_that_can_link_through_them(spark):
    # sets of 100 need four long lists; 5 and 6 have fewer, so only what 6 shares with 4 in pairs counts, and that is too little
    lists = [(node, 100, s, True, 4) for s in range(4) for node in (1, 2, 3, 4)] + [(node, 100, 0, True, 1) for node in (5, 6)]
    lists += [(node, 100, 20, False, crowded) for node, crowded in ((4, 4), (6, 1))]
    assert sorted(tuple(r) for r in near_dup.ties(spark.createDataFrame(lists, LISTS)).collect()) == [(1, 2), (1, 3), (1, 4)]


@pytest.mark.parametrize("most", [1, 4])
def test_no_link_is_lost(spark, most):
    rng = random.Random(7)
    bases = [text(rng, n).split() for n in (9, 40, 60, 120, 300)]
    rows = []
    for base in bases:
        for _ in range(9):
            words = [w if rng.random() > 0.02 else f"x{rng.randrange(99)}" for w in base]
            rows.append(" ".join(words[: len(words) - rng.randrange(1 + len(words) // 5)]))
    rows = [*enumerate(rows), *((100 + i, text(rng, 30) + " " + " ".join(bases[3][:40])) for i in range(20))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    node = {r.doc_id: r.node for r in near_dup.measured(frame).collect()}
    lists = near_dup.shared_lists(near_dup.first_shingles(frame, near_dup.frequent_shingles(frame)), most=most)
    cluster = {r.node: r.root for r in components(near_dup.ties(lists, most)).collect()}
    classes = [(doc, component) for doc, _, component in plain.near(rows) if component != doc]
    assert len(classes) > 10
    for doc, component in classes:
        a, b = node[doc], node[component]
        assert a == b or cluster.get(a, a) == cluster.get(b, b)
    got = near_dup.classes(frame).collect()
    assert sorted(tuple(r) for r in got) == sorted(map(tuple, plain.near(rows)))
