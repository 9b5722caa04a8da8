"""Parts that run inside tasks, against plain versions of the same."""

import itertools
import random
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from newsflow.llm import near_dup, packing, quality, sharding, toxicity
from newsflow.llm.bpe import Codec, large, read_spec
from newsflow.llm.cuckoo import CuckooFilter, Shard
from newsflow.llm.lexicon import Decoder, LexiconCodec, Transducer, word_counts

ALPHABET = " \t\n\r\x0b\x1c\x85\xa0'abcSTdé1²_.<|>İßΣ日́🙂lvrem"
MARKS = ["", "<|endoftext|>x <|startoftext|>", "I'll don't  \t\n x", "é́ ß İx Ǆ", "Σας ΣΑΣ", "²³ ½ 12a_b__", "\n\n x\n", "ábc a ́x", " ", "ﬁ 🙂🙂x"]


@pytest.fixture(scope="module", params=["word_bpe_49k.json", "byte_bpe_50k.json"])
def codec(request):
    spec = read_spec(public_tokenizers.path(request.param))
    return Codec(spec, kept=50), Tokenizer.from_str(spec)


def test_codec_is_exact_on_marks(codec):
    own, library = codec
    for text, ids in zip(MARKS, own.encode(MARKS), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(ALPHABET, max_size=30), max_size=8))
def test_codec_is_exact(codec, texts):
    own, library = codec
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_codec_looks_up_the_distinct_pieces_of_a_batch(codec, monkeypatch):
    own, library = codec
    asked, look_up = [], own.look_up
    monkeypatch.setattr(own, "look_up", lambda pieces: (asked.append(len(pieces)), look_up(pieces))[1])
    texts = ["the cat, the mat", None, "  the cat  ", "日本 the"] * 100
    for text, ids in zip(texts, own.encode(pa.array(texts)), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids
    assert sum(asked) < 20


def test_codec_takes_a_column_of_several_blocks(codec):
    own, library = codec
    texts = [f"{i} a\x1cb  c\xa0d\u3000e {i % 7}'s " if i % 3 else None for i in range(2_100)]
    want = [x.ids for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    column = pa.array(["cut off", *texts]).slice(1)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in own.encode(column)] == want


def test_codec_is_exact_on_any_white_space(codec):
    own, library = codec
    texts = ["".join(x) for n in range(6) for x in itertools.product(" \n\ta\x01\xa0", repeat=n)]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in own.encode(texts)] == want


@settings(max_examples=100, deadline=None)
@given(words=st.sets(st.binary(min_size=1, max_size=6), max_size=40), others=st.lists(st.binary(min_size=1, max_size=6), max_size=20))
def test_transducer_finds_just_its_words(words, others, tmp_path_factory):
    ordered = sorted(words)
    ids = [np.arange(i, i + i % 3 + 1, dtype="<u4").tobytes() for i in range(len(ordered))]
    path = str(tmp_path_factory.mktemp("lexicon") / "t")
    Transducer.build(ordered, ids).save(path)
    opened = Transducer.open(path)
    asked = [*ordered, *others]
    places = {w: i for i, w in enumerate(ordered)}
    found = opened.find(asked).tolist() if asked else []
    assert found == [places.get(w, -1) for w in asked]
    for word, at in places.items():
        assert opened.ids[opened.ends[at] : opened.ends[at + 1]].tolist() == np.frombuffer(ids[at], "<u4").tolist()


def test_transducer_shares_suffixes():
    words = sorted(a + b"ation" for a in (b"st", b"n", b"form", b"rel"))
    built = Transducer.build(words, [b"\0\0\0\0"] * 4)
    assert len(built.final) < len({w[:i] for w in words for i in range(len(w) + 1)})


def test_lexicon_codec_is_exact():
    spec = read_spec(public_tokenizers.path("byte_bpe_50k.json"))
    words = sorted(w.encode() for w in (" the", "the", " of", " naïve", "."))
    own = LexiconCodec(spec, Transducer.build(words, Codec(spec).merges.encode(words)))
    library = Tokenizer.from_str(spec)
    for text in ["the cat of the naïve. the", "unheard-of words  the", *MARKS]:
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_of_a_batch_are_counted_from_its_distinct_pieces():
    codec = Codec(read_spec(public_tokenizers.path("byte_bpe_50k.json")))
    texts, found = ["a bb  a's", "\\n bb a"] * 50, Counter()
    for _, pieces, _ in codec.pieces(large(texts)):
        counts = pieces.value_counts()
        assert len(counts) < 9
        table = word_counts(codec.words(counts.field("values").to_pylist()), counts.field("counts").to_numpy())
        found.update(dict(zip(table["word"].to_pylist(), table["n"].to_pylist(), strict=True)))
    assert found == Counter(w for t in texts for w in codec.pattern.findall(t))


def test_decoder_takes_rows_of_ids_and_cut_characters():
    spec = read_spec(public_tokenizers.path("byte_bpe_50k.json"))
    library = Tokenizer.from_str(spec)
    rows = [library.encode(t, add_special_tokens=False).ids for t in MARKS]
    rows += [[], rows[3][:1], rows[3][1:], [len(library.get_vocab()) - 1]]
    assert Decoder(spec).decode([np.array(r, "<u4").tobytes() for r in rows]) == [library.decode(r, skip_special_tokens=False) for r in rows]


def test_cuckoo_filter_holds_deletes_and_fills():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 4000, dtype=np.uint64)
    held = CuckooFilter.sized(len(keys))
    assert held.insert(keys) and held.contains(keys).all()
    others = np.random.default_rng(2).integers(0, 1 << 63, 4000, dtype=np.uint64)
    assert held.contains(others).mean() < 0.01
    held.delete(keys[:2000])
    assert held.contains(keys[2000:]).all() and held.contains(keys[:2000]).mean() < 0.01
    assert not CuckooFilter.sized(10).insert(keys)


def test_shard_grows_from_stored_keys_and_tells_false_hits():
    rng = np.random.default_rng(3)
    keys = np.stack([rng.integers(0, 1 << 63, 3000, dtype=np.uint64), np.arange(3000, dtype=np.uint64)], 1)
    empty = np.empty(0, np.int64)
    shard = Shard(np.empty((0, 2), np.uint64), empty, np.empty((0, 2), np.int64))
    small = len(shard.filter.cells)
    best = np.stack([np.zeros(3000, np.int64), np.arange(3000)], 1)
    shard.add(keys, np.ones(3000, np.int64), best)
    assert len(shard.filter.cells) > small and (shard.find(keys) == np.arange(3000)).all()
    alike = keys.copy()
    alike[:, 1] += np.uint64(5000)  # same fingerprints and buckets, other keys
    assert (shard.find(alike) == -1).all()
    shard.add(alike[:10], np.full(10, 2), best[:10])
    shard.add(keys[:10], np.full(10, 3), best[:10] + 1)
    assert shard.n[:10].tolist() == [4] * 10 and shard.n[3000:].tolist() == [2] * 10
    shard.put(keys[:5], np.zeros(5, np.int64), best[:5])
    assert (shard.find(keys[:5]) == -1).all() and (shard.find(keys[5:]) >= 0).all() and (shard.find(alike[:10]) >= 0).all()


@settings(max_examples=100, deadline=None)
@given(lengths=st.lists(st.integers(1, 700), max_size=60))
def test_packing_covers_and_fills(lengths):
    ids = [np.arange(n, dtype="<u4") for n in lengths]
    pieces = packing.pack_block(ids, 64, 1.0, 0.01)
    covered, filled = Counter(), {}
    for doc, start, length, seq, offset in pieces:
        covered.update((doc, i) for i in range(start, start + length))
        filled.setdefault(seq, []).append((offset, length))
    assert len(covered) == sum(lengths) and set(covered.values()) <= {1}
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64 and at & (at - 1) == 0


def test_packing_balances_cost():
    lengths = [random.Random(5).randint(1, 40) for _ in range(400)]
    pieces = packing.pack_block([np.arange(n, dtype="<u4") for n in lengths], 64, 1.0, 0.05)
    cost = Counter()
    for _, _, length, seq, _ in pieces:
        cost[seq] += packing.cost(length, 1.0, 0.05)
    full = [c for s, c in cost.items() if sum(p[2] for p in pieces if p[3] == s) == 64]
    assert max(full) < 1.6 * (sum(full) / len(full))


def plain_fill(shards, slots):
    orders = []
    for s in shards:
        at, step = sharding._digest("offset", s) % slots, sharding._digest("step", s) % (slots - 1) + 1
        orders.append([(at + j * step) % slots for j in range(slots)])
    table, claimed = [-1] * slots, 0
    while claimed < slots:
        for i, order in enumerate(orders):
            if claimed < slots:
                table[next(x for x in order if table[x] < 0)] = i
                claimed += 1
    return table


def test_table_fills_by_turns_and_moves_little():
    names = tuple(f"s{i}" for i in range(7))
    table = sharding.fill(names, 211)
    assert table.tolist() == plain_fill(names, 211)
    counts = np.bincount(table)
    assert counts.max() - counts.min() <= 1
    fewer = sharding.fill(names[:-1], 211)
    assert (fewer[table < 6] != table[table < 6]).mean() < 0.2
    with pytest.raises(ValueError):
        sharding.fill(names, 210)


def test_repeated_words():
    assert quality.repeated_words(b"a b c d".split()) == 0
    assert quality.repeated_words(b"a b c a b c".split()) == 6
    assert quality.repeated_words(b"a a a a".split()) == 4
    assert quality.repeated_words(b"x a b c y a b c".split()) == 6


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text("ab .!\n\tc", max_size=60), min_size=1, max_size=4))
def test_sentences_are_those_of_the_bags(texts):
    _, _, doc = toxicity.bags(toxicity.Words(), texts)
    assert np.bincount(doc, minlength=len(texts)).tolist() == [len(toxicity.sentences(t)) for t in texts]


def test_instances_are_learnt_from_document_labels():
    rng = random.Random(4)
    texts, labels = [], []
    for i in range(300):
        parts = [" ".join(rng.choice(["sun", "rain", "wind", "snow", "fog"]) for _ in range(8)) + "." for _ in range(5)]
        if i % 4 == 0:
            parts[rng.randrange(5)] = "you vile grumbler go away now."
        texts.append(" ".join(parts))
        labels.append(int(i % 4 == 0))
    scorer = toxicity.Scorer(toxicity.fit(texts, labels))
    scores, parts = scorer.score(texts)
    assert min(s for s, y in zip(scores, labels, strict=True) if y) > 0.6 > 0.3 > max(s for s, y in zip(scores, labels, strict=True) if not y)
    worst = int(np.argmax(parts[0]))
    start, end = toxicity.sentences(texts[0])[worst]
    assert texts[0][start:end] == "you vile grumbler go away now."


def rare_words(n):
    rng = random.Random(5)
    texts = [" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10 ** 6):06d}é{'.' * (k % 9 == 8)}" for k in range(150)) for _ in range(n)]
    return texts, [int(i % 3 == 0) for i in range(n)]


def test_training_holds_little_beside_the_numbers_of_words(monkeypatch):
    texts, labels = rare_words(1000)
    monkeypatch.setattr(toxicity, "KEPT", 20_000, raising=False)
    tracemalloc.start()
    try:
        toxicity.fit(texts, labels, steps=1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 300 * 150_000  # bytes a word, nearly all of them distinct


@pytest.mark.parametrize("size", [1, 7, 300])
def test_training_does_not_depend_on_the_slices(size, monkeypatch):
    texts, labels = rare_words(300)
    texts = [t + " common words here. " + "the vile grumbler and others." * y + "\nthe end" for t, y in zip(texts, labels, strict=True)]
    whole = toxicity.fit(texts, labels, steps=20)
    monkeypatch.setattr(toxicity, "KEPT", 50)
    cut = toxicity.fit_slices(((texts[i : i + size], labels[i : i + size]) for i in range(0, 300, size)), steps=20)
    assert whole.weights.any() and whole.bias == cut.bias and (whole.weights == cut.weights).all()


def test_texts_without_words_teach_the_bias_only():
    model = toxicity.fit(["", " ", "..."], [0, 1, 0])
    assert not model.weights.any() and model.bias > toxicity.PRIOR


def plain_sets(text):
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in
             "".join(c if c not in "\t\n\x0b\x0c\r" else " " for c in text).split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.text("aB \n\x0bé\x85", max_size=40), min_size=1, max_size=6))
def test_shingle_sets_match_plain_ones(texts):
    made = near_dup.shingle_sets(texts)
    plain = [plain_sets(t) for t in texts]
    assert [len(s) for s in made] == [len(s) for s in plain]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(made[i], made[j])) == len(plain[i] & plain[j])
            assert (near_dup.digest(made[i]) == near_dup.digest(made[j])) == (plain[i] == plain[j])


def test_search_connects_as_all_pairs_do():
    rng = np.random.default_rng(6)
    base = np.sort(rng.integers(0, 1 << 63, 80, dtype=np.uint64))
    sets = []
    for _ in range(120):
        own = base.copy() if rng.random() < 0.7 else rng.integers(0, 1 << 63, 80, dtype=np.uint64)
        out = rng.integers(0, len(own), rng.integers(0, 14))
        own[out] = rng.integers(0, 1 << 63, len(out), dtype=np.uint64)
        sets.append(np.unique(own))
    parent = list(range(len(sets)))

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for i in range(len(sets)):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert near_dup.Links(sets).connect().tolist() == [root(i) for i in range(len(sets))]


def test_a_merge_looks_up_only_the_pairs_beside_it(monkeypatch):
    merges, asked = Codec(read_spec(public_tokenizers.path("word_bpe_49k.json"))).merges, []
    ranks = merges.ranks
    monkeypatch.setattr(merges, "ranks", lambda left, right: (asked.append(len(left)), ranks(left, right))[1])
    words = ["internationalisation", "zqxjkvbw", "the", "a"]
    found = merges.encode([w.encode() for w in words])
    made = sum(map(len, words)) - sum(len(x) // 4 for x in found)
    assert sum(asked) <= sum(len(w) - 1 for w in words) + 2 * made
