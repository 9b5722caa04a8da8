"""Collocations: phrases of two to five words that stand together more often than their parts explain.

Counting goes over the whole corpus, by language. No phrase can be frequent unless every phrase inside it is,
so each pass over the texts passes on less:

1. words are counted exactly;
2. pairs of frequent words are counted by a 64-bit hash, added up in the tasks first;
3. texts are reduced to runs in which every neighbouring pair is frequent; only these runs are kept;
4. phrases of three to five words of the runs are counted by hash; what is frequent there, as phrases, are the
   candidates. Bits that meet only add candidates, never lose one; two phrases of one 64-bit key count as one,
   of which there is far less than one in a corpus of a billion phrases;
5. candidates are dealt by their first two words into double-array tries of a bounded size. ``TOGETHER`` tries are
   broadcast at a time; a position of a text asks the one trie that its two words lead to. numpy moves
   the states of all positions of a block of text on, level by level, and counts the accepting states; tasks'
   counts are added up. These are the phrases' exact counts.

Texts are cut into words, and a block's distinct words found, in Arrow; Python handles only these.

What passes 2 to 4 broadcast is a bitmap of ``BITS`` bits, whatever the corpus holds; a crowded one lets more
phrases through.

Defined results: a null or empty text has no words; a null ``lang`` is ``und``; rows that repeat a ``doc_id``
count each; ties in the score go to the higher count, then to the smaller phrase by its UTF-8 bytes; an empty
table has no phrases.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.common import whole_text
from newsflow.session import written

LONGEST = 5
MIN_COUNT = 100
PER_LANG = 2000
COVERED_PERCENT = 100
BITS = 27  # of the bitmaps: 16 MB
TRIE_NODES = 1 << 19  # of one trie, at most about
TOGETHER = 8  # tries that are broadcast at once
HELD_KEYS = 1 << 22  # keys of a task that are counted together
BUCKETS = 256  # parts in which tasks hand on the phrases they name
HELD_PHRASES = 500_000  # phrases a task remembers to have named
SUMMED = 4096  # phrases whose counts in a task make one row
DISTINCT = 200_000  # distinct words a task holds before it passes their counts on

_TO_SPLIT = b".,;:!?\x0b\x0c\x0d"
_TABLE = bytes(b"\n"[0] if c in _TO_SPLIT else b" "[0] if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Block:
    """Texts of one language. ``codes`` has each word's place among the ``distinct`` ones, counted from 1, and 0 between
    pieces and texts; word ``i`` has the code at ``places[i]`` and stands in text ``owners[i]``."""

    lang: str
    distinct: list[bytes]
    codes: np.ndarray
    places: np.ndarray
    owners: np.ndarray


def cut(lang: str, texts: pa.StringArray) -> Block:
    """The words of ``texts`` in lower case."""
    ends = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)
    data = texts.buffers()[2]
    raw = np.frombuffer(b"" if data is None else data[int(ends[0]) : int(ends[-1])].to_pybytes().translate(_TABLE), np.uint8)
    ends = ends - ends[0]
    breaks = raw == ord("\n")
    inside = ~breaks & (raw != ord(" "))
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = ends[(ends > 0) & (ends < len(raw))]
    begins[edges], closes[edges - 1] = inside[edges], inside[edges - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    letters = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(letters), pa.py_buffer(raw[inside])]).dictionary_encode()
    owners = np.searchsorted(ends[1:], starts, side="right")
    pieces = np.searchsorted(np.flatnonzero(breaks), starts)
    apart = np.append(True, (np.diff(owners) > 0) | (np.diff(pieces) > 0))[: len(starts)]
    places = np.arange(len(starts)) + np.cumsum(apart)
    codes = np.zeros(len(starts) + int(apart.sum()) + 1, np.int32)
    codes[places] = found.indices.to_numpy() + 1
    return Block(lang, found.dictionary.to_pylist(), codes, places, owners)


class Hashes(dict):
    """The hashes of one language's words, eight bytes each."""

    def __init__(self, lang: str) -> None:
        self.lang = lang.encode() + b"\0"

    def __missing__(self, word: bytes) -> bytes:
        found = (xxhash.xxh3_64_intdigest(self.lang + word) or 1).to_bytes(8, "little")
        self[word] = found
        return found


def hashed(block: Block, known: dict[str, Hashes]) -> np.ndarray:
    """The words of many texts as hashes, with zeros between texts and pieces."""
    if sum(map(len, known.values())) > 3 * DISTINCT:
        known.clear()
    if block.lang not in known:
        known[block.lang] = Hashes(block.lang)
    return np.frombuffer(bytes(8) + b"".join(map(known[block.lang].__getitem__, block.distinct)), np.uint64)[block.codes]


def longer(keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Keys of phrases from those without their last word, and that word's hash."""
    return keys * _FACTOR + hashes


def bit(keys: np.ndarray) -> np.ndarray:
    return keys >> np.uint64(64 - BITS)


def holds(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = bit(keys)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def bitmap_of(keys: DataFrame) -> np.ndarray:
    """Bits of the 64-bit ``key`` column; of a fixed size, so it may pass the driver."""
    out = np.zeros(1 << BITS - 3, np.uint8)
    place = F.shiftrightunsigned("key", 64 - BITS) + 1  # Spark's buckets of 32,768 places count from 1
    parts = keys.select(place.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    for row in parts.toLocalIterator():
        at = (row.part - 1) * 4096
        out[at : at + len(row.bits)] |= np.frombuffer(row.bits, np.uint8)
    return out


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), whole_text().alias("text"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """Texts as words, those of a batch in one language at a time."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            yield cut(lang, batch.column(1).filter(pc.equal(langs.indices, i)))


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, word, n, key``: exact counts of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, c in counts.items():
                keys = np.frombuffer(b"".join(map(Hashes(lang).__missing__, c)), np.int64)
                columns = [pa.repeat(pa.scalar(lang, pa.string()), len(c)), pa.array(c, pa.binary()).cast(pa.string()), pa.array(c.values(), pa.int64()), pa.array(keys)]
                yield pa.record_batch(columns, names=["lang", "word", "n", "key"])
            counts.clear()

        for block in _blocks(batches):
            held = counts[block.lang]
            for word, n in zip(block.distinct, np.bincount(block.codes)[1:].tolist(), strict=True):
                held[word] += n
            if sum(map(len, counts.values())) > DISTINCT:
                yield from flush()
        yield from flush()

    partial = _texts(docs).mapInArrow(run, "lang string, word string, n long, key long")
    return partial.groupBy("lang", "word").agg(F.sum("n").alias("n"), F.first("key").alias("key"))


def _keys_frequent(rows: DataFrame, keys_of: Callable[[np.ndarray], np.ndarray], min_count: int) -> DataFrame:
    """``key`` of what ``keys_of`` finds in the texts' hashes at least ``min_count`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Hashes] = {}
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            keys, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            held.clear()
            for at in range(0, len(keys), 1 << 17):
                yield pa.record_batch([pa.array(keys[at : at + (1 << 17)].view(np.int64)), pa.array(n[at : at + (1 << 17)])], names=["key", "n"])

        for block in _blocks(batches):
            held.append(keys_of(hashed(block, known)))
            if sum(map(len, held)) > HELD_KEYS:
                yield from flush()
        yield from flush()

    counted = rows.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count).select("key")


def _windows(hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For 2 words and more: positions where a phrase of so many words begins within a piece, and its key."""
    at, keys = np.flatnonzero(hashes), hashes[hashes != 0]
    for size in range(2, LONGEST + 1):
        inside = at + size - 1 < len(hashes)
        at, keys = at[inside], keys[inside]
        last = hashes[at + size - 1]
        at, keys, last = at[last != 0], keys[last != 0], last[last != 0]
        keys = longer(keys, last)
        yield size, at, keys


def frequent_pairs(docs: DataFrame, frequent_words: np.ndarray, min_count: int = MIN_COUNT) -> DataFrame:
    """``key`` of the pairs of neighbouring frequent words that are frequent themselves."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent_words)

    def keys_of(hashes: np.ndarray) -> np.ndarray:
        able = (hashes != 0) & holds(shared.value, hashes)
        both = able[:-1] & able[1:]
        return longer(hashes[:-1][both], hashes[1:][both])

    return _keys_frequent(_texts(docs), keys_of, min_count)


def _joined(values: pa.Array, ends: np.ndarray, between: bytes) -> pa.Array:
    """``values`` in groups that end at ``ends``, each joined."""
    offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, values), pa.scalar(between, pa.binary()))


def runs(docs: DataFrame, pairs: np.ndarray) -> DataFrame:
    """``lang, text``: of each text the runs of two words and more whose neighbours are frequent pairs, a line each."""
    shared = docs.sparkSession.sparkContext.broadcast(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Hashes] = {}
        for block in _blocks(batches):
            hashes = hashed(block, known)
            both = (hashes[:-1] != 0) & (hashes[1:] != 0)
            both[both] = holds(shared.value, longer(hashes[:-1][both], hashes[1:][both]))
            edge = np.diff(np.concatenate([[0], both.astype(np.int8), [0]]))
            starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
            inside = np.repeat(starts - np.concatenate([[0], np.cumsum(stops - starts)[:-1]]), stops - starts) + np.arange(int((stops - starts).sum()))
            found = pa.array(block.distinct, pa.binary()).take(pa.array(block.codes[inside] - 1))
            lines = _joined(found, np.cumsum(stops - starts), b" ")
            owners = block.owners[np.searchsorted(block.places, starts)]
            texts = _joined(lines, np.append(np.flatnonzero(np.diff(owners)) + 1, len(owners)) if len(owners) else owners, b"\n")
            yield pa.record_batch([pa.repeat(pa.scalar(block.lang, pa.string()), len(texts)), texts.cast(pa.string())], names=["lang", "text"])

    return _texts(docs).mapInArrow(run, "lang string, text string")


def frequent_longer(found: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``key`` of the runs' phrases of three words and more that are frequent."""

    def keys_of(hashes: np.ndarray) -> np.ndarray:
        return np.concatenate([keys for size, _, keys in _windows(hashes) if size > 2])

    return _keys_frequent(found, keys_of, min_count)


def candidates(found: DataFrame, keys: np.ndarray) -> DataFrame:
    """``lang, phrase``: the runs' pairs, and their longer phrases with a frequent key.

    A task names each phrase once and hands them on in ``BUCKETS`` parts by their hash; a part drops what several
    tasks have named.
    """
    shared = found.sparkSession.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Hashes] = {}
        parts: dict[int, list[str]] = defaultdict(list)
        seen: list[np.ndarray] = []  # sorted keys, each part longer than the next
        held = 0

        def flush() -> pa.RecordBatch:
            made = pa.record_batch([pa.array(list(parts), pa.int64()), pa.array(list(parts.values()), pa.list_(pa.string()))], names=["part", "phrases"])
            parts.clear()
            return made

        for block in _blocks(batches):
            hashes = hashed(block, known)
            named = []
            for size, at, phrase_keys in _windows(hashes):
                able = np.ones(len(at), bool) if size == 2 else holds(shared.value, phrase_keys)
                new, first = np.unique(phrase_keys[able], return_index=True)
                fresh = np.ones(len(new), bool)
                for keys in seen:
                    fresh &= keys[np.minimum(np.searchsorted(keys, new), len(keys) - 1)] != new
                at, new = at[able][first[fresh]], new[fresh]
                named.append(new)
                for i, part in zip((block.codes[at[:, None] + np.arange(size)] - 1).tolist(), (new % np.uint64(BUCKETS)).tolist(), strict=True):
                    parts[part].append(f"{block.lang}\n{b' '.join([block.distinct[c] for c in i]).decode()}")
            keys = np.sort(np.concatenate(named))
            held += len(keys)
            while seen and len(seen[-1]) <= len(keys):
                keys = np.sort(np.concatenate([seen.pop(), keys]))
            if len(keys):
                seen.append(keys)
            if held > HELD_PHRASES:  # names some again, which only costs their way
                yield flush()
                seen, held = [], 0
        yield flush()

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = {p for batch in batches for phrases in batch.column(1).to_pylist() for p in phrases}
        # a phrase holds no line feed, a language might
        pairs = [p.rsplit("\n", 1) for p in every]
        yield pa.record_batch([pa.array([x[0] for x in pairs], pa.string()), pa.array([x[1] for x in pairs], pa.string())], names=["lang", "phrase"])

    named = found.mapInArrow(run, "part long, phrases array<string>")
    return named.groupBy("part").applyInArrow(once, "lang string, phrase string")


class Trie:
    """Phrases as a double array over numbered words: from state ``s`` word ``c`` leads to ``t = base[s] + c``
    if ``check[t] == s``. State 0 is the root, -1 in ``check`` a free place."""

    def __init__(self, phrases: list[tuple[str, str]]) -> None:
        lists = [[(lang, w) for w in phrase.split(" ")] for lang, phrase in phrases]
        codes: dict[tuple[str, str], int] = {}
        coded = [[codes.setdefault(w, len(codes) + 1) for w in x] for x in lists]
        self.codes: dict[str, dict[bytes, bytes]] = {}
        for (lang, word), code in codes.items():
            self.codes.setdefault(lang, {})[word.encode()] = code.to_bytes(4, "little")
        children: dict[tuple[int, ...], list[int]] = {(): []}
        for x in coded:
            for i in range(len(x)):
                if (node := tuple(x[: i + 1])) not in children:
                    children[node] = []
                    children[node[:-1]].append(x[i])
        self._place(children, len(codes))
        self.phrase = np.full(len(self.check), -1, np.int32)
        for i, x in enumerate(coded):
            self.phrase[self._states[tuple(x)]] = i
        del self._states

    def _place(self, children: dict[tuple[int, ...], list[int]], n_codes: int) -> None:
        """Gives every node's children a common base, those with most children of a level first. A node looks on from
        where the one before was placed; nodes of one child fill the gaps."""
        room = 2 * n_codes + 2 * len(children) + 2
        base, check = np.zeros(room, np.int64), np.full(room, -1, np.int64)
        check[0] = 0
        states = self._states = {(): 0}
        free = hint = n_codes + 1  # places before are the root's children
        order = sorted((n for n in children if children[n]), key=lambda n: (len(n), -len(children[n])))
        for node in order:
            codes, state = children[node], states[node]
            if not node:
                start = 0
            else:
                low, span = min(codes), np.array(codes) - min(codes)
                at, step = (free, 1) if len(codes) == 1 else (max(free, hint), max(1, 4096 // len(codes)))
                while True:  # tries so many places at once
                    while at + step + int(span.max()) + n_codes >= len(check):
                        base, check = np.concatenate([base, np.zeros(room, np.int64)]), np.concatenate([check, np.full(room, -1, np.int64)])
                    fits = np.flatnonzero((check[at + np.arange(step)[:, None] + span] < 0).all(axis=1))
                    if len(fits):
                        at += int(fits[0])
                        break
                    at += step
                hint = at if len(codes) > 1 else hint
                start = at - low
            base[state] = start
            for c in codes:
                check[start + c] = state
                states[(*node, c)] = start + c
            while check[free] >= 0:
                free += 1
        used = int(np.flatnonzero(check >= 0).max()) + n_codes + 2
        self.base, self.check = base[:used].astype(np.int32), check[:used].astype(np.int32)

    def encode(self, texts: list[tuple[str, list[bytes]]]) -> np.ndarray:
        """Words as their numbers; 0 for other words, and between pieces and texts."""
        unknown, out = bytes(4), []
        for lang, found in texts:
            known = self.codes.get(lang, {})
            out += [known.get(w, unknown) for w in found if w]
            out.append(unknown)
        return np.frombuffer(b"".join(out), "<u4").astype(np.int64)

    def count(self, codes: np.ndarray, at: np.ndarray | None = None, numbers: np.ndarray | None = None) -> np.ndarray:
        """How often each phrase begins anywhere in ``codes``, or at the places ``at``; all positions move on together.
        ``numbers`` has this trie's numbers of the words behind ``codes``, where these are others."""
        held = int((self.phrase >= 0).sum())
        total = np.zeros(held, np.int64)
        own = (lambda x: x) if numbers is None else numbers.__getitem__
        at = np.flatnonzero(codes) if at is None else at
        states = own(codes[at])  # children of the root lie at their numbers
        live = (states > 0) & (self.check[states] == 0)
        at, states = at[live], states[live]
        for level in range(1, LONGEST):
            inside = at + level < len(codes)
            at, states = at[inside], states[inside]
            following = own(codes[at + level])
            moved = self.base[states] + following
            live = (following != 0) & (moved >= 0) & (moved < len(self.check))
            moved[~live] = 0
            live &= self.check[moved] == states
            at, states = at[live], moved[live]
            ends = self.phrase[states]
            total += np.bincount(ends[ends >= 0], minlength=held)
        return total


class Tries:
    """Several tries, numbered from ``first`` of ``of``, and one numbering of all their words."""

    def __init__(self, tries: list[Trie], first: int, of: int) -> None:
        self.tries, self.first, self.of = tries, first, of
        self.codes: dict[str, dict[bytes, int]] = defaultdict(dict)
        n, places = 0, []
        for trie in tries:
            found: list[tuple[int, int]] = []
            for lang, known in trie.codes.items():
                mine = self.codes[lang]
                for word, code in known.items():
                    n += word not in mine
                    found.append((mine.setdefault(word, n), int.from_bytes(code, "little")))
            places.append(found)
            trie.codes = {}  # not sent twice
        self.numbers = [np.zeros(n + 1, np.int32) for _ in tries]
        for numbers, found in zip(self.numbers, places, strict=True):
            at, code = np.array(found, np.int64).reshape(-1, 2).T
            numbers[at] = code

    def count(self, block: Block, hashes: np.ndarray) -> list[np.ndarray]:
        """How often each trie's phrases begin in ``block``; a position asks the trie of its first two words only."""
        at = np.flatnonzero((hashes[:-1] != 0) & (hashes[1:] != 0))
        trie = trie_of(hashes[at], hashes[at + 1], self.of) - self.first
        held = (trie >= 0) & (trie < len(self.tries))
        at, trie = at[held], trie[held]
        order = np.argsort(trie, kind="stable")
        at, bounds = at[order], np.searchsorted(trie[order], np.arange(len(self.tries) + 1))
        known = self.codes.get(block.lang, {})
        words = np.array([0, *(known.get(w, 0) for w in block.distinct)])
        return [t.count(block.codes, at[bounds[i] : bounds[i + 1]], self.numbers[i][words]) for i, t in enumerate(self.tries)]


def trie_of(first: np.ndarray, second: np.ndarray, tries: int) -> np.ndarray:
    """The number of the trie that holds the phrases whose first two words have these hashes."""
    keys = longer(first, second)
    return ((keys ^ (keys >> np.uint64(32))) % np.uint64(tries)).astype(np.int64)


def _dealt(phrases: DataFrame, tries: int) -> DataFrame:
    """``lang, phrase, trie``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Hashes] = {}
        for batch in batches:
            langs, found = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            hashes = b"".join(known.setdefault(lang, Hashes(lang))[w] for lang, p in zip(langs, found, strict=True) for w in p.encode().split(b" ", 2)[:2])
            both = np.frombuffer(hashes, np.uint64).reshape(-1, 2)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(trie_of(both[:, 0], both[:, 1], tries))], names=["lang", "phrase", "trie"])

    return phrases.select("lang", "phrase").mapInArrow(run, "lang string, phrase string, trie long")


def count_phrases(found: DataFrame, phrases: DataFrame, nodes: int = TRIE_NODES) -> DataFrame:
    """``lang, phrase, n``: exact counts of ``phrases`` in the runs, by tries of about ``nodes`` nodes.

    A trie holds the phrases of an equal share of the first pairs of words, so its size does not grow with the corpus. The
    runs are read once for every ``TOGETHER`` tries, and each place in them is looked up in one trie.
    """
    spark = found.sparkSession
    tries = max(1, -(-phrases.count() * LONGEST // nodes))
    dealt = written(_dealt(phrases, tries), "dealt")
    counted = []
    for first in range(0, tries, TOGETHER):
        held = [[(r.lang, r.phrase) for r in dealt.where(F.col("trie") == i).toLocalIterator()] for i in range(first, min(tries, first + TOGETHER))]
        if any(held):
            counted.append(_counted(found, Tries([Trie(x) for x in held], first, tries), [p for x in held for p in x]))
    if not counted:
        return spark.createDataFrame([], "lang string, phrase string, n long")
    out = counted[0]
    for more in counted[1:]:
        out = out.unionByName(more)
    return out


def _counted(found: DataFrame, tries: Tries, held: list[tuple[str, str]]) -> DataFrame:
    spark = found.sparkSession
    shared, size = spark.sparkContext.broadcast(tries), len(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Hashes] = {}
        total = np.zeros(size, np.int64)
        for block in _blocks(batches):
            total += np.concatenate(shared.value.count(block, hashed(block, known)))
        starts = range(0, size, SUMMED)
        yield pa.record_batch([pa.array(starts, pa.int64()), pa.array([total[i : i + SUMMED].tobytes() for i in starts], pa.binary())], names=["first", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, total = 0, np.zeros(0, np.int64)
        for batch in batches:
            for first, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                some = np.frombuffer(counts, np.int64)
                total = some + total if len(total) else some
        yield pa.record_batch([pa.array(first + np.arange(len(total))), pa.array(total)], names=["i", "n"])

    sums = found.mapInArrow(run, "first long, counts binary").groupBy("first").applyInArrow(add, "i long, n long")
    names = spark.createDataFrame(pa.table({"i": np.arange(len(held)), "lang": [x[0] for x in held], "phrase": [x[1] for x in held]}))
    return written(sums.join(names, "i").select("lang", "phrase", "n"), "phrases")


def _part(first: Column | int, size: Column) -> Column:
    """``size`` of a phrase's words from the one numbered ``first``."""
    return F.array_join(F.slice("words", first, size), " ")


def scores(counted: DataFrame, counts: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``lang, phrase, k, a, l, r, n, score`` of each phrase, by its lowest-scoring cut.

    ``counted`` holds phrases of two words and more, ``counts`` all words. The score is
    ``floor(1000 * a * n / (l * r))`` in whole numbers of up to 38 digits.
    """
    wide = lambda name: F.col(name).cast("decimal(19,0)")
    total = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    part = counts.where(F.col("n") >= min_count).select("lang", F.col("word").alias("phrase"), "n").unionByName(counted)
    held = counted.withColumnRenamed("n", "a").withColumn("words", F.split("phrase", " "))
    cuts = held.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(1, F.col("k")).alias("left"), _part(F.col("k") + 1, F.size("words") - F.col("k")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(part.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    rated = cuts.join(total, "lang").withColumn("_up", F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("n")).withColumn("_down", wide("l") * wide("r"))
    rated = rated.withColumn("score", F.expr("_up div _down"))
    best = F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("best")
    return rated.groupBy("lang", "phrase").agg(best).select("lang", "phrase", "best.k", "best.a", "best.l", "best.r", "best.n", "best.score")


def uncovered(counted: DataFrame, percent: int = COVERED_PERCENT) -> DataFrame:
    """``lang, phrase`` of the phrases that no longer one holds in ``percent`` of their occurrences or more."""
    inner = counted.withColumn("words", F.split("phrase", " ")).where(F.size("words") > 2)
    inner = inner.withColumn("size", F.explode(F.sequence(F.lit(2), F.size("words") - 1)))
    inner = inner.withColumn("first", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)))
    inside = inner.select("lang", _part(F.col("first"), F.col("size")).alias("phrase"), F.col("n").alias("around"))
    most = inside.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    alone = F.col("around").isNull() | (100 * F.col("around") < percent * F.col("n"))
    return counted.join(most, ["lang", "phrase"], "left").where(alone).select("lang", "phrase")


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """Exact counts: of the frequent phrases as ``lang, phrase, n``, and of all words as ``lang, word, n, key``."""
    counts = written(word_counts(docs), "words")
    found = written(runs(docs, bitmap_of(frequent_pairs(docs, bitmap_of(counts.where(F.col("n") >= min_count)), min_count))), "runs")
    phrases = written(candidates(found, bitmap_of(frequent_longer(found, min_count))), "candidates")
    return count_phrases(found, phrases).where(F.col("n") >= min_count), counts


def mine(docs: DataFrame, min_count: int = MIN_COUNT, per_lang: int = PER_LANG, percent: int = COVERED_PERCENT) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``per_lang`` phrases by score."""
    counted, counts = phrase_counts(docs, min_count)
    rated = scores(counted, counts, min_count).join(uncovered(counted, percent), ["lang", "phrase"])
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rated.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_lang)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
