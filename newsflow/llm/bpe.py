"""Exact byte-pair encoding of many words at once, and of whole texts by their words.

The merges come from a public ``tokenizers`` file. A word is the unit between which that tokenizer
never merges. Texts are cut where white space ends a word, a batch of them as one Arrow array, so only
its distinct pieces become Python strings. Each is encoded once per task, and a text's ids are the
pieces' ids in order. Pieces with characters whose classes differ between Unicode versions, or with the
marks of special tokens, go to the ``tokenizers`` library.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LONG = 256  # code points of a piece beyond which the library's heap is faster than rounds over arrays
_END = b"\xff\xff\xff\xff"  # between the ids of two pieces; no id comes near it
KEPT = 1_000_000  # pieces to remember, of some 200 bytes each, where a task holds little else
NONE = np.int64(1 << 40)  # rank of a pair that never merges

# The word patterns of the public tokenizer files, for plain pieces. A zero byte, which no plain piece has,
# ends each of many pieces like the end of a text. Letters stand first, as most words begin with one.
WORD_PATTERN = r"[{L}]+|[{N}\x00]|'(?:s|t|re|ve|m|ll|d)|[^\s{L}{N}\x00]+"
BYTE_PATTERN = r" ?[{L}]+|\x00|'(?:s|t|re|ve|m|ll|d)| ?[{N}]+| ?[^\s{L}{N}\x00]+|\s+(?![^\s\x00])|\s+"

_STEADY = re.compile("[\t-\r\x20-\x7e\xa1-ɏ]*")  # same classes in every Unicode version
_SEPARATORS = re.compile("[\x1c-\x1f]")  # white space for Python, not for the tokenizers
_RUNS = re.compile(r"\s*\S+|\s+")
_CUT = "\x01"  # put before the spaces of a text at which it is cut
_SPACE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_ODD = rf"\x01|[{_SPACE}] (?:[{_SPACE}]|\z)"  # texts that are not to be cut before each of their spaces


def _ranges(kind: str) -> str:
    """The characters of a class among those of plain pieces and their lower case, as in a pattern's brackets."""
    plain = filter(_STEADY.fullmatch, map(chr, range(0x250)))
    codes = sorted({ord(c) for p in plain for c in p + p.lower() if unicodedata.category(c)[0] == kind})
    firsts, lasts = [c for c in codes if c - 1 not in codes], [c for c in codes if c + 1 not in codes]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(firsts, lasts, strict=True))


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    chars = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [chars[b] for b in range(256)]


class Merges:
    """The merge table of one tokenizer file as arrays."""

    def __init__(self, spec: str) -> None:
        model = json.loads(spec)["model"]
        vocab: dict[str, int] = model["vocab"]
        chars, suffix = byte_chars(), model["end_of_word_suffix"] or ""
        self.first = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + suffix] for c in chars], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        slots = self._slot(self.keys)
        self.table = np.full(1 << 20, -1, np.int64)
        self.table[slots[::-1]] = np.arange(len(slots))[::-1]
        spilt = np.flatnonzero(self.table[slots] != np.arange(len(slots)))
        spilt = spilt[np.argsort(self.keys[spilt])]
        self.more_keys, self.more = np.append(self.keys[spilt], NONE), np.append(spilt, -1)
        self.crowded = np.zeros(1 << 20, bool)
        self.crowded[slots[spilt]] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 20 | right
        slots = self._slot(keys)
        at = self.table[slots]
        out = np.where((at >= 0) & (self.keys[at] == keys), at, NONE)
        if len(more := np.flatnonzero(self.crowded[slots] & (out == NONE))):
            i = np.searchsorted(self.more_keys, keys[more])
            out[more] = np.where(self.more_keys[i] == keys[more], self.more[i], NONE)
        return out

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each non-empty word as little-endian unsigned 32-bit integers.

        Every round merges, in each word that still has a mergeable pair, the leftmost pair of the
        lowest rank; words without one leave.
        """
        out: list[bytes] = []
        for start in range(0, len(words), 65_536):
            out += self._block(words[start : start + 65_536])
        return out

    def _block(self, words: list[bytes]) -> list[bytes]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        ids, ends = self.first[raw], np.cumsum(sizes) - 1
        ids[ends] = self.last[raw[ends]]
        word = np.repeat(np.arange(len(words)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        ranks = np.full(len(ids), NONE)
        inside = np.flatnonzero(word[1:] == word[:-1])
        ranks[inside] = self.ranks(ids[inside], ids[inside + 1])
        while len(ids):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(ranks, starts)
            least = np.repeat(least, np.diff(np.append(starts, len(ids))))
            if (over := least == NONE).any():
                done.append((word[over], ids[over]))
            at = np.flatnonzero((ranks == least) & ~over)
            at = at[np.append(True, word[at[1:]] != word[at[:-1]])] if len(at) else at
            ids[at] = self.made[ranks[at]]
            keep = ~over
            keep[at + 1] = False
            merged = np.cumsum(keep)[at] - 1
            ids, word, ranks = ids[keep], word[keep], ranks[keep]
            near = np.concatenate([merged, merged[merged > 0] - 1])  # only pairs with a merged id have another rank
            ranks[near] = NONE
            near = near[near + 1 < len(ids)]
            near = near[word[near] == word[near + 1]]
            ranks[near] = self.ranks(ids[near], ids[near + 1])
        if not done:
            return []
        word = np.concatenate([w for w, _ in done])
        order = np.argsort(word, kind="stable")
        data = np.concatenate([i for _, i in done])[order].astype("<u4").tobytes()
        ends = (np.cumsum(np.bincount(word, minlength=len(words))) * 4).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class Codec:
    """Encodes whole texts as the tokenizer of ``spec`` does without adding special tokens.

    ``kept`` bounds the distinct pieces that a task remembers; it forgets them all beyond that.
    """

    def __init__(self, spec: str, kept: int = 350_000) -> None:
        self.spec, self.kept = spec, kept
        self.by_words = bool(json.loads(spec)["model"]["end_of_word_suffix"])
        pattern = WORD_PATTERN if self.by_words else BYTE_PATTERN
        self.pattern = re.compile(pattern.replace("{L}", _ranges("L")).replace("{N}", _ranges("N")))
        self.merges = Merges(spec)
        self.forget()
        self._library = None

    def forget(self) -> None:
        self.known: dict[str, bytes] = {"": b""}
        self.word_ids: dict[str, bytes] = {"\x00": _END}

    @property
    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.spec)
            self._library.no_truncation()
            self._library.no_padding()
        return self._library

    def pieces(self, texts: pa.Array) -> list[tuple[np.ndarray, pa.Array, np.ndarray]]:
        """Pieces that encode apart from each other: positions of texts, all their pieces in order, and where the
        pieces of each begin, with the end of the last.

        The byte-level pattern leaves to a word the last of the white space before it, if that is a space. So a text
        is cut before each space, but for a space between white space: runs of that are found text by text.
        """
        if self.by_words:
            cut = pc.ascii_split_whitespace(texts)
            return [(np.arange(len(texts)), cut.flatten(), cut.offsets.to_numpy())]
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        at, rest, out = np.flatnonzero(~odd), np.flatnonzero(odd), []
        if len(at):
            marked = pc.replace_substring(texts.take(pa.array(at)) if len(rest) else texts, " ", _CUT + " ")
            cut = pc.split_pattern(marked, _CUT)
            out.append((at, cut.flatten(), cut.offsets.to_numpy()))
        if len(rest):
            runs = [[t] if _SEPARATORS.search(t) else _RUNS.findall(t) for t in texts.take(pa.array(rest)).to_pylist()]
            found = pa.array([r for run in runs for r in run], texts.type)
            out.append((rest, found, np.cumsum([0, *map(len, runs)])))
        return out

    @staticmethod
    def plain(piece: str) -> bool:
        return _STEADY.fullmatch(piece) is not None and "<|" not in piece

    def words(self, pieces: list[str]) -> list[str]:
        """The words of plain pieces, with a zero byte between two pieces."""
        joined = "\x00".join(pieces)
        return self.pattern.findall(joined.lower() if self.by_words else joined)

    def encode_words(self, words: list[str]) -> list[bytes]:
        return self.merges.encode("\x00".join(words).encode().split(b"\x00") if words else [])

    def learn(self, new: list[str]) -> list[bytes]:
        """The ids of each of some distinct pieces."""
        every = max(map(len, new)) <= LONG and self.plain("".join(new))
        plain = new if every else [p for p in new if len(p) <= LONG and self.plain(p)]
        ids: list[bytes] = []
        if plain:
            words = self.words(plain)
            fresh = list(set(words).difference(self.word_ids))
            self.word_ids.update(zip(fresh, self.encode_words(fresh), strict=True))
            ids = b"".join(map(self.word_ids.__getitem__, words)).split(_END)
        if every:
            return ids
        found = dict(zip(plain, ids, strict=True))
        return [found[p] if p in found else np.array(self.library.encode(p, add_special_tokens=False).ids, "<u4").tobytes() for p in new]

    def look_up(self, pieces: list[str]) -> list[bytes]:
        """The ids of each of some distinct pieces; those not remembered are learnt."""
        if len(self.known) + len(self.word_ids) > self.kept:
            self.forget()
        found = list(map(self.known.get, pieces))
        if new := [p for p, ids in zip(pieces, found, strict=True) if ids is None]:
            learnt = self.learn(new)
            self.known.update(zip(new, learnt, strict=True))
            fresh = iter(learnt)
            found = [next(fresh) if ids is None else ids for ids in found]
        return found

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        column = large(texts)
        out = [b""] * len(column)
        for start in range(0, len(column), 1000):  # few texts at a time hold few pieces at once
            for at, pieces, starts in self.pieces(column.slice(start, 1000)):
                coded = pieces.dictionary_encode()
                ids = self.look_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
                for i, data in zip((at + start).tolist(), sliced(pa.array(ids, pa.large_binary()), coded.indices, starts), strict=True):
                    out[i] = data
        return out


def large(texts: pa.Array | list[str]) -> pa.Array:
    """Texts as an Arrow array whose offsets hold more than 2 GB; null counts as empty."""
    column = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
    return column.fill_null("") if column.null_count else column


def sliced(parts: pa.Array, order: pa.Array, starts: np.ndarray) -> list[bytes]:
    """``parts`` put one after the other in ``order``, and that cut at ``starts``."""
    taken = parts.take(order)
    if not len(taken):
        return [b""] * (len(starts) - 1)
    data = taken.buffers()[2]
    ends = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset :][starts].tolist()
    return [data[a:b].to_pybytes() if b > a else b"" for a, b in zip(ends, ends[1:], strict=False)]


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()
