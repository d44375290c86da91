"""Token ids of many texts at once for the lower-casing word vocabulary, in flat arrays.

The texts of a slice lie in one array of code points.  Classes, lower case and word borders come
from tables; every word gets two 64-bit polynomial hashes from prefix sums; equal words are found by
sorting the hashes; only words that the worker has not met are merged (``MergeTable.merge_words``).
The ids of all words are then gathered in one step.

Texts that this cannot decide go through ``WordBPE`` one by one: those with characters outside the
tables, with ``<|`` (special tokens), with words of over ``LONGEST`` characters (for which the
polynomial hash is not safe), and those with a word whose first hash matches and second does not.

The worker's memory of words takes about 30 bytes a word and starts anew after ``STORE_WORDS``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import regex

from parcelflow.llm.bpe import WordBPE, encoder, slices

STORE_WORDS = 2_000_000
SLICE_CHARS = 1_000_000
LONGEST = 64
_ODD, _SPACE, _LETTER, _NUMBER, _OTHER = range(5)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_LAST = 0x205F


def _tables(plain) -> tuple[np.ndarray, np.ndarray]:
    """Class and lower case of every code point up to ``_LAST`` (which stands for all others)."""
    kind, lower = np.full(_LAST + 1, _ODD, np.uint8), np.arange(_LAST + 1, dtype=np.uint32)
    letter, number = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
    for cp in range(_LAST):
        c = chr(cp)
        if c in " \t\n\v\f\r":
            kind[cp] = _SPACE
        elif plain.fullmatch(c) and len(c.lower()) == 1 and unicodedata.normalize("NFC", c) == c:
            low = c.lower()
            kind[cp] = _LETTER if letter.match(low) else _NUMBER if number.match(low) else _OTHER
            lower[cp] = ord(low)
    return kind, lower


class FlatWords:
    """Encoder of one vocabulary file; lives as long as its Python worker."""

    def __init__(self, path: str):
        self.slow = encoder(WordBPE, path)
        self.merges = self.slow.memo.merges
        self.kind, self.lower = _tables(self.slow.plain)
        self.powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
        self.inverses: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
        self._forget()

    def _forget(self) -> None:
        self.key, self.check = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.at, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def _grow(self, n: int) -> None:
        if len(self.powers[0]) < n + 1:
            for j, base in enumerate(_BASES):
                for table, x in ((self.powers, base), (self.inverses, pow(base, -1, 1 << 64))):
                    steps = np.full(n + 1, x, np.uint64)
                    steps[0] = 1
                    table[j] = np.multiply.accumulate(steps)

    def _hashes(self, cps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        self._grow(len(cps))
        out = []
        for powers, inverses in zip(self.powers, self.inverses):
            sums = np.zeros(len(cps) + 1, np.uint64)
            np.cumsum((cps + np.uint64(1)) * powers[:len(cps)], out=sums[1:])
            h = (sums[ends] - sums[starts]) * inverses[starts]
            h ^= h >> np.uint64(31)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            out.append(h ^ (h >> np.uint64(29)))
        return out

    def _words(self, cps: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pattern's words in lower-case code points."""
        start = np.empty(len(kind), bool)
        start[:1] = True
        np.not_equal(kind[1:], kind[:-1], out=start[1:])
        start |= kind == _NUMBER
        # An apostrophe that makes up a whole run of other characters takes certain endings with it.
        quote = np.flatnonzero((cps == ord("'")) & start)
        if len(quote):
            def letter(i: np.ndarray) -> np.ndarray:
                inside = i < len(cps)
                at = np.minimum(i, len(cps) - 1)
                return np.where(inside & (kind[at] == _LETTER), cps[at], 0)

            one, two = letter(quote + 1), letter(quote + 2)
            taken = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
            for pair in ("re", "ve", "ll"):
                taken[(one == ord(pair[0])) & (two == ord(pair[1]))] = 2
            quote, taken = quote[taken > 0], taken[taken > 0]
            start[quote + 1] = False
            after = quote + 1 + taken
            after = after[after < len(cps)]
            start[after[kind[after] == _LETTER]] = True
        border = np.flatnonzero(start | (kind == _SPACE))
        first = start[border] & (kind[border] != _SPACE)
        return border[first], np.append(border[1:], len(kind))[first]

    def _slots(self, cps, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """Each word's place in the memory, and whether the place is surely the word's own."""
        key, check = self._hashes(cps, starts, ends)
        distinct, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        known = np.searchsorted(self.key, distinct)
        old = known < len(self.key)
        old[old] = self.key[known[old]] == distinct[old]
        new = first[~old]
        if len(new):
            if len(self.key) + len(new) > STORE_WORDS:
                self._forget()
                new = first
            merged = self.merges.merge_words(_texts(cps, starts[new], ends[new]))
            sizes = np.fromiter(map(len, merged), np.int64, len(merged))
            at = len(self.ids) + np.cumsum(sizes) - sizes
            self.ids = np.concatenate([self.ids, np.concatenate(merged).astype(np.uint32)])
            keys = np.concatenate([self.key, key[new]])
            order = np.argsort(keys, kind="stable")  # two sorted runs
            self.key = keys[order]
            self.check = np.concatenate([self.check, check[new]])[order]
            self.at = np.concatenate([self.at, at])[order]
            self.size = np.concatenate([self.size, sizes])[order]
            known = np.searchsorted(self.key, distinct)
        slot = known[inverse]
        return slot, self.check[slot] == check

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        text_start = np.cumsum(lengths + 1) - lengths - 1
        cps = np.frombuffer((" ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), "<u4")
        known = np.minimum(cps, _LAST)
        kind, cps = self.kind[known], self.lower[known]

        def text_of(at: np.ndarray) -> np.ndarray:
            return np.searchsorted(text_start, at, "right") - 1

        odd = np.zeros(len(texts), bool)
        odd[text_of(np.flatnonzero(kind == _ODD))] = True
        special = np.flatnonzero((cps[:-1] == ord("<")) & (cps[1:] == ord("|")))
        odd[text_of(special)] = True
        starts, ends = self._words(cps, kind)
        owner = text_of(starts)
        odd[owner[ends - starts > LONGEST]] = True
        fast = ~odd[owner]
        starts, ends, owner = starts[fast], ends[fast], owner[fast]
        if len(starts):
            slot, sure = self._slots(cps, starts, ends)
            odd[owner[~sure]] = True
            size = self.size[slot]
            stop = np.cumsum(size)
            flat = self.ids[np.repeat(self.at[slot] - (stop - size), size) + np.arange(stop[-1])]
            tokens = np.bincount(owner, size, len(texts)).astype(np.int64)
        else:
            flat, tokens = np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        out = np.split(flat, np.cumsum(tokens)[:-1]) if texts else []
        which = np.flatnonzero(odd).tolist()
        for i, ids in zip(which, self.slow.encode_batch([texts[i] for i in which])):
            out[i] = np.frombuffer(ids, "<u4")
        return out

    def encode_batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        for i, j in slices(texts, SLICE_CHARS):
            if j == i + 1 and len(texts[i]) > 2 * SLICE_CHARS:
                parts = [x for part in _parts(texts[i]) for x in self._encode([part])]
                yield np.concatenate(parts)
            else:
                yield from self._encode(texts[i:j])


def _texts(cps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The words as UTF-8, copied out together with a line feed after each."""
    room = ends - starts + 1
    stop = np.cumsum(room)
    at = np.arange(stop[-1]) + np.repeat(starts - (stop - room), room)
    flat = cps[np.minimum(at, len(cps) - 1)].astype("<u4")
    flat[stop - 1] = ord("\n")
    return flat.tobytes().decode("utf-32-le").encode().split(b"\n")[:-1]


def _parts(text: str) -> Iterator[str]:
    """A very long text cut at spaces, which no word crosses."""
    at = 0
    while at < len(text):
        stop = text.find(" ", at + SLICE_CHARS)
        stop = len(text) if stop < 0 else stop
        yield text[at:stop]
        at = stop
