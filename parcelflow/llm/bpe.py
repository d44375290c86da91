"""Byte-pair encoding in batched numpy merge rounds, and decoding (operator 9).

The symbols of many words lie in one flat array.  A round finds, for every word at once, its
lowest-ranked pair (ranks come from a binary search over the sorted pair keys), merges all its
occurrences from left to right and looks up only the pairs that the merges changed.  Words that
have no pair left leave the array.

Texts are cut into words as the tokenizer's own pattern cuts them; every distinct word is merged
once per Python worker (a cache of bounded size) and a text is the concatenation of its words.

Defined cases: a null text is an empty text (no ids); special tokens written in a text get their
own id, as the tokenizers library does; texts of any length are handled whole; repeated rows give
repeated results; extra columns of the input are dropped.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import text_of

#: Words kept per worker (about 200 bytes each) before the cache starts anew.
CACHE_WORDS = 1_000_000
_NO_RANK = np.int64(1) << 40

# Fixed value: white space as Unicode's White_Space property lists it.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Fixed value: the byte-level pattern of the vocabulary file's pre-tokenizer.
BYTE_LEVEL_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
# Fixed value: the word pattern of the lower-casing vocabulary file's pre-tokenizer.
WORD_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{WHITE}\p{{L}}\p{{N}}]+"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class MergeTable:
    """Vocabulary and merge ranks of one tokenizers JSON file as sorted numpy arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.made_by_rank = made
        letters = byte_alphabet()
        self.byte_ids = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.last_ids = np.array([vocab[c + self.suffix] for c in letters], dtype=np.int64)
        to_byte = {c: b for b, c in enumerate(letters)}
        self.token_bytes = [b""] * self.size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(to_byte[c] for c in token if c in to_byte)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, ``_NO_RANK`` where the pair is never merged."""
        key = a * self.size + b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], _NO_RANK)

    def merge_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of each word."""
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        word = np.flatnonzero(lengths)
        if not len(word):
            return out
        lengths = lengths[word]
        raw = np.frombuffer(b"".join(words), np.uint8)
        sym = self.byte_ids[raw]
        ends = np.cumsum(lengths)
        if self.suffix:
            sym[ends - 1] = self.last_ids[raw[ends - 1]]
        start = ends - lengths
        rank = np.full(len(sym), _NO_RANK)
        rank[:-1] = self.rank(sym[:-1], sym[1:])
        rank[ends - 1] = _NO_RANK
        while len(word):
            low = np.minimum.reduceat(rank, start)
            done = low == _NO_RANK
            if done.any():
                bounds = np.append(start, len(sym))
                for w, a, b in zip(word[done].tolist(), bounds[:-1][done].tolist(), bounds[1:][done].tolist()):
                    out[w] = sym[a:b]
                keep = np.repeat(~done, lengths)
                sym, rank = sym[keep], rank[keep]
                word, lengths, low = word[~done], lengths[~done], low[~done]
                if not len(word):
                    break
                start = np.cumsum(lengths) - lengths
            hit = np.flatnonzero(rank == np.repeat(low, lengths))
            # Of overlapping equal pairs the first, third, ... of a run are merged.
            fresh = np.ones(len(hit), bool)
            fresh[1:] = np.diff(hit) != 1
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            sym[hit] = self.made_by_rank[rank[hit]]
            owner = np.searchsorted(start, hit, side="right") - 1
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            at = np.cumsum(keep) - 1
            sym, rank = sym[keep], rank[keep]
            lengths = lengths - np.bincount(owner, minlength=len(lengths))
            start = np.cumsum(lengths) - lengths
            hit = at[hit]
            last = start + lengths - 1
            own_start, own_last = start[owner], last[owner]
            right = hit[hit < own_last]
            rank[hit[hit == own_last]] = _NO_RANK
            rank[right] = self.rank(sym[right], sym[right + 1])
            left = hit[hit > own_start] - 1
            rank[left] = self.rank(sym[left], sym[left + 1])
        return out


class _Memo:
    """Ids of words and of pieces already seen, as bytes of little-endian unsigned 32-bit integers.

    ``words`` are the pattern's words; ``pieces`` and ``later`` (those that follow a space) are what
    a text falls into at spaces, so that a text of known pieces needs no pattern matching.
    """

    def __init__(self, merges: MergeTable):
        self.merges = merges
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}

    def make_room(self) -> None:
        if len(self.words) + len(self.pieces) + len(self.later) > CACHE_WORDS:
            for memo in (self.words, self.pieces, self.later):
                memo.clear()

    def learn(self, found: list[tuple[dict[str, bytes], str, list[str]]]) -> None:
        """Adds pieces, each given with its memo, its key and its words."""
        words = self.words
        new = list({w for _, _, ws in found for w in ws if w not in words})
        ids = self.merges.merge_words([w.encode("utf-8", "surrogatepass") for w in new])
        flat = np.concatenate(ids).astype("<u4").tobytes() if ids else b""
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) * 4).tolist()
        words.update(zip(new, (flat[i:j] for i, j in zip([0, *ends], ends))))
        for memo, key, ws in found:
            memo[key] = words[ws[0]] if len(ws) == 1 else b"".join(map(words.__getitem__, ws))


class ByteBPE:
    """Encoder and decoder for a byte-level vocabulary (spaces belong to the words)."""

    def __init__(self, path: str):
        self.merges = MergeTable(path)
        self.memo = _Memo(self.merges)
        self.pattern = regex.compile(BYTE_LEVEL_PATTERN)
        self.special = regex.compile("|".join(map(re.escape, self.merges.special))) if self.merges.special else None
        self.runs = re.compile(f"[{WHITE}]{{2}}")

    def _cut(self, text: str) -> tuple[list[str], list[str]]:
        """Pieces whose borders are word borders, and those of them that follow a single space."""
        if self.runs.search(text):
            return self.pattern.findall(text), []
        first, *later = text.split(" ")
        return [first] if first else [], later

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        memo = self.memo
        memo.make_room()
        cut: list[list] = []
        new: set[str] = set()
        new_later: set[str] = set()
        for text in texts:
            row: list = []
            at = 0
            for m in self.special.finditer(text) if self.special and "<|" in text else ():
                row += [self._cut(text[at:m.start()]), self.merges.special[m[0]]]
                at = m.end()
            row.append(self._cut(text[at:] if at else text))
            cut.append(row)
            for part in row:
                if isinstance(part, tuple):
                    new.update(part[0])
                    new_later.update(part[1])
        find = self.pattern.findall
        memo.learn([(memo.pieces, p, find(p)) for p in new - memo.pieces.keys()]
                   + [(memo.later, p, find(" " + p)) for p in new_later - memo.later.keys()])
        first, later = memo.pieces.__getitem__, memo.later.__getitem__
        return [b"".join(b"".join([*map(first, part[0]), *map(later, part[1])]) if isinstance(part, tuple)
                         else np.uint32(part).tobytes() for part in row) for row in cut]

    def decode(self, ids: bytes) -> str:
        tokens = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.merges.token_bytes.__getitem__, tokens)).decode("utf-8", "replace")


class WordBPE:
    """Encoder for a lower-casing vocabulary with word ends; white space only separates.

    Plain Latin pieces are normalised and merged here; a piece with other characters, or with a
    special token in it, is encoded by the tokenizers library, whose normaliser decides there.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.memo = _Memo(MergeTable(path))
        self.pattern = regex.compile(WORD_PATTERN)
        self.plain = re.compile("[\x21-\x7e\xa1-\u012f\u0131-\u017f\u2010-\u2027\u2030-\u205e]+")
        self.odd_space = re.compile("[\x1c-\x1f]")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()

    def _by_library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        memo = self.memo
        memo.make_room()
        whole = {i: self._by_library(t) for i, t in enumerate(texts) if self.odd_space.search(t)}
        cut = [() if i in whole else t.split() for i, t in enumerate(texts)]
        new: set[str] = set()
        for row in cut:
            new.update(row)
        found = []
        for p in new - memo.pieces.keys():
            if "<|" not in p and self.plain.fullmatch(p):
                found.append((memo.pieces, p, self.pattern.findall(unicodedata.normalize("NFC", p).lower())))
            else:
                memo.pieces[p] = self._by_library(p)
        memo.learn(found)
        get = memo.pieces.__getitem__
        return [whole[i] if i in whole else b"".join(map(get, row)) for i, row in enumerate(cut)]


_ENCODERS: dict[tuple[type, str], ByteBPE | WordBPE] = {}


def encoder(kind: type, path: str) -> ByteBPE | WordBPE:
    """One encoder per Python worker and file."""
    if (kind, path) not in _ENCODERS:
        _ENCODERS[kind, path] = kind(path)
    return _ENCODERS[kind, path]


def slices(texts: list, chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges of at most ``chars`` characters (one text at least)."""
    at, total = 0, 0
    for i, t in enumerate(texts):
        if i > at and total + len(t) > chars:
            yield at, i
            at, total = i, 0
        total += len(t)
    if texts:
        yield at, len(texts)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, ids binary): the ids of every text, as little-endian unsigned 32-bit integers."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder(ByteBPE, path)
        for b in batches:
            texts = b["text"].tolist()
            for i, j in slices(texts):
                yield b.iloc[i:j].assign(ids=bpe.encode_batch(texts[i:j]))

    return rows.mapInPandas(run, f"id {rows.schema['id'].dataType.simpleString()}, text string, ids binary")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encode every text and decode its ids again."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder(ByteBPE, path)
        for b in batches:
            texts = b["text"].tolist()
            for i, j in slices(texts):
                ids = bpe.encode_batch(texts[i:j])
                yield pd.DataFrame({
                    "id": b["id"].iloc[i:j].array,
                    "n_tokens": [len(x) // 4 for x in ids],
                    "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                    "decoded_sha256": [hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids],
                })

    return rows.mapInPandas(run, f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, "
                                 "ids_sha256 string, decoded_sha256 string")
