"""Byte-level BPE of a public vocabulary, in numpy.

Texts are split by the vocabulary's pattern; each different text and each different piece of a batch is
encoded once. Pieces are bucketed by length into padded matrices of symbol ids. In every round each row
merges its leftmost pair of least rank: ranks come from a hash table of pairs, the row closes the gap,
rows without a pair left are written out and dropped from the matrix.

That takes a round per merge over the whole row, so the square of a piece's length. Pieces beyond the widest
bucket (runs of blanks, encoded blobs) are rows of their own in which all places of the least pair merge in
one round, from the left; Vocabulary checks that this gives the same (no merge makes a pair of lower rank).
"""

from __future__ import annotations

import json
import os
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

DEFAULT_DIR = "/opt/tokenizers"
# Fixed value: the split pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WIDTHS = (2, 4, 6, 8, 12, 16, 24, 32, 64, 128, 256, 512, 1024, 2048)
#: Different pieces kept between batches of a task.
KEPT_PIECES = 300_000
#: Symbols of a bucket encoded at once: bounds a worker's memory.
BLOCK = 1 << 20
_FREE = np.int64(-1)
_NONE = np.int32(2**31 - 1)


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary file: printable Latin-1 for
    itself, the others in order from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PairTable:
    """Open addressing from a pair of ids to its rank and merged id."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        size = 1 << max(4, int(len(left) * 4).bit_length())
        self.mask, self.shift = np.int64(size - 1), np.uint64(64 - size.bit_length() + 1)
        self.keys, self.rank, self.merged = np.full(size, _FREE), np.full(size, _NONE, np.int32), np.zeros(size, np.int32)
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[at[todo]] == _FREE
            slots, first = np.unique(at[todo[free]], return_index=True)
            put = todo[free][first]
            self.keys[slots], self.rank[slots], self.merged[slots] = keys[put], put, merged[put]
            todo = np.setdiff1d(todo, put)
            at[todo] = (at[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and merged ids of pairs; a pair with a padding or without a merge has rank _NONE."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = -2
        at = self._slot(keys)
        seen = self.keys[at]
        open_ = np.flatnonzero((seen != keys) & (seen != _FREE))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            seen = self.keys[at[open_]]
            open_ = open_[(seen != keys[open_]) & (seen != _FREE)]
        hit = self.keys[at] == keys
        return np.where(hit, self.rank[at], _NONE), self.merged[at]


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids: dict[str, int] = model["vocab"]
        letters = byte_letters()
        self.byte_ids = np.array([ids[letters[b]] for b in range(256)], np.int32)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left, right = (np.array([ids[p[k]] for p in pairs], np.int32) for k in (0, 1))
        merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        self.table = PairTable(left, right, merged)
        made = np.full(len(ids) + 1, -1)
        made[merged] = np.arange(len(pairs))
        if len(set(merged.tolist())) != len(merged) or (np.maximum(made[left], made[right]) >= np.arange(len(pairs))).any():
            raise ValueError(f"{path}: a merge makes a pair of lower rank")
        self.split = regex.compile(PATTERN)

    def encode_pieces(self, pieces: list[str]) -> list[np.ndarray]:
        raw = [p.encode("utf-8") for p in pieces]
        lengths = np.array([len(r) for r in raw])
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(raw)
        for i in np.flatnonzero(lengths == 1):
            out[i] = self.byte_ids[raw[i][0]][None]
        low = 1
        for width in WIDTHS:
            bucket = np.flatnonzero((lengths > low) & (lengths <= width))
            rows = max(1, BLOCK // width)
            for k in range(0, len(bucket), rows):
                self._bucket(raw, bucket[k : k + rows], lengths, width, out)
            low = width
        for i in np.flatnonzero(lengths > low):
            out[i] = self._long(self.byte_ids[np.frombuffer(raw[i], np.uint8)])
        return out

    def _bucket(self, raw: list[bytes], rows: np.ndarray, lengths: np.ndarray, width: int, out: list[np.ndarray]) -> None:
        flat = self.byte_ids[np.frombuffer(b"".join(raw[i].ljust(width, b"\0") for i in rows), np.uint8)].reshape(len(rows), width)
        place = np.arange(width)
        m = np.where(place < lengths[rows, None], flat, -1).astype(np.int32)
        ranks, news = (x.reshape(len(rows), width - 1) for x in self.table.find(m[:, :-1].ravel(), m[:, 1:].ravel()))
        while len(rows):
            at = ranks.argmin(axis=1)  # the leftmost of equals
            going = ranks[np.arange(len(rows)), at] < _NONE
            for k in np.flatnonzero(~going):
                out[rows[k]] = m[k][m[k] >= 0]
            rows, m, ranks, news, at = rows[going], m[going], ranks[going], news[going], at[going]
            if not len(rows):
                return
            line = np.arange(len(rows))
            m[line, at] = news[line, at]
            # Each row closes the gap behind the merged pair.
            m = np.take_along_axis(np.pad(m, ((0, 0), (0, 1)), constant_values=-1), place + (place > at[:, None]), axis=1)
            gap = place[:-1] + (place[:-1] > at[:, None])
            ranks = np.take_along_axis(np.pad(ranks, ((0, 0), (0, 1)), constant_values=_NONE), gap, axis=1)
            news = np.take_along_axis(np.pad(news, ((0, 0), (0, 1))), gap, axis=1)
            for side in (at - 1, at):
                ok = (side >= 0) & (side < width - 1)
                r, n = self.table.find(m[line[ok], side[ok]], m[line[ok], side[ok] + 1])
                ranks[line[ok], side[ok]], news[line[ok], side[ok]] = r, n

    def _long(self, ids: np.ndarray) -> np.ndarray:
        ranks, news = self.table.find(ids[:-1], ids[1:])
        while len(ranks) and (least := ranks.min()) < _NONE:
            at = np.flatnonzero(ranks == least)
            # Of places that follow one another every second one merges, counted from the first.
            start = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            run = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
            at = at[run % 2 == 0]
            ids = ids.copy()
            ids[at] = news[at]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids = ids[keep]
            ranks, news = self.table.find(ids[:-1], ids[1:])
        return ids


def vocabulary(path: str) -> Vocabulary:
    """Kept for as long as the process lives. Workers get this module's functions by value, so what they keep
    can't stand in the module."""
    kept = sys.modules.setdefault("_kept_vocabularies", types.ModuleType("_kept_vocabularies")).__dict__
    if path not in kept:
        kept[path] = Vocabulary(path)
    return kept[path]


class Encoder:
    """Encodes batches of texts, keeping the pieces met so far, each as the bytes of its ids."""

    def __init__(self, path: str):
        self.vocab, self.known = vocabulary(path), {}

    def packed(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as bytes of int32; equal texts are encoded once."""
        once = {t: self.vocab.split.findall(t) if t else [] for t in dict.fromkeys(texts)}
        every = set().union(*once.values())
        fresh = list(every.difference(self.known))
        if len(self.known) + len(fresh) > KEPT_PIECES:
            self.known, fresh = {}, list(every)
        self.known.update(zip(fresh, (x.tobytes() for x in self.vocab.encode_pieces(fresh)), strict=True))
        ids = {t: b"".join(map(self.known.__getitem__, s)) for t, s in once.items()}
        return [ids[t] for t in texts]

    def __call__(self, texts: list[str | None]) -> list[list[int]]:
        return [np.frombuffer(x, np.int32).tolist() for x in self.packed(texts)]


def vocabulary_path(name: str = "byte_bpe_50k", folder: str | None = None) -> str:
    return os.path.join(folder or DEFAULT_DIR, f"{name}.json")


def encode(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """(key, ids): the token ids of every text, without special tokens; their strings in a text are
    ordinary text. A null or empty text has an empty list. The vocabulary at `path` must be readable on
    every executor. Nothing is shuffled; other columns are never read; repeated keys stay repeated."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = Encoder(path)
        for b in batches:
            ids = e.packed(b.column(1).to_pylist())
            ends = np.cumsum([0, *map(len, ids)]) // 4
            values = pa.array(np.frombuffer(b"".join(ids), np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)], [key, "ids"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {dict(df.dtypes)[key]}, ids array<int>")


def count_tokens(df: DataFrame, keys: list[str], text: str, path: str | None = None) -> DataFrame:
    """(keys, n_tokens): as encode, but only the number of ids; 0 for a null or empty text."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = Encoder(path)
        for b in batches:
            sizes = pa.array([len(x) // 4 for x in e.packed(b.column(len(keys)).to_pylist())], pa.int64())
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keys))], sizes], [*keys, "n_tokens"])

    kinds = dict(df.dtypes)
    return df.select(*keys, text).mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", n_tokens bigint")
