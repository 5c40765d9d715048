"""Token ids of whole texts by a vocabulary file of a byte-level BPE, inside tasks.

Such a tokenizer splits a text into pieces before it merges pairs, and no merge
crosses a piece. Texts are cut where the split certainly falls: before white
space that follows a visible character, after a lone line break, and between an
ASCII letter and ASCII punctuation other than the apostrophe. Each distinct
part is encoded once by the tokenizers library and then looked up by its hash.
Texts with white space outside ASCII or with a special token are encoded whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from .arrays import Texts, segments

MOST_PARTS = 2_500_000  # parts a worker remembers, about 40 bytes each; then it starts afresh
_WIDE_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_SPACE, _LETTER, _MARK = (np.zeros(256, bool) for _ in range(3))
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b != 0x27]] = True


def _cuts(texts: Texts) -> np.ndarray:
    """First bytes of all parts."""
    data = texts.data
    space, letter, mark = _SPACE[data], _LETTER[data], _MARK[data]
    # the second byte of a letter from U+00C0 to U+00FF also ends a letter
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    cut = np.zeros(len(data), bool)
    cut[1:] = (space[1:] & ~space[:-1]) | (letter[:-1] & mark[1:]) | (mark[:-1] & _LETTER[data[1:]])
    lone = space[1:-1] & (data[1:-1] != 0x20) & ~space[:-2] & ~space[2:]
    cut[2:] |= lone
    cut[texts.starts()] = True
    return np.flatnonzero(cut)


class Encoder:
    """Encodes as ``Tokenizer.encode(text, add_special_tokens=False)`` does."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._special = re.compile("|".join(map(re.escape, special)) or "(?!)")
        self._forget()

    def _forget(self):
        self._hash, self._at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._size, self._ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of each text's ids."""
        ids = [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes

    def _learn(self, texts: Texts, start: np.ndarray, end: np.ndarray, hashes: np.ndarray):
        data = texts.data.tobytes()
        ids, sizes = self._plain([data[a:b].decode() for a, b in zip(start.tolist(), end.tolist())])
        at = len(self._ids) + np.cumsum(sizes) - sizes
        places = np.searchsorted(self._hash, hashes)
        self._hash, self._at = np.insert(self._hash, places, hashes), np.insert(self._at, places, at)
        self._size, self._ids = np.insert(self._size, places, sizes), np.concatenate([self._ids, ids])

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self._hash):
            return np.zeros(len(hashes), bool)
        return self._hash[np.minimum(np.searchsorted(self._hash, hashes), len(self._hash) - 1)] == hashes

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (uint32), and the number of each text's ids."""
        column = column.cast(pa.large_string())
        whole = [bool(t and (_WIDE_SPACE.search(t) or self._special.search(t))) for t in column.to_pylist()]
        if any(whole):
            return self._mixed(column, np.array(whole))
        texts = Texts(column)
        start = _cuts(texts)
        end = np.append(start[1:], len(texts.data))
        hashes = texts.hashes(start, end)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        new = ~self._known(distinct)
        if new.any() and len(self._hash) + new.sum() > MOST_PARTS:
            self._forget()
            new[:] = True
        if new.any():
            at = first[new]
            self._learn(texts, start[at], end[at], distinct[new])
        entry = np.searchsorted(self._hash, distinct)[which]
        sizes = self._size[entry]
        run, place = segments(sizes)
        ids = self._ids[self._at[entry][run] + place]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        bounds = ends[np.searchsorted(start, texts.offsets)]
        return ids, np.diff(bounds)

    def _mixed(self, column: pa.Array, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts that must be encoded whole, between the others."""
        sizes = np.zeros(len(column), np.int64)
        parts = {}
        for flag, encode in ((True, lambda c: self._plain(c.to_pylist())), (False, self)):
            ids, sizes[whole == flag] = encode(column.filter(pa.array(whole == flag)))
            parts[flag] = ids
        owner, _ = segments(sizes)
        out = np.empty(len(owner), np.uint32)
        for flag in parts:
            out[whole[owner] == flag] = parts[flag]
        return out, sizes


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary file."""
    return Encoder(path)
