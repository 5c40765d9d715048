"""Collocations of two and three words by direct-address tiles of frequency-ranked ids.

Words get ids by falling frequency. A pair of ids is a cell of a square tile of
``TILE`` times ``TILE`` cells; ranking puts the pairs of frequent words into few
tiles. Tasks count crowded tiles by a dense ``bincount`` and all other tiles as
sorted coordinates with counts, and hand on a row per strip of tiles. They are merged in two
rounds: strips inside groups of tasks, so that the fullest never meets the output of all tasks at once, then tile by tile.

Frequent pairs are ranked in turn, and a pair and its next word are counted in
tiles by the same steps.

Ids are given to the ``HEAD`` most frequent words and the ``HEAD_PAIRS`` most frequent pairs,
which bounds what is sent to tasks. Everything rarer is counted by its text in a
shuffle; a bitmap of fixed size keeps away most words and pairs that are too rare to matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import col
from .arrays import mixed, slices
from .bitmaps import bitmap, contains
from .common import saved, small

LEAST = 10  # occurrences of a candidate
TOP = 2000  # phrases returned per language
INSIDE = 50  # percent of a phrase's occurrences inside one longer candidate that drop it
HEAD = 1 << 19
HEAD_PAIRS = 1 << 20
SIDE = 11  # bits of an id inside a tile
TILE = 1 << SIDE
DENSE = TILE * TILE // 16  # occurrences from which a tile is counted densely
FILTER = 1 << 26  # bits of the bitmaps of rarer words and pairs
FLUSH = 32 << 20  # bytes of text whose word counts a task holds
FLUSH_IDS = 4 << 20  # bytes of text whose ids a task holds
CHUNK = 1 << 20  # bytes of one text that are split at once
HELD = 4 << 20  # cells of a strip that are held until equal ones are added up
ROWS = 20_000  # rows of a batch that a task hands on
SALTS = 8
BROADCAST = 500_000

BREAK = b"."  # stands for every end of a piece
_SPLIT = bytes.maketrans(
    bytes(range(ord("A"), ord("Z") + 1)) + b".,;:!?\n\x0b\x0c\r\t", bytes(range(ord("a"), ord("z") + 1)) + b".......... "
)
CELLS = 2 * SIDE  # bits of a cell's number in its tile
STRIP = HEAD >> SIDE  # tiles of a strip, which has the same ids on the left; cells of a strip fit into 32 bits
STRIPS = "strip long, salt int, cells binary, counts binary"
FOUND = STRIPS + ", lang string, phrase string, n long"


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, and ``BREAK`` between pieces, in lists that are not too long."""
    start = 0
    while start < len(text):
        stop = start + CHUNK
        stop = len(text) if stop >= len(text) else text.find(b" ", stop)
        stop = len(text) if stop < 0 else stop
        yield text[start:stop].translate(_SPLIT).replace(BREAK, b" . ").split()
        start = stop


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
        yield lang, text.as_buffer().to_pybytes()


def _word_counts(rows: DataFrame) -> DataFrame:
    """``lang, word, n``; the row without a word counts all words of the language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0

        def flush():
            for lang, words in held.items():
                words.pop(BREAK, None)
                items = chain([(None, sum(words.values()))], words.items())
                while part := list(islice(items, ROWS)):
                    texts = pa.array([w for w, _ in part], pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part)), texts, pa.array([n for _, n in part], pa.int64())], ["lang", "word", "n"]
                    )
            held.clear()

        for batch in batches:
            for part in slices(batch, "text"):
                for lang, text in _texts(part):
                    words = held.setdefault(lang, Counter())
                    for some in tokens(text):
                        words.update(some)
                    size += len(text)
                if size > FLUSH:
                    yield from flush()
                    size = 0
        yield from flush()

    return rows.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _most_frequent(table: DataFrame, n: str, most: int) -> Column:
    """Which rows are the most frequent, as many whole steps of frequency as have at most ``most`` rows together."""
    step = F.floor(F.log2(n) * 16).cast("int")
    counts = table.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()  # at most a thousand steps
    cut, rows = 1 << 20, 0
    for row in counts:
        rows += row["count"]
        if rows > most:
            break
        cut = row["step"]
    return step >= cut


class Words(NamedTuple):
    """What tasks know of words: frequent ones by id, those of a language with their ids, and a bitmap of the hashes of the others.

    Every Python process of an executor holds it, so words are Arrow arrays and not objects.
    """

    lang: pa.Array
    word: pa.Array
    hash: np.ndarray
    ids: dict[str, tuple[pa.Array, np.ndarray]]
    others: np.ndarray | None


@lru_cache(1024)
def _seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode())


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, _seed(lang))


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(FILTER)).astype(np.int64)


def _filter(others: DataFrame, columns: tuple[str, ...]) -> np.ndarray | None:
    """Bitmap of the hashes of words, or of pairs; none if there are no rows."""
    if others.isEmpty():
        return None

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            made = [
                np.array([word_hash(lang, w.encode()) for lang, w in zip(langs, batch.column(c).to_pylist())], np.uint64) for c in columns
            ]
            hashes = made[0] if len(made) == 1 else pair_hashes(*made)
            yield pa.RecordBatch.from_arrays([pa.array(_slots(hashes))], ["slot"])

    return bitmap(others.select("lang", *columns).mapInArrow(find, "slot long"), FILTER)


def _known_words(words: DataFrame, most: int) -> Words:
    frequent = _most_frequent(words, "n", most)
    head = words.where(frequent).toArrow().sort_by([("n", "descending"), ("lang", "ascending"), ("word", "ascending")])
    langs = head["lang"].combine_chunks().dictionary_encode() if head.num_rows else pa.array([], pa.string()).dictionary_encode()
    texts = head["word"].cast(pa.binary()).combine_chunks() if head.num_rows else pa.array([], pa.binary())
    codes, ids = np.asarray(langs.indices), {}
    for code, lang in enumerate(langs.dictionary.to_pylist()):
        own = np.flatnonzero(codes == code)
        found = pa.concat_arrays([texts.take(pa.array(own)), pa.array([BREAK], pa.binary())])
        ids[lang] = found, np.append(own, -2).astype(np.int32)
    hashes = np.fromiter((word_hash(lang, w.as_py()) for lang, w in zip(langs.to_pylist(), texts)), np.uint64, len(texts))
    return Words(langs, texts, hashes, ids, _filter(words.where(~frequent), ("word",)))


_NO_WORDS = pa.array([BREAK], pa.binary()), np.array([-2], np.int32)


class Pairs(NamedTuple):
    """What tasks know of pairs: sorted keys of frequent ones with their ranks, their words, and a bitmap of the others."""

    key: np.ndarray
    rank: np.ndarray
    first: np.ndarray
    second: np.ndarray
    others: np.ndarray | None


def _known_pairs(pairs: DataFrame, most: int) -> Pairs:
    both = F.col("first").isNotNull()
    ranked = pairs.where(both)
    frequent = _most_frequent(ranked, "a", most)
    head = ranked.where(frequent).select("first", "second", "a").toArrow()
    first, second, a = (np.asarray(head[c].combine_chunks()).astype(np.int64) if head.num_rows else np.zeros(0, np.int64) for c in head.column_names)
    order = np.lexsort((second, first, -a))
    first, second = first[order], second[order]
    key = first * HEAD + second
    sort = np.argsort(key)
    others = _filter(pairs.where(~(both & frequent)), ("w1", "w2"))
    return Pairs(key[sort], *(x.astype(np.int32) for x in (sort, first, second)), others)


class _Extra(dict):
    """Numbers of rarer words of a language: the next one when a word is first met."""

    def __init__(self, lang: str, extra: list[tuple[str, bytes]]):
        super().__init__()
        self.lang, self.extra = lang, extra

    def __missing__(self, word: bytes) -> int:
        at = self[word] = HEAD + len(self.extra)
        self.extra.append((self.lang, word))
        return at


class Reader:
    """Turns texts into word ids; ids from ``HEAD`` on are rarer words, numbered anew after each flush, and negative ones break."""

    def __init__(self, words: Words):
        self.words, self.extra = words, []
        self.held: dict[str, list[pa.Array]] = {}
        self.extra_hash = np.zeros(0, np.uint64)

    def read(self, lang: str, text: bytes) -> None:
        held = self.held.setdefault(lang, [])
        held += [pa.array(some, pa.binary()) for some in tokens(text)]
        held.append(_NO_WORDS[0])  # a text ends a piece

    def ids(self) -> np.ndarray:
        """All ids read since the last ``clear``, language by language; words that the bitmap rules out break."""
        found = [self._ids_of(lang, pa.chunked_array(held, pa.binary())) for lang, held in self.held.items()]
        self.held.clear()
        ids = np.concatenate(found) if found else np.zeros(0, np.int64)
        if self.extra:
            self.extra_hash = np.array([word_hash(lang, w) for lang, w in self.extra], np.uint64)
            rare = np.flatnonzero(ids >= HEAD)
            kept = contains(self.words.others, _slots(self.extra_hash))
            ids[rare] = np.where(kept[ids[rare] - HEAD], ids[rare], -1)
        return ids

    def _ids_of(self, lang: str, some: pa.ChunkedArray) -> np.ndarray:
        known, numbers = self.words.ids.get(lang, _NO_WORDS)
        at = pc.fill_null(pc.index_in(some, value_set=known), -1).to_numpy()
        ids = np.where(at >= 0, numbers[at], -1).astype(np.int64)
        if self.words.others is not None:
            rare = np.flatnonzero(ids == -1)
            extra = _Extra(lang, self.extra)
            ids[rare] = [extra[w] for w in some.take(pa.array(rare)).to_pylist()]
        return ids

    def clear(self) -> None:
        self.extra.clear()
        self.held.clear()

    def hashes(self) -> np.ndarray:
        return np.concatenate([self.words.hash, np.zeros(HEAD - len(self.words.hash), np.uint64), self.extra_hash])

    def name(self, at: int) -> tuple[str, bytes]:
        return self.extra[at - HEAD] if at >= HEAD else (self.words.lang[at].as_py(), self.words.word[at].as_py())


def _width(counts: np.ndarray) -> int:
    most = int(counts.max(initial=0))
    return next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w))


def _packed(cells: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    return cells.astype("<u4").tobytes(), counts.astype(f"<u{_width(counts)}").tobytes()


def _unpacked(cells: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Cells of 32 bits, and counts as narrow as they came, or signed."""
    found = np.frombuffer(cells, "<u4")
    width = len(counts) // max(1, len(found))
    return found, np.frombuffer(counts, f"<u{width}" if width < 8 else "<i8")


def _sorted_counts(cells: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells in order with their counts."""
    if counts is None:
        return np.unique(cells, return_counts=True)
    order = np.argsort(cells, kind="stable")
    cells, counts = cells[order], counts[order]
    new = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
    return cells[new], np.add.reduceat(counts, new, dtype=np.int64)


def _codes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of the tile, then of the cell."""
    tile = (left >> SIDE) * STRIP + (right >> SIDE)
    return tile << CELLS | (left & (TILE - 1)) << SIDE | (right & (TILE - 1))


def count_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of pairs of ids, in order, and their counts: crowded tiles by ``bincount``, the others by sorted coordinates."""
    code = _codes(left, right)
    if not len(code):
        return code, code
    tile = code >> CELLS
    size = np.bincount(tile)
    crowded = np.flatnonzero(size >= DENSE)
    place = np.full(len(size), -1)
    place[crowded] = np.arange(len(crowded))
    at = place[tile]
    found = [_sorted_counts(code[at < 0])]
    for rank, number in enumerate(crowded):
        row = np.bincount(code[at == rank] & ((1 << CELLS) - 1))
        cells = np.flatnonzero(row)
        found.append((number << CELLS | cells, row[cells]))
    codes, counts = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(codes, kind="stable")
    return codes[order], counts[order]


def _parts(codes: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Codes in order, cut where their upper part changes: that part, the lower ``bits`` bits, and the counts."""
    upper = codes >> bits
    starts = np.flatnonzero(np.concatenate([[True], upper[1:] != upper[:-1]])) if len(codes) else []
    for a, b in zip(starts, [*starts[1:], len(codes)]):
        yield int(upper[a]), codes[a:b] & ((1 << bits) - 1), counts[a:b]


STRIP_BITS = CELLS + STRIP.bit_length() - 1


class StripSum:
    """Adds up one strip, and gives up what it has where that is too much to hold."""

    def __init__(self, strip: int):
        self.strip, self.cells, self.counts, self.held = strip, [], [], 0

    def add(self, cells: np.ndarray, counts: np.ndarray) -> Iterator[tuple]:
        self.cells.append(cells)
        self.counts.append(counts)
        self.held += len(cells)
        if self.held >= HELD:
            cells, counts = _sorted_counts(np.concatenate(self.cells), np.concatenate(self.counts))
            self.cells, self.counts, self.held = [cells], [counts], len(cells)
            if self.held >= HELD // 2:
                yield from self.tiles()
                self.cells, self.counts, self.held = [], [], 0

    def tiles(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        if self.cells:
            cells, counts = _sorted_counts(np.concatenate(self.cells), np.concatenate(self.counts))
            yield from _parts(self.strip << STRIP_BITS | cells.astype(np.int64), counts, CELLS)


class TileSum:
    """Adds up one tile: coordinates while they are few, then a dense tile."""

    def __init__(self):
        self.cells, self.counts, self.held, self.dense = [], [], 0, None

    def add(self, cells: np.ndarray, counts: np.ndarray) -> None:
        self.cells.append(cells)
        self.counts.append(counts)
        self.held += len(cells)
        if self.held >= DENSE:
            self._fill()

    def _fill(self) -> None:
        if self.dense is None:
            self.dense = np.zeros(TILE * TILE, np.int64)
        for cells, counts in zip(self.cells, self.counts):
            np.add.at(self.dense, cells, counts)
        self.cells, self.counts, self.held = [], [], 0

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if self.dense is None:
            return _sorted_counts(np.concatenate(self.cells), np.concatenate(self.counts))
        if self.cells:
            self._fill()
        found = np.flatnonzero(self.dense)
        return found, self.dense[found]


def _merged_strips(rows: DataFrame) -> DataFrame:
    """``tile, cells, counts``: the strips of each group of tasks added up, as tiles."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(found):
            found = ((t, *_packed(cells, n)) for t, cells, n in found)
            while some := list(islice(found, 500)):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*some)], ["tile", "cells", "counts"])

        now, total = None, None
        for batch in batches:
            keys = zip(batch.column("strip").to_pylist(), batch.column("salt").to_pylist())
            for key, cells, counts in zip(keys, batch.column("cells"), batch.column("counts")):
                if key != now:
                    if total is not None:
                        yield from packed(total.tiles())
                    now, total = key, StripSum(key[0])
                yield from packed(total.add(*_unpacked(cells.as_py(), counts.as_py())))
        if total is not None:
            yield from packed(total.tiles())

    spread = rows.repartition("strip", "salt").sortWithinPartitions("strip", "salt")
    return spread.mapInArrow(merge, "tile long, cells binary, counts binary")


def _frequent_cells(tiles: DataFrame, least: int, make: Callable, schema: str) -> DataFrame:
    """All cells that are counted often enough, as rows that ``make(left, right, n)`` names; one tile at a time is held.

    The task that adds up tiles also names their ids: a step of its own would keep a second Python process for each core.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(tile, cells, counts):
            frequent = np.flatnonzero(counts >= least)
            for at in range(0, len(frequent), ROWS):
                some = frequent[at : at + ROWS]
                left, right = cells[some].astype(np.int64) >> SIDE, cells[some].astype(np.int64) & (TILE - 1)
                yield make((tile // STRIP << SIDE) + left, (tile % STRIP << SIDE) + right, counts[some])

        now, total = None, TileSum()
        for batch in batches:
            for tile, cells, counts in zip(batch.column("tile").to_pylist(), batch.column("cells"), batch.column("counts")):
                if tile != now:
                    if now is not None:
                        yield from made(now, *total.total())
                    now, total = tile, TileSum()
                total.add(*_unpacked(cells.as_py(), counts.as_py()))
        if now is not None:
            yield from made(now, *total.total())

    return tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(merge, schema)


def _counted(rows: DataFrame, find: Callable, least: int, make: Callable, schema: str) -> tuple[DataFrame, DataFrame]:
    """Frequent pairs of ids, as rows that ``make`` names, and frequent phrases with rarer words ``lang, phrase, n``.

    ``find(reader, ids)`` gives left and right ids, and the positions and lengths of other phrases.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, size = Reader(known.value), 0
        salt = TaskContext.get().partitionId() % SALTS
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.string(), pa.string(), pa.int64()]
        names = [c.split()[0] for c in FOUND.split(", ")]

        def flush():
            left, right, others = find(reader, reader.ids())
            strips = _parts(*count_pairs(left, right), STRIP_BITS)
            strips = ((t, salt, *_packed(cells, n), None, None, None) for t, cells, n in strips)
            rarer, counts = np.unique(others, axis=0, return_counts=True)
            phrases = (
                (None, None, None, None, parts[0][0], b" ".join(w for _, w in parts).decode(), n)
                for parts, n in zip(([reader.name(w) for w in words] for words in rarer.tolist()), counts.tolist())
            )
            for made in (strips, phrases):
                while some := list(islice(made, 500)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds)], names)
            reader.clear()

        for batch in batches:
            for part in slices(batch, "text"):
                for lang, text in _texts(part):
                    reader.read(lang, text)
                    size += len(text)
                if size > FLUSH_IDS:
                    yield from flush()
                    size = 0
        yield from flush()

    known = find.known
    found = saved(rows.mapInArrow(count, FOUND), "strips")
    strips = found.where("strip IS NOT NULL").select("strip", "salt", "cells", "counts")
    phrases = found.where("strip IS NULL").groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return _frequent_cells(_merged_strips(strips), least, make, schema), phrases


class _FindPairs:
    """Pairs of neighbouring words."""

    def __init__(self, known):
        self.known = known

    def __call__(self, reader: Reader, ids: np.ndarray):
        a, b = ids[:-1], ids[1:]
        both = (a >= 0) & (b >= 0)
        ranked = both & (a < HEAD) & (b < HEAD)
        other = np.flatnonzero(both & ~ranked)
        return a[ranked], b[ranked], np.stack([a[other], b[other]], 1)


class _FindTriples:
    """A frequent pair and its next word, where that and the pair's second word are frequent too."""

    def __init__(self, known, pairs):
        self.known, self.pairs = known, pairs

    def __call__(self, reader: Reader, ids: np.ndarray):
        known = self.pairs.value
        a, b = ids[:-1], ids[1:]
        both = (a >= 0) & (b >= 0)
        rank = np.full(len(a), -1)  # -1: no frequent pair, -2: perhaps a rarer one
        ranked = np.flatnonzero(both & (a < HEAD) & (b < HEAD))
        if len(known.key):
            key = a[ranked] * HEAD + b[ranked]
            at = np.minimum(np.searchsorted(known.key, key), len(known.key) - 1)
            rank[ranked] = np.where(known.key[at] == key, known.rank[at], -1)
        if known.others is not None:
            hashes = reader.hashes()
            open_ = np.flatnonzero(both & (rank < 0))
            hit = contains(known.others, _slots(pair_hashes(hashes[a[open_]], hashes[b[open_]])))
            rank[open_[hit]] = -2
        start = np.flatnonzero((rank[:-1] != -1) & (rank[1:] != -1)) if len(rank) > 1 else np.zeros(0, np.int64)
        direct = (rank[start] >= 0) & (ids[start + 2] < HEAD)
        other = start[~direct]
        return rank[start[direct]], ids[start[direct] + 2], np.stack([ids[other], ids[other + 1], ids[other + 2]], 1)


def _pair_table(rows: DataFrame, known) -> DataFrame:
    """Frequent pairs ``lang, w1, w2, a`` with the ids of their words, where both have one."""

    def named(left, right, n):
        words = known.value
        return pa.RecordBatch.from_arrays(
            [
                words.lang.take(pa.array(left)).dictionary_decode(),
                *(words.word.take(pa.array(side)).cast(pa.string()) for side in (left, right)),
                pa.array(n), pa.array(left), pa.array(right),
            ],
            ["lang", "w1", "w2", "a", "first", "second"],
        )

    schema = "lang string, w1 string, w2 string, a long, first long, second long"
    direct, phrases = _counted(rows, _FindPairs(known), LEAST, named, schema)
    parts = F.split("phrase", " ")
    none = F.lit(None).cast("long")
    other = phrases.select("lang", parts[0].alias("w1"), parts[1].alias("w2"), F.col("n").alias("a"), none.alias("first"), none.alias("second"))
    return saved(direct.unionByName(other), "pairs")


def _triple_table(rows: DataFrame, known, pairs) -> DataFrame:
    """Frequent triples ``lang, w1, w2, w3, a``."""

    def named(left, right, n):
        words, ranked = known.value, pairs.value
        sides = ranked.first[left], ranked.second[left], right
        return pa.RecordBatch.from_arrays(
            [
                words.lang.take(pa.array(right)).dictionary_decode(),
                *(words.word.take(pa.array(side)).cast(pa.string()) for side in sides),
                pa.array(n),
            ],
            ["lang", "w1", "w2", "w3", "a"],
        )

    direct, phrases = _counted(rows, _FindTriples(known, pairs), LEAST, named, "lang string, w1 string, w2 string, w3 string, a long")
    parts = F.split("phrase", " ")
    other = phrases.select("lang", *(parts[i].alias(f"w{i + 1}") for i in range(3)), F.col("n").alias("a"))
    return saved(direct.unionByName(other), "triples")


def _score(a: str, l: str, r: str) -> Column:
    """``floor(1000000 * a * a / (l * r))`` in whole numbers of up to 38 digits."""
    whole = lambda c: f"CAST({c} AS DECIMAL(18,0))"
    return F.expr(f"(CAST(1000000 AS DECIMAL(7,0)) * {whole(a)} * {whole(a)}) DIV ({whole(l)} * {whole(r)})").cast("long")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", head: int = HEAD, head_pairs: int = HEAD_PAIRS
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``TOP`` phrases of each language.

    A phrase is two or three neighbouring words of one piece of a text that occur
    together at least ``LEAST`` times. It scores by its worst cut into two parts, and
    is left out if a longer candidate holds ``INSIDE`` percent of its occurrences.

    A missing text has no words, a missing language is ``und``; rows without words
    and languages without candidates give no rows, and an empty table gives an empty one.
    Repeated rows count as often as they occur. Equal scores are ordered by occurrences,
    then by the phrase, so that no ties are left. Other columns are not read.
    ``head`` and ``head_pairs`` say how many words and pairs are ranked, at most ``HEAD``
    and ``HEAD_PAIRS``; they change the way of counting, never the result.
    """
    rows = docs.select(F.coalesce(col(lang), F.lit("und")).alias("lang"), F.coalesce(col(text), F.lit("")).alias("text"))
    counted = saved(_word_counts(rows).where(F.col("word").isNull() | (F.col("n") >= LEAST)), "words")
    words = counted.where("word IS NOT NULL")
    context = docs.sparkSession.sparkContext
    known = context.broadcast(_known_words(words, min(head, HEAD)))  # at most HEAD words and FILTER bits
    pairs = _pair_table(rows, known)
    ranked = context.broadcast(_known_pairs(pairs, min(head_pairs, HEAD_PAIRS)))  # at most HEAD_PAIRS pairs and FILTER bits
    triples = _triple_table(rows, known, ranked)
    known.unpersist()
    ranked.unpersist()

    words, few_pairs = small(words, BROADCAST), small(pairs.select("lang", "w1", "w2", "a"), BROADCAST)
    one = lambda at, name: words.select("lang", F.col("word").alias(at), F.col("n").alias(name))
    two = lambda x, y, name: few_pairs.select("lang", F.col("w1").alias(x), F.col("w2").alias(y), F.col("a").alias(name))
    longer = triples.select(
        "lang", "a", F.explode(F.array(F.struct(F.col("w1").alias("x"), F.col("w2").alias("y")), F.struct(F.col("w2").alias("x"), F.col("w3").alias("y")))).alias("p")
    ).groupBy("lang", F.col("p.x").alias("w1"), F.col("p.y").alias("w2")).agg(F.max("a").alias("longer"))
    bigrams = (
        pairs.select("lang", "w1", "w2", "a")
        .join(longer, ["lang", "w1", "w2"], "left")
        .where(F.coalesce(100 * F.col("longer") < INSIDE * F.col("a"), F.lit(True)))
        .join(one("w1", "l"), ["lang", "w1"])
        .join(one("w2", "r"), ["lang", "w2"])
        .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    )
    cuts = (
        triples.join(two("w1", "w2", "l2"), ["lang", "w1", "w2"])
        .join(two("w2", "w3", "r1"), ["lang", "w2", "w3"])
        .join(one("w1", "l1"), ["lang", "w1"])
        .join(one("w3", "r2"), ["lang", "w3"])
        .withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
    )
    early = F.col("s1") <= F.col("s2")
    either = lambda x, y, name: F.when(early, F.col(x)).otherwise(F.col(y)).alias(name)
    trigrams = cuts.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", either("l1", "l2", "l"), either("r1", "r2", "r"), either("s1", "s2", "score")
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked_rows = bigrams.unionByName(trigrams).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TOP)
    totals = counted.where("word IS NULL").select("lang", "n")
    return ranked_rows.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
