"""Collocations against brute force: whole words, rarer words, tiles."""

import pickle
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import collocations as module
from plumbline.llm.collocations import CELLS, STRIP_BITS, TILE, HEAD, StripSum, TileSum, _packed, _parts, _unpacked, collocations, count_pairs, tokens

SCHEMA = "doc_id long, text string, lang string, word string, n long, phrase string, rank long, tile long"


def docs(spark, rows):
    """Extra columns have names the operator uses itself."""
    return spark.createDataFrame([(i, t, g, "w", 1, "p", 2, 3) for i, (t, g) in enumerate(rows)], SCHEMA)


def brute(rows):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[(lang, *w[i : i + k])] += 1
    out = []
    for (lang, *w), a in f.items():
        if len(w) < 2 or a < 10:
            continue
        longer = [b for (g, *v), b in f.items() if g == lang and len(v) > len(w) and b >= 10 and w in (v[:2], v[1:])]
        if any(100 * b >= 50 * a for b in longer):
            continue
        cuts = [(10**6 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    result, seen = [], Counter()
    for lang, score, a, phrase, l, r in sorted(out):
        seen[lang] += 1
        if seen[lang] <= 2000:
            result.append((lang, seen[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return result


def some_rows(seed=5):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "à", "ÀÉ", "日本", "x\x1cy", "a", "b", "rare"]
    weights = [30, 5, 20, 9, 9, 8, 4, 4, 4, 2, 3, 3, 1]
    rows = [(None, None), ("", "en"), (" \t\n", "en"), ("...!?", None)]
    for _ in range(150):
        text = ""
        for _ in range(rng.randint(0, 40)):
            text += rng.choices(words, weights)[0] + rng.choice([" ", " ", "  ", "\t", ", ", "\n", "\r", "\x0b", "."])
        rows.append((text, rng.choice(["en", "en", None, "und", "fr"])))
    return rows + rows[20:60]


@pytest.mark.parametrize("head, pairs", [(1 << 18, 1 << 20), (20, 1 << 20), (1 << 18, 10), (12, 5), (0, 0)])
def test_equals_brute_force_however_few_are_ranked(spark, head, pairs):
    rows = some_rows()
    found = collocations(docs(spark, rows), head=head, head_pairs=pairs)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in found.collect()) == sorted(brute(rows))


def test_empty_table(spark):
    assert collocations(docs(spark, []).limit(0)).collect() == []


def test_long_text_is_split_like_short_ones(spark):
    text = "alpha beta gamma, delta " * 120_000  # several chunks
    assert sum(len(t) for t in tokens(text.encode())) == 5 * 120_000
    rows = {r["phrase"]: r for r in collocations(docs(spark, [(text, "en")])).collect()}
    assert rows["alpha beta gamma"]["a"] == 120_000
    assert rows["alpha beta gamma"]["n"] == 480_000


def test_score_is_exact_beyond_64_bits(spark):
    from plumbline.llm.collocations import _score

    rows = [(9_876_543_210_123, 9_876_543_210_127, 9_876_543_210_129), (10, 10, 10), (3_000_000_000, 4_000_000_000, 5_000_000_001)]
    table = spark.createDataFrame(rows, "a long, l long, r long")
    got = [r[0] for r in table.select(_score("a", "l", "r")).collect()]
    assert got == [10**6 * a * a // (l * r) for a, l, r in rows]


@pytest.mark.parametrize("held", [1 << 22, 5_000])
def test_dense_and_sparse_tiles_count_the_same(monkeypatch, held):
    monkeypatch.setattr(module, "HELD", held)
    rng = np.random.default_rng(3)
    left = np.concatenate([rng.integers(0, 40, 900_000), rng.integers(0, HEAD, 5_000)])
    right = np.concatenate([rng.integers(500, 540, 900_000), rng.integers(0, HEAD, 5_000)])
    strips, sums, got = {}, {}, {}
    for half in (slice(0, 450_000), slice(450_000, None)):
        for strip, cells, counts in _parts(*count_pairs(left[half], right[half]), STRIP_BITS):
            for tile, *found in strips.setdefault(strip, StripSum(strip)).add(*_unpacked(*_packed(cells, counts))):
                sums.setdefault(tile, TileSum()).add(*found)
    for total in strips.values():
        for tile, *found in total.tiles():
            sums.setdefault(tile, TileSum()).add(*found)
    for tile, total in sums.items():
        for cell, n in zip(*total.total()):
            got[tile // (HEAD // TILE) * TILE + cell // TILE, tile % (HEAD // TILE) * TILE + cell % TILE] = n
    assert got == Counter(zip(left.tolist(), right.tolist()))


def test_crowded_sum_turns_dense():
    total, want = TileSum(), Counter()
    rng = np.random.default_rng(4)
    for _ in range(100):
        cells = np.unique(rng.integers(0, TILE * TILE, 4_000))
        total.add(cells, np.full(len(cells), 300))
        want.update({int(c): 300 for c in cells})
    assert total.dense is not None
    assert dict(zip(*(x.tolist() for x in total.total()))) == want


def test_tasks_hold_few_bytes_a_word(spark):
    words = spark.range(20_000).select(F.lit("en").alias("lang"), F.concat(F.lit("word"), "id").alias("word"), F.lit(10).alias("n"))
    sent = pickle.dumps(module._known_words(words, HEAD))
    tracemalloc.start()
    known = pickle.loads(sent)
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(known.word) == 20_000 and held < 100 * 20_000
    reader = module.Reader(known)
    reader.read("en", b"word7 none. word12")
    found = reader.ids()
    assert [reader.name(i) for i in found[found >= 0]] == [("en", b"word7"), ("en", b"word12")]
    assert found[1] == -1 and found[2] == -2 and found[-1] == -2


def test_naming_adds_no_python_processes_to_adding_up(spark, monkeypatch):
    plans, saved = {}, module.saved

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().sparkPlan().toString()
        return saved(df, label)

    monkeypatch.setattr(module, "saved", seen)
    collocations(docs(spark, some_rows())).collect()
    for label in ("pairs", "triples"):
        steps = re.findall(r"MapInArrow|PythonMapInArrow|Exchange", plans[label])
        assert any("MapInArrow" in x for x in steps)
        assert all("Exchange" in (x, y) for x, y in zip(steps, steps[1:]))


def test_strips_are_held_in_few_bytes_a_cell():
    packed = _packed(np.arange(1_000_000), np.ones(1_000_000, np.int64))
    total = StripSum(3)
    tracemalloc.start()
    assert list(total.add(*_unpacked(*packed))) == []
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 6 * 1_000_000
    assert sum(int(n.sum()) for _, _, n in total.tiles()) == 1_000_000


def test_narrow_counts_add_up_beyond_their_width():
    total = StripSum(0)
    for _ in range(3):
        assert list(total.add(*_unpacked(*_packed(np.arange(5), np.full(5, 200))))) == []
    assert list(total.add(*_unpacked(*_packed(np.arange(5), np.full(5, 1 << 40))))) == []
    ((_, cells, counts),) = total.tiles()
    assert cells.tolist() == list(range(5)) and counts.tolist() == [600 + (1 << 40)] * 5
