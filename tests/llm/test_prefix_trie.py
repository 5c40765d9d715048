"""The prefix trie against a plain trie, with long conversations over many ranges."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from plumbline.llm import prefix_trie as trie
from plumbline.llm.prefix_trie import prefix_trie, running, sketch

SCHEMA = "conv_id long, turn long, role string, text string, depth long, hi string, conv string, n long"


def talks(spark, rows):
    """Extra columns have names the operator uses itself."""
    return spark.createDataFrame([(*r, 1, "h", "c", 2) for r in rows], SCHEMA)


def rebuilt(rows):
    have = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            have[conv].append((turn is not None, turn or 0, role or "", text or ""))
    have = {c: [(role, text) for _, _, role, text in sorted(t)] for c, t in have.items()}
    out = {}
    for c, own in have.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = have.get(c - c % 20, [])[:h] + own[h:]
    return out


def brute(rows):
    whole = rebuilt(rows)
    members = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, some in members.items():
        gain = (len(some) - 1) * (len(re.findall(r"[^\x20\x09-\x0d]+", p[-1][1])) if p else 0)
        for d in range(len(p) + 1):
            saved[p[:d]] += gain
            leaves[p[:d]] += children[p] == 0
    out = []
    for p, some in members.items():
        ends = ",".join(str(c) for c in sorted(some) if len(whole[c]) == len(p))
        out.append((
            min(some), len(p), min(members[p[:-1]]) if p else None, len(some), children[p], leaves[p], saved[p],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def some_rows(seed=4, convs=160):
    rng = random.Random(seed)
    says = ["yes", "no", "", None, "tell me\nmore  please", "É 日本", " "]
    rows = []
    for c in rng.sample(range(0, 400), convs):
        for t in range(rng.choice([1, 1, 2, 3, 4, 6])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(says[: rng.choice([2, 4, 7])])))
    rows += [(None, 1, "user", "lost"), (None, None, None, None)]
    return rows + rows[10:20]  # repeated rows are turns


def compare(spark, rows):
    found = prefix_trie(talks(spark, rows))
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("seed", [4, 5])
def test_equals_plain_trie(spark, seed):
    compare(spark, some_rows(seed))


@pytest.fixture
def uneven(spark):
    """Many ranges, which are not put together again."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", before)


def test_long_conversations_and_crowds_over_many_ranges(spark, uneven, monkeypatch):
    rng = random.Random(3)
    rows = [(60, t, "user", rng.choice(["a", "b c"])) for t in range(400)]  # most of all rows in one conversation
    rows += [(61, *r[1:]) for r in rows[:300]]  # and a long copy of its start
    for c in range(100, 180):  # copies of one conversation that are no group
        rows += [(c, t, "user", "same words") for t in range(5)]
    rows += [r for r in some_rows(9, 60) if r[0] is not None and 200 <= r[0]]
    monkeypatch.setattr(trie, "CHUNK", 40)
    compare(spark, rows)


def test_empty_table_and_one_conversation(spark):
    assert prefix_trie(talks(spark, []).limit(0)).collect() == []
    compare(spark, [(7, 0, "user", "hello there")])
    compare(spark, [(None, 0, "user", "hello there")])


def test_sketch_never_counts_too_little(spark):
    rows = [(i, 1, i * 7919, i * 104729) for i in range(3000)] + [(5000 + i, 1, i * 7919, i * 104729) for i in range(40)]
    table = spark.createDataFrame(rows, "conv long, depth long, hi long, lo long")
    often, words = sketch(table)
    word, x, y = trie._cells("hi", "lo", words)
    marked = table.withColumns({"word": word, "x": x, "y": y}).join(often, "word", "left")
    many = {r["conv"] for r in marked.where("(shiftrightunsigned(cells, x) & shiftrightunsigned(cells, y) & 1L) = 1").collect()}
    assert set(range(40)) <= many
    assert len(many) < 1500  # most of the others are proved to be single


def test_running_totals_over_ranges(spark, uneven):
    rows = [(1, i, i % 7) for i in range(500)] + [(g, i, g) for g in range(2, 60) for i in range(3)] + [(99, i, i) for i in range(300)]
    table = spark.createDataFrame(rows, "g long, at long, v long")
    made = running(table, "g", "at", {"total": F.col("v")}, {"mark": F.col("v") * 31})
    want, state = [], {}
    for g, at, v in sorted(rows):
        total, mark = state.get(g, (0, 0))
        state[g] = total + v, mark ^ (v * 31)
        want.append((g, at, v, *state[g]))
    assert sorted(tuple(r) for r in made.select("g", "at", "v", "total", "mark").collect()) == want
