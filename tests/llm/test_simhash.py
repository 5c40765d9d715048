"""SimHash groups against all pairs, and the covering code."""

import random
import re

import numpy as np
import pytest
import xxhash

from plumbline.llm import simhash
from plumbline.llm.queries import QUERIES
from plumbline.llm.simhash import differences, fingerprint, homes, links, reached, shingle_hashes, simhash_groups

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, print long, anchor string, component_id string, id long"


def docs(spark, rows):
    """Extra columns have names the operator uses itself."""
    return spark.createDataFrame([(i, t, 1, "a", "c", 2) for i, t in rows], SCHEMA)


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints):
    """The number of the component of each fingerprint, over all pairs."""
    bits, top = np.array(prints, np.uint64), list(range(len(prints)))

    def find(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for i in range(len(bits)):
        for j in np.flatnonzero(np.bitwise_count(bits[i] ^ bits[: i]) <= 2).tolist():
            top[find(i)] = find(j)
    return [find(i) for i in range(len(bits))]


def brute(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    group, least = grouped(prints), {}
    for g, (i, _) in zip(group, rows):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return sorted(((i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(rows, prints, group)), key=str)


def some_rows():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    rows = [(900, None), (901, ""), (902, " \t\n"), (903, "One"), (904, "one two"), (905, "ONE  Two"), (906, "É é"), (907, "日本 語 文")]
    for i in range(120):
        text = [rng.choice(words) for _ in range(rng.choice([3, 20, 200, 600]))]
        rows.append((i, " ".join(text)))
        for j in range(rng.choice([0, 0, 1, 3])):
            other = list(text)
            for _ in range(rng.choice([0, 1, 1, 2])):
                other[rng.randrange(len(other))] = rng.choice(words)
            rows.append((1000 + 10 * i + j, "\n ".join(other)))
    return rows + [(None, "one two"), (3, rows[20][1]), (3, rows[20][1]), (None, "alone in the world"), (None, "alone in the world")]


def test_groups_equal_all_pairs(spark):
    rows = some_rows()
    found = simhash_groups(docs(spark, rows))
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    want = brute(rows)
    assert len({c for _, _, c in want}) < len(rows) - 40  # there are links
    assert sorted((tuple(r) for r in found.collect()), key=str) == want


def test_query_equals_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in QUERIES["op12_simhash"](spark, FOLDER).collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert simhash_groups(docs(spark, []).limit(0)).collect() == []


def test_long_texts_are_hashed_whole(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice(["Ab", "cé", "d "]) + rng.choice([" ", "\n", "  "]) for _ in range(3000))
    whole = [h for some in shingle_hashes(text.encode()) for h in some.tolist()]
    monkeypatch.setattr(simhash, "CHUNK", 50)
    assert [h for some in shingle_hashes(text.encode()) for h in some.tolist()] == whole
    assert fingerprint(text.encode()) == plain_fingerprint(text)
    assert [len(s) for s in shingle_hashes(b"a" * 400)] == [1]


def test_code_is_perfect_and_covers_every_pair():
    assert differences(0).shape == (2048, 1) and (differences(0) >= 0).all()
    rng = np.random.default_rng(2)
    prints = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    others = prints.copy()
    for k in (0, 1):
        others ^= np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64)
    near = {}
    for at, anchors in reached(others, 2):
        for i, a in zip(at.tolist(), anchors.tolist()):
            assert a not in near.setdefault(i, set())  # every anchor once
            near[i].add(a)
    assert all(h in near[i] for i, h in enumerate(homes(prints).tolist()))


@pytest.mark.parametrize("most, crowd", [(1, 512), (2, 512), (2, 1_000_000), (2, 4), (1, 4), (2, 0)])
def test_crowds_and_pairs_are_linked_alike(spark, most, crowd):
    rng = np.random.default_rng(6)
    center = np.uint64(0x0123456789ABCDEF)
    flips = [np.uint64(1) << rng.integers(0, 64, 3000, dtype=np.uint64) for _ in range(5)]
    packed = np.full(3000, center)
    for k, flip in enumerate(flips):
        packed[k * 300 :] ^= flip[k * 300 :]
    lonely = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    prints = np.unique(np.concatenate([packed, lonely, lonely[:100] ^ np.uint64(1 << 63), lonely[100:200] ^ np.uint64(5)]))
    table = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "print long")
    pairs = [(r["a"], r["b"]) for r in links(table, most, crowd).collect()]
    signed = prints.view(np.int64).tolist()
    place, top = {p: i for i, p in enumerate(signed)}, list(range(len(signed)))

    def find(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for a, b in pairs:
        top[find(place[a])] = find(place[b])
    got = [find(i) for i in range(len(signed))]
    bits, want = prints, list(range(len(signed)))

    def root(x):
        while want[x] != x:
            want[x] = want[want[x]]
            x = want[x]
        return x

    for i in range(len(bits)):
        for j in np.flatnonzero(np.bitwise_count(bits[i] ^ bits[:i]) <= most).tolist():
            want[root(i)] = root(j)
    want = [root(i) for i in range(len(signed))]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want)) < len(signed)
    assert len(pairs) < 80 * len(signed)
