"""Substring dedup and the similarity join against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from plumbline.llm import ngram_join
from plumbline.llm.ngram_join import drop_near_copies, near_copies, prefix_lengths
from plumbline.llm.substring_dedup import remove_repeats
from plumbline.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0d]+"
DOCS = "doc_id long, text string, __key string, n long, source string"


def docs(spark, rows):
    """Extra columns have names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 1, None) for i, t in rows], DOCS)


def repeats(rows, size):
    split = [(i, re.findall(WORD, t or "")) for i, t in rows]
    seen = Counter(tuple(w[s : s + size]) for _, w in split for s in range(len(w) - size + 1))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for s in range(len(w) - size + 1):
            if seen[tuple(w[s : s + size])] > 1:
                gone[s : s + size] = [True] * size
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def linked(rows):
    sets = []
    for _, t in rows:
        w = re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[j : j + 3]) for j in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} - {()})
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    have = defaultdict(list)
    for x, s in enumerate(sets):
        common = Counter(y for t in s for y in have[t])
        for y, k in common.items():
            if 100 * k >= 90 * (len(s) + len(sets[y]) - k):
                top[find(x)] = find(y)
        for t in s:
            have[t].append(x)
    least = {}
    for x, (i, _) in enumerate(rows):
        least[find(x)] = min(least.get(find(x), i), i)
    return sorted((i, len(sets[x]), least[find(x)]) for x, (i, _) in enumerate(rows))


def changed(text, n):
    words = text.split()
    for _ in range(n):
        words[random.randrange(len(words))] = f"z{random.randrange(10**6)}"
    return " ".join(words)


EDGES = [(9000, None), (9001, ""), (9002, "a b"), (9003, "A b"), (9004, "a"), (9005, " \n"), (9006, "a b")]


@pytest.mark.parametrize("size", [7, 12])
def test_repeats_in_texts_of_few_words(spark, size):
    random.seed(size)
    rows = [(i, " ".join(random.choices("abc" if i % 2 else "abcdefgh", k=random.randint(0, 120)))) for i in range(40)]
    rows += rows[:3] + EDGES + [(102, "\t".join(rows[7][1].split()) + " " + (rows[9][1] or "")), (102, "x")]
    assert sorted((tuple(r) for r in remove_repeats(docs(spark, rows), size).collect()), key=str) == repeats(rows, size)


def test_repeats_of_the_driver_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op3_substring_dedup"](spark, FOLDER).collect()), key=str)
    assert got == repeats(rows, 35) and any(r[2] for r in got)


def test_kept_text_and_empty_table(spark):
    rows = [(1, "p q r s t u v w"), (2, "a p q r s t u v w b"), (3, "c d")]
    out = remove_repeats(docs(spark, rows), 8, with_text=True).orderBy("doc_id").collect()
    assert [r["kept_text"] for r in out] == ["", "a b", "c d"]
    assert remove_repeats(docs(spark, []), 8).count() == 0


def test_links_of_near_copies_and_shared_passages(spark):
    random.seed(5)
    base = [" ".join(f"w{random.randrange(5000)}" for _ in range(random.randint(30, 300))) for _ in range(8)]
    rows = list(enumerate(base)) + [(1000 + j, changed(random.choice(base), random.choice([0, 1, 2, 3, 4, 8]))) for j in range(150)]
    rows += [(3000 + j, base[0][:200] + " " + " ".join(f"q{random.randrange(10**6)}" for _ in range(random.randint(3, 60)))) for j in range(80)]
    rows += [(5000 + j, changed(base[1], random.choice([1, 2, 3, 5]))) for j in range(80)] + EDGES + rows[:3]
    assert sorted(tuple(r) for r in near_copies(docs(spark, rows)).collect()) == linked(rows)


def crowd(n, seed):
    """Near copies of one text that is not among them: words replaced, left out, put in and appended."""
    random.seed(seed)
    base = [f"w{random.randrange(5000)}" for _ in range(148)]
    rows = []
    for j in range(n):
        words = changed(" ".join(base), random.choice([1, 1, 2, 2, 3, 4, 5, 8])).split()
        if j % 7 == 0:
            del words[random.randrange(len(words))]
        if j % 5 == 0:
            words.insert(random.randrange(len(words)), f"i{random.randrange(20)}")
        if j % 11 == 0:
            words += [f"e{i}" for i in range(random.randint(1, 12))]
        rows.append((j, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_links_of_many_copies_of_an_absent_text(spark, seed):
    rows = crowd(500, seed) + [(1000 + j, t + " " + " ".join(f"t{j}-{i}" for i in range(j))) for j, (_, t) in enumerate(crowd(40, seed))]
    assert sorted(tuple(r) for r in near_copies(docs(spark, rows)).collect()) == linked(rows)


def test_pairs_of_one_hub_grow_with_the_copies(spark, monkeypatch):
    from plumbline.llm import ngram_join

    made = {}
    around = ngram_join._around

    def counted(compared, known, percent):
        out = around(compared, known, percent)
        made[n] = out.count()
        return out

    monkeypatch.setattr(ngram_join, "_around", counted)
    for n in (400, 1600):
        near_copies(docs(spark, crowd(n, 3))).count()
    assert made[1600] <= 6 * max(made[400], n // 8)


def test_links_of_the_driver_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in QUERIES["op7_ngram_join"](spark, FOLDER).collect()) == linked(rows)


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(5, text), (3, text + " x"), (3, text + " x"), (None, text + " y"), (7, None), (7, ""), (8, "other words here"), (3, "not alike at all")]
    kept = drop_near_copies(docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "__key", "n", "source"] or set(kept.columns) >= {"doc_id", "text"}
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(3, text + " x"), (7, None), (7, ""), (8, "other words here"), (3, "not alike at all")], key=str)
    assert near_copies(docs(spark, [])).count() == 0


def test_costly_prefixes_are_longer():
    import numpy as np

    needed, length = prefix_lengths(np.array([100, 100, 3]), np.array([0, 1000, 10**6]))
    assert needed.tolist() == [1, 5, 3] and length.tolist() == [11, 15, 3]


def kept_alone(rows, size, percent):
    """The smallest key of each component, by all pairs."""
    sets = []
    for _, t in rows:
        w = t.lower().split()
        sets.append({tuple(w[j : j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()})
    group = list(range(len(rows)))
    for x, s in enumerate(sets):
        for y in range(x):
            if s and sets[y] and 100 * len(s & sets[y]) >= percent * len(s | sets[y]):
                group = [group[x] if g == group[y] else g for g in group]
    return sorted(min(rows[x][0] for x in range(len(rows)) if group[x] == g) for g in set(group))


def test_near_copies_in_the_pipeline_against_all_pairs(spark):
    import corpus_pipeline

    random.seed(11)
    base = [[f"w{random.randrange(5000)}" for _ in range(random.randint(60, 150))] for _ in range(6)]
    base[0] = [f"v{j}" for j in range(100)]
    swapped = base[0][:30] + ["x1"] + base[0][31:70] + ["x2"] + base[0][71:]  # 86 of 106 shingles of five words, 92 of 104 of three
    longer = base[0] + [f"y{j}" for j in range(15)]
    rows = [(j, " ".join(w)) for j, w in enumerate(base)] + [(100, " ".join(swapped)), (101, " ".join(longer)), (102, "a b"), (103, "A b")]
    rows += [(200 + j, changed(" ".join(base[j % 6]), j % 9)) for j in range(100)]
    rows += [(400 + j, " ".join(base[1] + [f"p{j}-{i}" for i in range(j)])) for j in range(40)]
    stage = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"]
    got = sorted(r["doc_id"] for r in stage(spark, docs(spark, rows), FOLDER).collect())
    assert got == kept_alone(rows, 5, 80) and not {100, 101, 103} & set(got)
    assert got != kept_alone(rows, 3, 90)


def test_pairs_are_compared_once(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e g")], "doc_id long, text string")
    rows = ngram_join._rows(docs, "doc_id", "text")
    sets = ngram_join._sets(rows, 3)
    reps = sets.groupBy("class").agg(F.min("__key").alias("__key"))
    pairs = reps.agg(F.max("class").alias("a"), F.min("class").alias("b")).withColumn("hub", F.lit(True))
    plans, saved = {}, ngram_join.saved

    def watched(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return saved(df, label)

    monkeypatch.setattr(ngram_join, "saved", watched)
    found = ngram_join._compared(rows, reps, pairs, 3, 50)
    assert [(r["na"], r["nb"], len(r["apart"])) for r in found.collect()] == [(4, 4, 2)]
    assert plans["compared"].count("ArrowEvalPython") == 1
