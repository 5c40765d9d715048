"""Exact dedup, mixing, URL filter, neighbours and classifiers."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm.exact_dedup import exact_dedup, exact_groups
from plumbline.llm.mixing import mix, mixed_documents, source_targets
from plumbline.llm.neighbours import chi_square_below, nearest
from plumbline.llm.quality import fit_labellers, score_quality
from plumbline.llm.queries import ORACLES, QUERIES
from plumbline.llm.toxicity import drop_toxic, held_out, score_documents
from plumbline.llm.url_filter import filter_urls

from ..oracle import compare, connect

SMALL, FOLDER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, source string, __row string, size string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "r", "s") for i, t, s in rows], DOCS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    compare(spark, connect(), QUERIES[name], ORACLES[name])


def test_equal_texts_of_odd_rows(spark):
    rows = [(1, "a b", "x"), (2, "a  b", "y"), (2, "a  b", "y"), (3, None, None), (4, "", "x"), (5, " \n", "x"), (None, "ab", "x"), (6, "A b", "x")]
    out = exact_groups(docs(spark, rows)).collect()
    assert len(out) == len(rows) and sum(r["kept"] for r in out) == 3
    sizes = {(r["doc_id"], r["keep_id"], r["group_size"]) for r in out}
    assert sizes == {(1, 2, 4), (2, 2, 4), (None, 2, 4), (3, 5, 3), (4, 5, 3), (5, 5, 3), (6, 6, 1)}
    assert {r["text_sha256"] for r in out if r["doc_id"] == 3} == {hashlib.sha256(b"").hexdigest()}
    kept = exact_dedup(docs(spark, rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 5, 6] and set(kept.columns) == set(docs(spark, []).columns)
    assert exact_groups(docs(spark, [])).count() == 0 == exact_dedup(docs(spark, [])).count()


def test_a_hot_text_is_counted_whole(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    out = exact_groups(rows)
    assert out.where("kept").count() == 5000 - 1667 + 1
    assert out.where("keep_id = 0").agg(F.min("group_size"), F.max("group_size"), F.count("*")).first() == (1667, 1667, 1667)


def test_targets_stop_at_twice_the_size(spark):
    sizes = spark.createDataFrame([("b", 10), ("a", 10), (None, 1000), ("c", 100)], "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(sizes).collect()}
    assert got["a"] == 20 and got["b"] == 20 and got["c"] == 200 and got[None] == pytest.approx(1680 - 240)


def test_mix_of_odd_rows(spark):
    rows = [(i, "w " * (i % 7), "s" if i % 3 else None) for i in range(300)] + [(7, "w w", "s"), (7, "w w", "s"), (None, None, "t")]
    out = mix(docs(spark, rows)).collect()
    assert len(out) == len(rows) and all(r["taken"] <= 2 * r["size"] for r in out)
    whole, again = mixed_documents(docs(spark, rows)), mixed_documents(docs(spark, rows).repartition(5))
    assert whole.columns == docs(spark, []).columns
    count = lambda df: sorted(((r["doc_id"], r["count"]) for r in df.groupBy("doc_id").count().collect()), key=str)
    assert count(whole) == count(again)
    words = whole.agg(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0]
    assert words == sum(r["taken"] for r in out)
    for target in {(r["source_size"], r["target"]) for r in out}:
        assert abs(sum(r["taken"] for r in out if (r["source_size"], r["target"]) == target) - target[1]) <= 7
    assert mix(docs(spark, [])).count() == 0


def test_rules_and_odd_urls(spark):
    urls = ["http://A.com/x", "http://example.com/en/1", "http://www.example.com/en/1?q", "http://b.example.com/en/", "http://a.net/fr/1", None, "no scheme", "", "http://xnet/es/", "HTTP://NET/es/#x://y", "http://a.com"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in filter_urls(pages).collect()}
    assert got[0] == ("a.com", "/x", "com/") and got[1][2] == "example.com/en/" and got[2][2] == "www.example.com/en/"
    assert got[3][2] == "example.com/en/" and got[4][2] == "net/fr/" and got[5] == got[6] == got[7] == ("", "", None)
    assert got[8][2] is None and got[9] == ("net", "/es/", "net/es/") and got[10] == ("a.com", "", None)
    assert {r["verdict"] for r in filter_urls(pages).collect()} <= {"allow", "block"}
    assert filter_urls(pages.limit(0)).count() == 0


def test_unruled_urls_are_judged_like_similar_ones(spark):
    rows = [(i, f"http://good{i}.com/en/{i}") for i in range(200)] + [(1000 + i, f"http://bad{i}.net/fr/{i}") for i in range(200)]
    rows += [(5000, "http://good5.org/en/7"), (5001, "http://bad9.org/fr/7")]
    got = {r["page_id"]: r["verdict"] for r in filter_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[5000] == "allow" and got[5001] == "block"


def brute_neighbours(ids, vectors, query, k):
    distance = np.sqrt(((vectors - vectors[query]) ** 2).sum(1))
    distance[query] = np.inf
    best = np.lexsort((ids, distance))[: min(k, len(ids) - 1)]
    return ids[best].tolist(), distance[best].tolist()


def test_neighbours_against_all_pairs(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = table.orderBy("vec_id").collect()
    ids, vectors = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows])
    for block in (16384, 100):
        got = nearest(table, F.col("vec_id") % 100 == 0, block=block, query_block=3).collect()
        hits = 0
        for q in np.flatnonzero(ids % 100 == 0):
            own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == ids[q])
            want, scores = brute_neighbours(ids, vectors, q, 10)
            assert [r[0] for r in own] == list(range(1, 11))
            hits += len({r[1] for r in own} & set(want))
        assert hits >= 0.9 * len(got)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (100, [1.0, 0.0]), (100, [2.0, 0.0])]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, rank string")
    got = nearest(table, F.col("vec_id") % 100 == 0).orderBy("query_id", "score", "rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got if r["query_id"] == 0] == [(1, 0), (2, 0), (100, 0), (100, 1)]
    assert len([r for r in got if r["query_id"] == 100]) == 8
    assert nearest(table.limit(0), F.lit(True)).count() == 0


def test_chi_square():
    assert chi_square_below(np.array([15.507, 2.733]), 8) == pytest.approx([0.95, 0.05], abs=1e-3)


def test_toxicity_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    got = QUERIES["op9_toxicity"](spark, FOLDER).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["toxic"] for r in got) >= 0.95 * len(got)


def test_toxicity_of_odd_rows(spark):
    words = "plain text of no harm at all".split()
    rows = [(i, " ".join(words[i % 7 :]) + (f" vile{i}" if i % 4 == 0 else ""), "s") for i in range(400)]
    rows += [(1000, None, None), (1001, "", None), (None, "vilest", None), (1002, "w " * 50000, None)]
    table = docs(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (3, None), (3, 0)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in score_documents(table, labels).collect()}
    assert len(got) == len(rows) and all(got[i]["predicted"] == (i % 4 == 0) for i in range(400))
    assert got[1000]["score"] == got[1001]["score"] < 0.5 and got[None]["predicted"] == 1
    assert drop_toxic(table, labels).columns == table.columns and drop_toxic(table, labels).count() == len(rows) - 101
    none = score_documents(table, labels.where("toxic = 0")).agg(F.max("score")).first()[0]
    assert none < 0.5 and score_documents(table.limit(0), labels).count() == 0


def test_what_is_held_out(spark):
    import zlib

    rows = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


def test_labellers_get_their_accuracy():
    rng = np.random.default_rng(0)
    good = rng.random(20000) < 0.8
    accuracy = [0.95, 0.9, 0.8]
    votes = np.stack([np.where(rng.random(20000) < a, ~good, good).astype(int) for a in accuracy], 1)
    patterns, counts = np.unique(votes @ [1, 3, 9], return_counts=True)
    posterior, share, rates = fit_labellers(patterns, counts.astype(float), 3)
    assert share == pytest.approx(0.8, abs=0.03) and [rates[j, 0, 0] for j in range(3)] == pytest.approx(accuracy, abs=0.03)


def test_quality_keeps_clean_documents(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    got = QUERIES["op2_quality"](spark, FOLDER).join(labels, "doc_id").collect()
    clean = [r for r in got if r["quality"] == 1]
    assert sum(r["kept"] for r in clean) >= 0.97 * len(clean)
    assert sum(r["kept"] == bool(r["quality"]) for r in got) >= 0.95 * len(got)


def test_quality_of_odd_rows(spark):
    rows = [(1, None, None), (2, "", None), (2, "", None), (None, "a plain line.", None), (4, "w " * 60000, None)]
    got = score_quality(docs(spark, rows)).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert score_quality(docs(spark, []).limit(0)).count() == 0


@pytest.mark.parametrize("missing", [False, True])
def test_mix_of_repeated_and_missing_keys(spark, missing):
    u = lambda key: int(hashlib.md5(f"{key}-0".encode()).hexdigest()[:13], 16) / 2**52
    hot = next(k for k in range(10_000, 20_000) if 0.3 < u(k) < 0.35)
    rows = [(i, "w " * (1 + i % 7), "s") for i in range(400)] + [(hot, "a b c d", "s")] * 300  # the sample of half the words ends among them
    if missing:
        rows = [(1000 + i, "w " * (1 + i % 7), "t") for i in range(200)] + [(None, f"n{i} b c", "t") for i in range(700)]
    table = docs(spark, rows)
    con = connect()
    documents = table.select("doc_id", "text", "source").toArrow()
    con.register("documents_here", documents)
    con.execute("CREATE OR REPLACE TEMP VIEW documents AS SELECT * FROM documents_here")
    want = sorted(con.execute(ORACLES["op8_mixing"].strip()).fetchall(), key=str)
    got = mix(table).collect()
    assert sorted((tuple(r) for r in got), key=str) == want
    for name in {(r["source_size"], r["target"]) for r in got}:
        assert abs(sum(r["taken"] for r in got if (r["source_size"], r["target"]) == name) - name[1]) <= 7
    words = F.regexp_count("text", F.lit(r"\S+"))
    whole, again = (mixed_documents(d).groupBy("doc_id", "text").count() for d in (table, table.repartition(5)))
    assert whole.agg(F.sum(words * F.col("count"))).first()[0] == sum(r["taken"] for r in got)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)


def test_samples_stay_bounded_with_repeated_and_missing_keys(spark, monkeypatch):
    from plumbline.llm import quality, toxicity

    sizes = []

    def counted(fit, place):
        def run(*given):
            sizes.append((len(given[place]), float(given[-1].sum()) if fit is quality.fit_linear else given[place].sum() + given[3].sum()))
            return fit(*given)

        return run

    monkeypatch.setattr(quality, "SAMPLE", 100)
    monkeypatch.setattr(toxicity, "POSITIVES", 50)
    monkeypatch.setattr(toxicity, "UNLABELLED", 100)
    rows = [(i, f"a plain line {i} of some words.", "s") for i in range(1000)] + [(None, f"no key {i} here.", "s") for i in range(1000)]
    monkeypatch.setattr(quality, "fit_linear", counted(quality.fit_linear, 3))
    for more in ([], [(7, "same text again", "s")] * 1000):
        assert score_quality(docs(spark, rows + more)).count() == 2000 + len(more)
    assert all(r <= 160 and 50 <= n <= 160 for r, n in sizes) and len(sizes) == 2
    del sizes[:]
    monkeypatch.setattr(toxicity, "fit_nnpu", counted(toxicity.fit_nnpu, 2))
    ids = spark.range(1000).where(~held_out(F.col("id")) & (F.col("id") % 4 > 0))
    hot = ids.orderBy(F.pmod(F.xxhash64("id", F.lit("u")), F.lit(1 << 30))).first()["id"]
    rows = [(i, f"line {i} words" + (" vile" if i % 4 == 0 else ""), "s") for i in range(1000)] + [(hot, f"other {i} text", "s") for i in range(1000)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(1000)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs(spark, rows + [(hot, "same text again", "s")] * 1000), labels)
    assert len(model.features) and [90 <= n <= 230 for _, n in sizes] == [True]
