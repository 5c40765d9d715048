"""Written tables go when their step is done, and the pipeline runs on odd documents."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm.common import concluded, saved, scratch
from plumbline.llm.exact_dedup import exact_dedup
from plumbline.llm.ngram_join import drop_near_copies
from plumbline.plans.storage import release, shared_folder

TEXT = " ".join(f"w{i}" for i in range(60))


def tables(spark):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    return {p.name.rsplit("-", 1)[0] + p.name[-6:] for p in folder.iterdir() if (p / "_SUCCESS").exists()}


def labels_left(before, after):
    return sorted(name[:-6] for name in after - before)


def test_tables_last_as_long_as_the_step_around_them(spark):
    before = tables(spark)
    with scratch():
        kept = concluded("outer", lambda: saved(spark.range(5), "inner").where("id > 1"))
        assert labels_left(before, tables(spark)) == ["outer"] and kept.count() == 3
    assert tables(spark) == before
    with pytest.raises(ZeroDivisionError):
        concluded("failed", lambda: saved(spark.range(5), "inner").limit(1 // 0))
    assert tables(spark) == before
    assert saved(spark.range(5), "free").count() == 5
    assert labels_left(before, tables(spark)) == ["free"]


def test_dedup_leaves_only_what_its_result_reads(spark):
    rows = [(i, f"{TEXT} x{i % 7}", "s") for i in range(40)] + [(50 + i, f"alone {i} " * 9, None) for i in range(20)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for operator, left in ((exact_dedup, ["repeated"]), (drop_near_copies, ["fates"])):
        before = tables(spark)
        out = operator(table)
        assert labels_left(before, tables(spark)) == left
        assert out.count() > 0


def test_best_rows_that_repeat_and_missing_keys(spark):
    rows = [(1, "a b"), (1, "a b"), (2, "ab"), (None, "c  d"), (None, "c  d"), (None, "c d"), (4, "e"), (3, " e"), (5, "e "), (6, None), (6, ""), (7, "f")]
    table = spark.createDataFrame([(*r, at) for at, r in enumerate(rows)], "doc_id long, text string, best int")
    for some in (table, table.repartition(7, "best")):
        kept = [(r["doc_id"], r["text"]) for r in exact_dedup(some).collect()]
        assert sorted(kept, key=str) in [sorted([(1, "a b"), (None, "c  d"), (3, " e"), (6, t), (7, "f")], key=str) for t in (None, "")]


def test_repeats_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr("plumbline.llm.exact_dedup.FILTER_ROWS", 0)
    table = spark.range(600).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.pmod("id", F.lit(250))).alias("text"))
    assert sorted(r["doc_id"] for r in exact_dedup(table).collect()) == list(range(250))


def written(spark, folder, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    toxic = [(i, int(i % 3 == 0)) for i, *_ in rows if i is not None]
    spark.createDataFrame(toxic, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_of_odd_documents(spark, tmp_path):
    rows = [(i, ("vile " if i % 3 == 0 else "kind ") + " ".join(f"u{i}-{j}" for j in range(30)), "ab"[i % 2], "en", 1) for i in range(240)]
    rows += [(1000 + 3 * i + 1, TEXT, "a", None, None) for i in range(30)] + [(None, None, None, None, None), (2000, "", "b", "en", 0), (1, rows[1][1], "b", "en", 1)]
    before = tables(spark)
    packed = corpus_pipeline.run(spark, written(spark, tmp_path / "some", rows)).collect()
    assert labels_left(before, tables(spark)) == ["stage"] * len(corpus_pipeline.STAGES)
    assert len({r["doc_id"] for r in packed if r["doc_id"] is not None and 1000 <= r["doc_id"] < 1100}) <= 1
    clean = {i for i in range(240) if i % 3}
    assert not {r["doc_id"] for r in packed} & {i for i in range(240) if i % 3 == 0}
    assert {r["doc_id"] for r in packed} <= clean | {None, 1001, 2000}
    assert corpus_pipeline.run(spark, written(spark, tmp_path / "none", [])).count() == 0


def held(spark):
    """Bytes of broadcasts and other blocks that the executor holds in memory."""
    most, left = (lambda x: (x._1(), x._2()))(spark.sparkContext._jsc.sc().getExecutorMemoryStatus().head()._2())
    return most - left


def full_collections(spark):
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "Mark" in b.getName())


def test_broadcasts_of_a_concluded_step_are_freed(spark):
    keys = saved(spark.range(400_000), "keys")
    release(spark)
    time.sleep(2)
    before, collected = held(spark), full_collections(spark)
    kept = concluded("step", lambda: saved(keys.join(F.broadcast(keys), "id"), "joined").where("id > 0"))
    assert full_collections(spark) > collected
    for _ in range(40):  # Spark's cleaner frees them a little later
        if held(spark) < before + (2 << 20):
            break
        time.sleep(0.5)
    assert held(spark) < before + (2 << 20) and kept.count() == 399_999
