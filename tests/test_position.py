"""File order over several files and blocks."""

import pytest

from plumbline.operators.position import attach_by_position, head_in_file, keep_first_in_file, tail_in_file, with_position


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("rows") / "t"
    path.mkdir()
    for number in range(4):
        lines = [f"{(number * 500 + i) * 7919 % 2000},{i % 3}" for i in range(500)]
        (path / f"part-{number}.csv").write_text("\n".join(lines) + "\n")
    return str(path)


def read(spark, folder):
    return spark.read.schema("v long, g long").csv(folder)


@pytest.fixture(params=["134217728", "700"])
def split_bytes(spark, request):
    """Files read whole, and in many blocks."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    yield request.param
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_positions_follow_the_files(spark, folder, split_bytes):
    rows = with_position(read(spark, folder)).collect()
    assert sorted(r["position"] for r in rows) == list(range(2000))
    assert all(r["v"] == r["position"] * 7919 % 2000 for r in rows)


def test_head_tail_and_first_of_duplicates(spark, folder, split_bytes):
    table = read(spark, folder)
    assert sorted(r["position"] for r in head_in_file(table, 3).collect()) == [0, 1, 2]
    assert sorted(r["position"] for r in tail_in_file(table, 3).collect()) == [1997, 1998, 1999]
    first = {r["g"]: r["v"] for r in keep_first_in_file(table, ["g"]).collect()}
    assert first == {g: g * 7919 % 2000 for g in range(3)}


def test_attach_and_lengths(spark, folder, split_bytes):
    table = read(spark, folder)
    got = attach_by_position(table, table.selectExpr("v + 1 AS w"), "w", "g").collect()
    assert len(got) == 2000 and all(r["g"] == r["v"] + 1 for r in got)
    with pytest.raises(ValueError):
        attach_by_position(table, table.where("g = 0"), "v", "g")


def test_empty_table(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    assert with_position(spark.read.schema("v long").csv(str(tmp_path))).collect() == []
