"""Sources, selection and quality operators on small and odd tables."""

import json

import pytest
from pyspark.sql import functions as F

from plumbline.functions.columns import nan_to_null
from plumbline.functions.encode import map_values, padded_id, replace_values
from plumbline.operators import features, profile, quality, select, split, tabulate
from plumbline.sources import files, sales, tables

ODD = "Week (first  second） of.month"


@pytest.fixture(scope="module")
def people(spark):
    rows = [
        (1, "f", 1.0, None),
        (2, "m", 3.0, 5.0),
        (3, "f", None, 7.0),
        (4, None, 3.0, 5.0),
        (5, "m", 3.0, 5.0),
    ]
    return spark.createDataFrame(rows, f"id long, g string, `{ODD}` double, y double")


def test_csv_types_missing_values_and_file_order(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id,Order type A,name\n3,1.5,x\n1,,y\n2,NaN,\n")
    df = files.read_csv(spark, str(path), row_key="row")
    assert dict(df.dtypes)["Order type A"] == "double" and dict(df.dtypes)["id"] == "int"
    rows = select.head(df, "row", 2).collect()
    assert [r["id"] for r in rows] == [3, 1]
    assert [r["Order type A"] for r in df.orderBy("row").collect()] == [1.5, None, None]
    assert [r["name"] for r in df.orderBy("row").collect()] == ["x", "y", None]


def test_csv_roundtrip_keeps_rows_and_types(people, tmp_path):
    back = files.csv_roundtrip(people, str(tmp_path / "out"))
    assert back.dtypes == people.dtypes
    assert sorted(back.collect(), key=str) == sorted(people.collect(), key=str)


def test_csv_roundtrip_keeps_text_as_it_is(spark, tmp_path):
    texts = ['plain', ' blanks ', 'say "hi", twice', 'two\nlines', '', None, 'back\\slash', '"']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, s string")
    back = files.csv_roundtrip(df, str(tmp_path / "text"), multi_line=True)
    # an empty text is an empty field, which is missing
    assert [r["s"] for r in back.orderBy("id").collect()] == [t or None for t in texts]


def test_tables_are_replaced(spark, people, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_folder(people, path)
    tables.replace_folder(people.limit(2), path)
    assert spark.read.parquet(path).count() == 2
    made = tables.table_from_rows(spark, [[1, "a"], [2, "b"]], ["n", "s"])
    assert made.columns == ["n", "s"] and made.count() == 2


def test_catalog_table_is_replaced(spark, people, tmp_path):
    spark.sql("DROP TABLE IF EXISTS plumbline_sales")
    df = people.select("id", "g")
    tables.replace_table(df, "plumbline_sales")
    tables.replace_table(df.limit(1), "plumbline_sales")
    assert spark.table("plumbline_sales").count() == 1
    spark.sql("DROP TABLE plumbline_sales")


def test_sales_rows_fill_their_domains_and_repeat(spark):
    df = sales.sales_table(spark, 20_000)
    again = sales.sales_table(spark, 20_000).repartition(7)
    assert df.exceptAll(again).count() == 0
    assert dict(df.dtypes)["is_top"] == "boolean"
    found = {r["column"]: r["n_distinct"] for r in profile.distinct_counts(df).collect()}
    assert (found["shop_code"], found["year_no"], found["week_no"]) == (999, 5, 52)
    assert (found["color_no"], found["color_name"], found["is_top"]) == (99, 99, 2)
    ends = df.agg(F.min("shop_code"), F.max("shop_code"), F.min("year_no"), F.max("year_no"), F.max("color_no")).first()
    assert tuple(ends) == ("SHOP_00001", "SHOP_00999", 2020, 2024, "CLR_099")


def test_padded_id_is_never_cut(spark):
    df = spark.range(1).select(padded_id("P_", F.lit(1234), 3).alias("a"), padded_id("P_", F.lit(7), 3).alias("b"))
    assert tuple(df.first()) == ("P_1234", "P_007")


def test_missing_column_is_an_error(people):
    for call in (
        lambda: select.drop_columns(people, ["nope"]),
        lambda: select.select_columns(people, ["id", "nope"]),
        lambda: quality.midrange_impute(people, "nope"),
    ):
        with pytest.raises(KeyError):
            call()


def test_guards(people):
    assert select.is_usable(people, ["g", ODD]) and not select.is_usable(people, ["y", "nope"])
    constant = people.withColumn("k", F.lit(1)).withColumn("n", F.lit(None).cast("int"))
    assert not select.is_usable(constant, ["k"]) and not select.is_usable(constant, ["n"])


def test_positions_and_order(people):
    assert select.all_but_last(people).columns == people.columns[:-1]
    assert [r["id"] for r in select.tail(people, "id", 2).collect()] == [4, 5]
    assert [r["id"] for r in select.sort_desc(people.select("id", "y"), "y", ["id"], skip=1).collect()] == [2, 4, 5, 1]


def test_filters_leave_missing_out(people):
    assert [r["id"] for r in select.outside(people, ODD, 2, 9).collect()] == [1]
    assert sorted(r["id"] for r in select.within(people, ODD, 2, 9).collect()) == [2, 4, 5]


def test_nan_becomes_null(spark):
    df = nan_to_null(spark.createDataFrame([(float("nan"), 1.0), (2.0, float("nan"))], "a double, b double"))
    assert [tuple(r) for r in df.collect()] == [(None, 1.0), (2.0, None)]


def test_nulls_and_midrange_with_an_odd_name(people):
    found = {r["column"]: r["nulls"] for r in quality.null_counts(people).collect()}
    assert found == {"id": 0, "g": 1, ODD: 1, "y": 1}
    filled = quality.midrange_impute(people, [ODD, "y"]).orderBy("id").collect()
    assert [r[ODD] for r in filled] == [1.0, 3.0, 2.0, 3.0, 3.0]
    assert [r["y"] for r in filled] == [6.0, 5.0, 7.0, 5.0, 5.0]
    assert [r["id"] for r in quality.drop_null_rows(people).orderBy("id").collect()] == [2, 5]


def test_duplicates_treat_missing_as_equal(spark):
    df = spark.createDataFrame([(1, None, 1), (2, None, 1), (3, "a", 1), (4, "a", 1), (5, "a", 2)], "id int, s string, n int")
    marks = {r["id"]: r["is_duplicate"] for r in quality.mark_duplicates(df, "id").collect()}
    assert marks == {1: False, 2: True, 3: False, 4: True, 5: False}
    body = df.select("s", "n")
    assert quality.drop_duplicates(body).count() == 3
    assert quality.duplicate_count(body).first()[0] == 2
    kept = quality.drop_duplicates(df.select("n", "id", "s"), ["s", "n"], key="id")
    assert kept.columns == ["n", "id", "s"] and sorted(r["id"] for r in kept.collect()) == [1, 3, 5]
    report = {r["measure"]: r["value"] for r in quality.quality_report(body).collect()}
    assert report == {"s": 2, "n": 0, "__duplicates__": 2}
    pairs = quality.mark_duplicates(df.select("id", F.col("n").alias("m"), "s", "n"), ["id", "m"])
    assert pairs.where("is_duplicate").count() == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "a double, s string")
    assert tuple(profile.shape(df).first()) == (0, 2)
    assert quality.missing_pct(df).first()["missing_pct"] is None
    assert quality.duplicate_count(df).first()[0] == 0
    assert tuple(profile.describe_numeric(df).first())[1:3] == (0, None)
    assert tuple(profile.describe_text(df).first()) == ("s", 0, 0, None, None)
    assert features.standardize(df).count() == 0
    assert quality.midrange_impute(df, "a").count() == 0
    assert tabulate.value_shares(df, "s").count() == 0


def test_profiles(people):
    assert [(r["column"], r["dtype"]) for r in profile.dtypes(people).collect()][0] == ("id", "bigint")
    assert [r["non_null"] for r in profile.info(people).orderBy("position").collect()] == [5, 4, 4, 4]
    text = profile.describe_text(people).first()
    assert tuple(text) == ("g", 4, 2, "f", 2)
    values = {(r["column"], r["value"]) for r in profile.unique_values(people, exclude=["id", ODD]).collect()}
    assert values == {("g", "f"), ("g", "m"), ("g", None), ("y", None), ("y", "5.0"), ("y", "7.0")}
    assert tuple(profile.column_extremes(people, ["y"]).first()) == ("y", 5.0, 7.0)


def test_encodings(people):
    passed = replace_values(people, "g", {"f": 0}).orderBy("id").collect()
    assert [r["g"] for r in passed] == ["0", "m", "0", None, "m"]
    strict = replace_values(people, "g", {"f": 0, "m": 1}, strict=True)
    assert dict(strict.dtypes)["g"] == "int"
    assert [r["g"] for r in strict.orderBy("id").collect()] == [0, 1, 0, None, 1]
    with pytest.raises(Exception, match="not in the map"):
        replace_values(people, "g", {"f": 0}, strict=True).collect()
    assert [r["g"] for r in map_values(people, "g", {"f": 1}).orderBy("id").collect()] == [1, None, 1, None, None]
    numbers = replace_values(people, ODD, {3.0: 9.0}).orderBy("id").collect()
    assert [r[ODD] for r in numbers] == [1.0, 9.0, None, 9.0, 9.0]


def test_constant_column_scales_to_zero(spark):
    df = spark.range(500).repartition(7).select(F.lit(0.1).alias("a"))
    assert {round(r["a"], 12) for r in features.standardize(df).collect()} == {0.0}


def test_ratio_with_zero_divisor_is_missing(spark):
    df = spark.createDataFrame([(6.0, 2), (6.0, -1)], "p double, a int")
    made = features.add_features(df, {"r": ("ratio", "p", "a", 1)})
    assert [r["r"] for r in made.collect()] == [2.0, None]


def test_missing_feature_is_an_error(people):
    with pytest.raises(Exception):
        features.features_and_label(people, "y", [ODD]).collect()
    good = features.features_and_label(people.where("id in (2, 5)"), "y", [ODD], keep=["id"])
    assert good.columns == ["id", "features", "label"] and good.count() == 2


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_splits_do_not_depend_on_partitions(spark, partitions):
    df = spark.range(2_000).repartition(partitions)
    train, test = split.train_test_split(df, "id")
    ids = {r["id"] for r in test.collect()}
    assert ids == {r["id"] for r in split.train_test_split(spark.range(2_000), "id")[1].collect()}
    assert train.count() + len(ids) == 2_000 and train.join(test, "id").count() == 0
    assert 330 < len(ids) < 470
    train, test = split.train_test_split(df, "id", 0.2013, exact=True)
    assert (train.count(), test.count()) == (1_597, 403)
    folds = {r["fold"]: r["count"] for r in split.add_folds(df, "id").groupBy("fold").count().collect()}
    assert set(folds) == {0, 1, 2, 3, 4} and all(330 < n < 470 for n in folds.values())


@pytest.mark.parametrize("limit", [1_000_000, 25])
def test_stratified_folds_are_even(spark, limit):
    label = F.when(F.col("id") < 3, None).otherwise((F.col("id") % 10 == 0).cast("int"))
    df = spark.range(203).withColumn("y", label)
    found = split.add_stratified_folds(df, "id", "y", rows_per_task=limit)
    assert found.columns == ["id", "y", "fold"]
    sizes = found.groupBy("y", "fold").count().collect()
    assert sum(r["count"] for r in sizes) == 203
    for y in (0, 1, None):
        counts = [r["count"] for r in sizes if r["y"] == y]
        assert len(counts) == (3 if y is None else 5) and max(counts) - min(counts) <= 1


def test_attach_keeps_every_target_row(spark):
    sheet = spark.createDataFrame([(1, 0.0), (2, 0.0)], "id int, Response double")
    scores = spark.createDataFrame([(2, 0.7), (9, 0.1)], "id int, prediction double")
    out = {r["id"]: r["Response"] for r in select.attach_predictions(sheet, scores, "id", "Response").collect()}
    assert out == {1: None, 2: 0.7}


def test_crosstabs(people):
    counts = tabulate.crosstab(people, "g", "y").orderBy("g").collect()
    assert [tuple(r) for r in counts] == [("f", 0, 1), ("m", 2, 0)]
    rows = tabulate.crosstab(people, "g", "y", normalize="index").collect()
    assert all(abs(sum(tuple(r)[1:]) - 1) < 1e-12 for r in rows)
    shares = tabulate.crosstab(people, "g", "y", normalize="columns").collect()
    assert sum(r["5.0"] for r in shares) == 1 and sum(r["7.0"] for r in shares) == 1
    medians = tabulate.crosstab_median(people, "g", ODD).orderBy("g").collect()
    assert [tuple(r) for r in medians] == [("f", 1.0), ("m", 3.0)]
    with pytest.raises(ValueError, match="long form"):
        tabulate.levels(people, "id", max_levels=2)


def test_bootstrap_interval_holds_the_mean(spark):
    df = spark.range(3_000).selectExpr("id", "id % 3 g", "cast(id % 101 as double) v")
    for r in tabulate.group_mean_bootstrap(df, "g", "v", "id", replicates=100).collect():
        assert r["low"] < r["mean"] < r["high"] and r["high"] - r["low"] < 6
    normal = {r["g"]: r for r in tabulate.group_mean_ci(df, "g", "v").collect()}
    for r in tabulate.group_mean_bootstrap(df, "g", "v", "id", replicates=400).collect():
        assert r["low"] == pytest.approx(normal[r["g"]]["low"], abs=0.5)
        assert r["high"] == pytest.approx(normal[r["g"]]["high"], abs=0.5)


def test_row_key_of_a_whole_row_is_stable(people):
    keyed = people.withColumn("k", F.md5(F.to_json(F.struct("*"))))
    assert json.loads(people.select(F.to_json(F.struct("*"))).first()[0])["id"] == 1
    assert keyed.select("k").distinct().count() == 5
