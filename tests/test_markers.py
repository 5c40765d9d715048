"""Types of CSV columns whose fields may be missing markers."""

from plumbline.sources.files import MARKERS, narrowest_types, read_csv


def test_markers_do_not_widen_a_column(spark, tmp_path):
    rows = ["i,b,d,t,f,none,mixed", "1,9000000000,1.5,x,true,NA,1", "NA,n/a,NaN,NULL,false,,2x", " 3 ,-4,2e3,y,null,nan,", "null,5,,None,TRUE,N/A,7"]
    (tmp_path / "t.csv").write_text("\n".join(rows) + "\n")
    df = read_csv(spark, str(tmp_path / "t.csv"), missing=MARKERS)
    assert dict(df.dtypes) == {"i": "int", "b": "bigint", "d": "double", "t": "string", "f": "boolean", "none": "string", "mixed": "string"}
    got = [tuple(r) for r in df.collect()]
    assert got == [
        (1, 9_000_000_000, 1.5, "x", True, None, "1"), (None, None, None, None, False, None, "2x"),
        (3, -4, 2000.0, "y", None, None, None), (None, 5, None, None, True, None, "7"),
    ]
    plain = read_csv(spark, str(tmp_path / "t.csv"))
    assert dict(plain.dtypes)["i"] == "string"


def test_markers_with_a_schema_and_a_row_key(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,NA\nNA,2.5\nword,3\n")
    df = read_csv(spark, str(tmp_path / "t.csv"), schema="a int, b double", row_key="place", missing=["NA"])
    assert [(r["a"], r["b"]) for r in df.orderBy("place").collect()] == [(1, None), (None, 2.5), (None, 3.0)]


def test_empty_table_stays_text(spark):
    assert narrowest_types(spark.createDataFrame([], "a string, b string")) == {"a": "string", "b": "string"}
