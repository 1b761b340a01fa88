"""CSV / XML / Parquet sources and sinks on small files written by the tests."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.sources import readers


def test_csv_all_strings_and_typed(spark, tmp_path):
    # SRC-6, SRC-7, FIL-9, FN-5
    p = tmp_path / "trip.csv"
    p.write_text("id,bike_id,duration\n1,535,60\n2,535,x\n3,7,\n")
    raw = readers.read_csv(spark, str(p))
    assert all(t == "string" for _, t in raw.dtypes)
    # dirty number: null through try_cast, error through cast (ANSI)
    vals = [r.d for r in raw.select(F.expr("try_cast(duration AS BIGINT)").alias("d")).collect()]
    assert vals == [60, None, None]
    with pytest.raises(Exception):
        raw.select(F.col("duration").cast("bigint")).collect()
    typed = readers.read_csv(spark, str(p), "id long, bike_id long, duration string",
                             drop_nulls=True)
    assert typed.count() == 2


def test_xml_rows_with_explicit_schema(spark, tmp_path):
    # SRC-8
    p = tmp_path / "posts.xml"
    p.write_text('<posts>\n'
                 '<row Id="1" CreationDate="2010-05-01T10:00:00.000" Tags="&lt;java&gt;&lt;c#&gt;"/>\n'
                 '<row Id="2" CreationDate="2020-12-31T00:00:00.000" Tags="&lt;python&gt;"/>\n'
                 '<row Id="3" CreationDate="2021-01-01T00:00:00.000"/>\n'
                 '</posts>\n')
    schema = T.StructType([T.StructField("_Id", T.LongType()),
                           T.StructField("_CreationDate", T.TimestampType()),
                           T.StructField("_Tags", T.StringType())])
    df = readers.read_xml_rows(spark, str(p), schema)
    rows = sorted(df.collect(), key=lambda r: r._Id)
    assert [r._Tags for r in rows] == ["<java><c#>", "<python>", None]
    assert rows[1]._CreationDate.year == 2020
    assert dict(df.dtypes)["_CreationDate"] == "timestamp"


def test_lines_and_coo_readers(spark):
    # SRC-3, SRC-4, SRC-5
    d = spark.createDataFrame([(7, "a b\n\nc")], "doc_id long, text string")
    lines = readers.document_lines(d).collect()
    assert [(r.key, r.line) for r in lines] == [("7:0", "a b"), ("7:1", ""), ("7:2", "c")]
    m = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "r long, arr array<double>")
    coo = sorted(map(tuple, readers.coo_from_arrays(m, "r", "arr").collect()))
    assert coo == [(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 4.0)]


def test_parquet_sink_and_profile(spark, tmp_path):
    # SNK-1, SNK-5
    d = spark.createDataFrame([(1, 2.5), (2, None), (3, 0.5)], "a long, b double")
    out = str(tmp_path / "out")
    readers.write_parquet(d, out)
    readers.write_parquet(d, out)   # overwrite
    back = spark.read.parquet(out)
    assert back.count() == 3
    prof = {r.column_name: r for r in readers.profile(back).collect()}
    assert (prof["a"]["count"], prof["a"]["min"], prof["a"]["max"]) == (3, 1.0, 3.0)
    assert (prof["b"]["count"], prof["b"]["min"], prof["b"]["max"]) == (2, 0.5, 2.5)


def test_malformed_csv_rows_are_kept_and_counted(spark, tmp_path):
    # SRC-6, SRC-7
    p = tmp_path / "trip.csv"
    p.write_text('id,bike_id,note\n1,535,"a, ""b"""\nx,7,bad id\n3,8,c,one too many\n4,,""\n5\n')
    df = readers.read_csv(spark, str(p), "id long, bike_id long, note string", corrupt="_bad")
    good, bad, n_good, n_bad = readers.split_malformed(df, "_bad")
    assert [tuple(r) for r in good.orderBy("id").collect()] == [(1, 535, 'a, "b"'), (4, None, None)]
    assert {r._bad for r in bad.collect()} == {"x,7,bad id", "3,8,c,one too many", "5"} and (n_good, n_bad) == (2, 3)
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(p), corrupt="_bad")


def test_malformed_xml_rows_are_kept_and_counted(spark, tmp_path):
    # SRC-8
    p = tmp_path / "posts.xml"
    p.write_text('<posts>\n<row Id="1" Tags="&lt;a&gt;"/>\n<row Id="one" Tags="b"/>\n<row Tags="c"/>\n</posts>\n')
    good, bad, n_good, n_bad = readers.split_malformed(readers.read_xml_rows(spark, str(p), "_Id long, _Tags string", corrupt="_bad"), "_bad")
    assert sorted((r._Id or 0, r._Tags) for r in good.collect()) == [(0, "c"), (1, "<a>")]
    assert (n_good, n_bad) == (2, 1) and '"_Id":"one"' in bad.first()._bad


def test_csv_and_xml_writers_give_back_odd_texts(spark, tmp_path):
    rows = [(1, 'say "hi", you', 0.1 + 0.2), (2, "", None), (3, None, 1e-300), (4, "<&>'é", -0.0), (5, " edge ", 5e300)]
    df = spark.createDataFrame(rows, "id long, text string, v double")
    readers.write_csv(df, str(tmp_path / "csv"))
    assert sorted(map(tuple, readers.read_csv(spark, str(tmp_path / "csv"), df.schema, null_text="\\N").collect())) == rows
    readers.write_csv(spark.createDataFrame([(1, "two\nlines")], "id long, text string"), str(tmp_path / "lines"))
    assert readers.read_csv(spark, str(tmp_path / "lines"), "id long, text string", multi_line=True).first().text == "two\nlines"
    readers.write_xml_rows(df.where("id <> 5"), str(tmp_path / "xml"))
    back = readers.read_xml_rows(spark, str(tmp_path / "xml"), "_id long, _text string, _v double").collect()
    assert sorted((r._id, r._text, r._v) for r in back) == rows[:4]


def test_user_table_functions(spark):
    # UDF-5
    from quern.functions.udf import flat_map
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (1, "a b")], "id long, text string")

    def pieces(i, t):
        for k, w in enumerate(t.split() if t else []):
            yield w, k * i
    out = flat_map(df, pieces, ["id", "text"], "word string, id long", keep=["id"])
    assert out.columns == ["id", "word", "id"]
    assert sorted(map(tuple, out.collect())) == [(1, "a", 0), (1, "a", 0), (1, "b", 1), (1, "b", 1)]
