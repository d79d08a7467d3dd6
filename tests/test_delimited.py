from pathlib import Path

from pyspark.sql import types as T

from faceoff.sources import delimited as Dl

SCHEMA = T.StructType(
    [T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("x", T.DoubleType())]
)


def test_hive_text_edge_lines(spark, tmp):
    lines = ["1,a,1.5", "3.9,c,3", "4,,", "5,\\N,\\N", "6,short", "7,x,1,extra", "bad,y,z", "", '8,"q,2', " 2 ,b,2"]
    path = Path(tmp) / "in.txt"
    path.write_text("\n".join(lines) + "\n")
    got = [tuple(r) for r in Dl.read_delimited(spark, str(path), SCHEMA).collect()]
    assert got == [
        (1, "a", 1.5),
        (3, "c", 3.0),  # an int written with a fraction keeps its integer part
        (4, "", None),  # empty string stays '', empty number is NULL
        (5, None, None),  # \N is NULL
        (6, "short", None),  # short row: trailing NULL
        (7, "x", 1.0),  # extra field dropped
        (None, "y", None),  # malformed numbers are NULL
        (None, None, None),  # blank line: a row of NULLs
        (8, '"q', 2.0),  # quotes are literal, no quoting
        (None, "b", 2.0),  # padded int is NULL (as Hive), double tolerates spaces
    ]


def test_roundtrip_keeps_nulls_and_types(spark, tmp):
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, None), (None, "", 1e300)], SCHEMA)
    out = str(Path(tmp) / "out")
    Dl.write_delimited(df, out)
    back = Dl.read_delimited(spark, out, SCHEMA)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_sink_refuses_separator(spark, tmp):
    import pytest

    df = spark.createDataFrame([(1, "a,b", 1.0)], SCHEMA)
    with pytest.raises(Exception, match="separator"):
        Dl.write_delimited(df, str(Path(tmp) / "bad"))


def test_other_separator(spark, tmp):
    df = spark.createDataFrame([(1, "a|b", 1.0)], SCHEMA)
    line = Dl.to_delimited_line(df, sep=";").first()[0]
    assert line == "1;a|b;1.0"
    lines = spark.createDataFrame([("1|x|2.0",)], "value string")
    assert tuple(Dl.parse_delimited(lines, SCHEMA, sep="|").first()) == (1, "x", 2.0)


def test_sink_refuses_what_would_read_back_otherwise(spark, tmp):
    import pytest

    for k, value in enumerate(["a\nb", "a\rb", "\\N"]):
        with pytest.raises(Exception, match="cannot carry"):
            Dl.write_delimited(spark.createDataFrame([(1, value, 1.0)], SCHEMA), f"{tmp}/bad{k}")
    with pytest.raises(Exception, match="cannot carry"):
        Dl.write_delimited(spark.createDataFrame([("",)], "name string"), f"{tmp}/blank")
