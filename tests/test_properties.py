"""Property tests: each hypothesis example is checked as one batch (one Spark job)."""

import datetime as dt
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from faceoff import functions as Fn
from faceoff.sources import delimited as Dl

# Fixed examples (derandomize) keep runs reproducible; PROPERTY_EXAMPLES widens the search.
SETTINGS = settings(
    max_examples=int(os.environ.get("PROPERTY_EXAMPLES", "12")),
    deadline=None,
    derandomize=True,
    suppress_health_check=list(HealthCheck),
)

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("x", T.DoubleType()),
    ]
)

# Text the format can carry: no separator, no line breaks, not the NULL token.
text = st.text(
    alphabet=st.characters(blacklist_characters=",\n\r", blacklist_categories=("Cs",)), max_size=12
).filter(lambda s: s != "\\N")
rows = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)),
        st.one_of(st.none(), text),
        st.one_of(st.none(), st.integers(-(2**31), 2**31 - 1)),
        st.one_of(st.none(), st.floats(allow_nan=False)),
    ),
    min_size=1,
    max_size=40,
)


def _key(row):
    return tuple("" if v is None else repr(v) for v in row)


@SETTINGS
@given(rows=rows)
def test_delimited_roundtrip_is_lossless(spark, tmp_path_factory, rows):
    # a row of all NULLs is written as "\N,\N,..." and must come back as NULLs
    df = spark.createDataFrame(rows, SCHEMA)
    path = str(tmp_path_factory.mktemp("delim") / "out")
    Dl.write_delimited(df, path)
    back = [tuple(r) for r in Dl.read_delimited(spark, path, SCHEMA).collect()]
    assert sorted(back, key=_key) == sorted(rows, key=_key)


WHITESPACE_ZOO = "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\u00a0\u2007\u202f\u2003\u2028\u200b\u3000\u0085"


@SETTINGS
@given(st.lists(st.text(alphabet=st.sampled_from(list("aBcZ9_-") + list(WHITESPACE_ZOO)), max_size=10), min_size=1, max_size=30))
def test_normalize_key_column_equals_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "k string")
    got = [r[0] for r in df.select(Fn.normalize_key("k")).collect()]
    assert got == [Fn.normalize_key_text(v) for v in values]


@SETTINGS
@given(st.lists(st.datetimes(min_value=dt.datetime(1970, 1, 1), max_value=dt.datetime(2100, 1, 1)), min_size=1, max_size=50),
       st.sampled_from(Fn.ZONES))
def test_utc_clock_matches_fixed_offset(spark, instants, zone):
    df = spark.createDataFrame([(t,) for t in instants], "ts timestamp_ntz")
    got = [r[0] for r in df.select(Fn.utc_clock("ts", zone)).collect()]
    k = Fn.ZONE_OFFSETS[zone]
    assert got == [f"{(t.hour - k) % 24}:{t.minute:02d}" for t in instants]
