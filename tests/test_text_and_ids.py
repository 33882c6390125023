import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkmill.functions import text
from inkmill.functions.ids import record_id, unit_hash


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("t"))).collect()]


def python_clean(t):
    return "\n".join(x for x in (line.strip() for line in (t or "").strip().splitlines()) if x)


CASES = [None, "", "  ", "a", " a \r\n\n b ", "x\x1cy", "p q", " nb ", "a\x0bb\x0cc\x85d", "　wide　\n\n em"]


def test_clean_text_follows_python(spark):
    assert column(spark, CASES, text.clean_text) == [python_clean(t) for t in CASES]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \t\n\r\x1c\x85  .", max_size=12), min_size=1, max_size=20))
def test_clean_text_property(spark, values):
    assert column(spark, values, text.clean_text) == [python_clean(t) for t in values]


def test_token_count(spark):
    assert column(spark, [None, "", "one two", "12345", "don't!"], text.token_count) == [0, 0, 2, 2, 4]


def test_truncate_prompt(spark):
    long, solid = "word " * 60, "x" * 300
    got = column(spark, ["short", long, solid, None], text.truncate_prompt)
    assert got == ["short", long[:256][: long[:256].rindex(" ")] + "...", solid[:256] + "...", None]


def test_head(spark):
    got = column(spark, ["w " * 2000, "few"], lambda c: text.head(c, text.token_count(c)))
    assert [len(x) for x in got] == [2048, 3]


def test_pieces_are_the_text(spark):
    values = ["A b. C d!  E\nF", "no end", "", "Dr. X said. \"Yes.\" Then"]
    assert column(spark, values, lambda c: F.array_join(text.pieces(c), "")) == values


@pytest.mark.parametrize(
    ("name", "sid", "content", "seg", "key"),
    [("n", "1", None, None, "n:1"), ("n", "", "t", None, "n:contenthash:" + hashlib.sha256(b"t").hexdigest()[:16]), ("n", None, "t", 3, None), ("n", None, None, None, "none"), ("n", "1", "t", 0, "n:1:seg:0")],
)
def test_record_id(spark, name, sid, content, seg, key):
    df = spark.createDataFrame([(name, sid, content, seg)], "n string, s string, c string, k int")
    got = df.select(record_id(F.col("n"), F.col("s"), F.col("c"), F.col("k"))).first()[0]
    if key == "none":
        assert got is None
    else:
        key = key or "n:contenthash:" + hashlib.sha256(b"t").hexdigest()[:16] + ":seg:3"
        assert got == "sha256:" + hashlib.sha256(key.encode()).hexdigest()


def test_unit_hash(spark):
    got = column(spark, ["a", "b"], unit_hash)
    assert got == [int(hashlib.sha256(x.encode()).hexdigest()[:8], 16) / 2**32 for x in "ab"]
