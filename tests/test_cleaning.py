import datetime
import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapfold.functions import lenient_date, null_tokens, safe_double, safe_int, strip_modifier
from snapfold.plans.ingest import clean_and_cast
from snapfold.schema import SNAPSHOT_CASTS, CastSpec

# Text, its integer, its double.
NUMBERS = [
    ("1", 1, 1.0), ("NULL", None, None), ("", None, None), (" ", None, None), ("NaN", None, None),
    ("nan", None, math.nan), ("N/A", None, None), ("12.0", 12, 12.0), ("12.9", 12, 12.9), ("-3.7", -3, -3.7),
    ("12.", 12, 12.0), (".", 0, None), (".5", 0, 0.5), ("-.5", 0, -0.5), (" 7 ", 7, 7.0), (" 8.5 ", 8, 8.5),
    ("+5", 5, 5.0), ("1e3", None, 1000.0), ("12d", None, 12.0), ("0x10", None, None), ("1.x", None, None),
    ("Infinity", None, math.inf), ("2147483648", None, 2147483648.0), ("99999999999.5", None, 99999999999.5),
    (None, None, None), ("\t12.5\n", 12, 12.5), ("-2147483648", -2147483648, -2147483648.0), ("+-5", None, None),
]


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


def test_safe_int(spark):
    assert column(spark, [n[0] for n in NUMBERS], safe_int("v")) == [n[1] for n in NUMBERS]


def test_safe_double(spark):
    found = column(spark, [n[0] for n in NUMBERS], safe_double("v"))
    for (text, _, wanted), value in zip(NUMBERS, found, strict=True):
        same = value == wanted or (wanted is not None and math.isnan(wanted) and math.isnan(value))
        assert same, (text, wanted, value)


def test_safe_casts_of_typed_columns(spark):
    assert column(spark, [3, None], safe_int("v"), "int") == [3, None]
    assert column(spark, [3.5, None], safe_double("v"), "double") == [3.5, None]


def test_null_tokens_match_exactly(spark):
    assert column(spark, ["NULL", "null", "", "  ", "x", None], null_tokens("v")) == [None, "null", None, "  ", "x", None]
    assert column(spark, ["?", "NULL"], null_tokens("v", ["?"])) == [None, "NULL"]


def test_tokens_that_are_numbers(spark):
    assert column(spark, ["-1", "0.0", "7", ".5"], safe_int("v", ["-1", ".5"])) == [None, 0, 7, None]
    assert column(spark, ["-1", "0.0", "7", "NaN"], safe_double("v", ["-1", "NaN"])) == [None, 0.0, 7.0, None]


def test_lenient_date(spark):
    day = datetime.date
    values = ["1987-06-24", "2018-07-01 00:00:00", "24/06/1987", "bad", "", None]
    assert column(spark, values, lenient_date("v")) == [day(1987, 6, 24), day(2018, 7, 1), None, None, None, None]


def test_strip_modifier(spark):
    values = ["89+3", "62-1", "70", "", "x+1", "-4", "+5", None, "5-LOW"]
    assert column(spark, values, strip_modifier("v")) == [89.0, 62.0, 70.0, None, None, None, None, None, 5.0]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("0123456789+-. eENx", max_size=8), min_size=50, max_size=200))
def test_casts_against_models(spark, texts):
    def as_int(text):
        plain = re.fullmatch(r"\s*([+-]?)(\d*)(\.\d*)?\s*", text)
        if text in ("", " ") or not plain or (not plain[2] and not plain[3]):
            return None
        value = int((plain[1] or "") + (plain[2] or "0"))
        return value if -(2**31) <= value < 2**31 else None

    assert column(spark, texts, safe_int("v")) == [as_int(t) for t in texts]
    by_regex = F.regexp_replace("v", "([+-].*)$", "").try_cast("double")
    assert column(spark, texts, strip_modifier("v")) == column(spark, texts, by_regex)


def test_clean_and_cast_is_one_projection(spark):
    raw = spark.createDataFrame([("1", "NULL", "bad", 7)], "a string, b string, c string, d int")
    out = clean_and_cast(raw, CastSpec(["a"], ["b"], ["c"], ["d"]))
    assert out.dtypes == [("a", "double"), ("b", "int"), ("c", "date"), ("d", "string")]
    assert out.first() == (1.0, None, None, "7")


def test_missing_columns(spark):
    raw = spark.createDataFrame([("1",)], "a string")
    with pytest.raises(ValueError, match="missing"):
        clean_and_cast(raw, CastSpec(["a"], ["b"]))
    out = clean_and_cast(raw, CastSpec(["a"], ["b"]), add_missing=True)
    assert out.dtypes == [("a", "double"), ("b", "int")]


def test_snapshot_casts_cover_the_typed_columns():
    assert len(SNAPSHOT_CASTS.columns()) == len(set(SNAPSHOT_CASTS.columns())) == 83
