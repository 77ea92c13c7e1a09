"""Scalar operators on literal edge cases (FIXTURES.md section 6)."""

import datetime as dt

from pyspark.sql import functions as F

from postlake.functions import (
    clean_location,
    clean_text,
    is_blank,
    label_id,
    label_name,
    model_text,
    parse_hashtags,
    parse_s3_uri,
    parse_ts,
    run_key,
    run_path,
    softmax,
    split_s3_uri,
    to_bool,
    to_long,
    truncate_tokens,
)


def col_values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_timestamp_strict(one_col):
    good = ["18-08-2020 12:55"]
    bad = ["2020-08-18 12:55:00", "1-8-2020 5:07", "18-08-2020 12:55:30", "31-02-2020 10:00", "", " 18-08-2020 12:55", "18-08-2020", None]
    df = one_col(good + bad)
    out = col_values(df, parse_ts("x").cast("timestamp_ntz"))
    assert out[0] == dt.datetime(2020, 8, 18, 12, 55)
    assert out[1:] == [None] * len(bad)


def test_long_legacy_cast(one_col):
    cases = {
        "405": 405, "834.0": 834, "12.9": 12, "12.9999999": 12, "-0.5": 0, ".5": 0, "5.": 5, "+5": 5, " 7 ": 7,
        "1e3": None, "abc": None, "": None, "-": None, "1.2.3": None, "5L": None, "9223372036854775808": None,
        "-12.5": -12, "\t8\n": 8, None: None,
    }
    df = one_col(list(cases))
    assert col_values(df, to_long("x")) == list(cases.values())


def test_boolean_words(one_col):
    cases = {"True": True, "Y": True, "1": True, "yes": True, "NO": False, "0": False, "f": False,
             " yes": None, "maybe": None, "1.0": None, None: None}
    df = one_col(list(cases))
    assert col_values(df, to_bool("x")) == list(cases.values())


def test_hashtags(one_col):
    cases = [
        ("['A','B ']", ["a", "b"]),
        ("[]", []),
        ("", []),
        (None, []),
        ("[\"It's\", 'x']", ['"its"', "x"]),
        ("['A','a']", ["a", "a"]),
    ]
    df = one_col([c for c, _ in cases])
    assert col_values(df, parse_hashtags("x")) == [e for _, e in cases]


def test_clean_text_order_and_case(one_col):
    cases = {
        "RT @bob:  Hello   https://t.co/x  World": "rt : hello world",
        "HTTP://X.COM is kept": "http://x.com is kept",
        "mail a@b.com now": "mail a .com now",
        "see www.example.com/a, ok": "see ok",
        "@only https://t.co/1": "",
        "café @usér": "café ér",
        None: None,
    }
    df = one_col(list(cases))
    assert col_values(df, clean_text("x")) == list(cases.values())
    nbsp = one_col(["a  b"])
    assert col_values(nbsp, clean_text("x")) == ["a  b"]


def test_location(one_col):
    df = one_col(["  EN   Region 3 ", None])
    assert col_values(df, clean_location("x")) == ["en region 3", None]


def test_blank_and_model_text(one_col):
    df = one_col([" x ", "  ", "", None, "\u0085a　"])
    assert col_values(df, is_blank("x")) == [False, True, True, True, False]
    assert col_values(df, model_text("x")) == ["x", "", "", "", "a"]


def test_truncate_tokens(one_col):
    df = one_col(["a b  c d", "one"])
    assert col_values(df, truncate_tokens("x", 2)) == ["a b", "one"]


def test_labels(spark):
    df = spark.createDataFrame([("negative",), ("neutral",), ("positive",), ("Positive",), (None,)], "s string")
    assert col_values(df, label_id("s")) == [0, 1, 2, None, None]
    ids = spark.createDataFrame([(0,), (2,), (7,)], "i int")
    assert col_values(ids, label_name("i")) == ["negative", "positive", None]


def test_softmax_argmax(spark):
    from postlake.functions import argmax, confidence

    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([5.0, 5.0, 1.0],), ([1000.0, 0.0, -1000.0],)], "l array<double>")
    rows = df.select(softmax("l").alias("p")).select("p", argmax("p").alias("a"), confidence("p").alias("c")).collect()
    for r in rows:
        assert abs(sum(r.p) - 1.0) < 1e-12
    assert [r.a for r in rows] == [2, 0, 0]
    assert rows[2].c == 1.0


def test_s3_uri(one_col):
    df = one_col(["s3://bucket/raw/a.csv", "s3://bucket", "s3://b/", "http://x/y"])
    out = [tuple(r) if r else None for r in col_values(df, split_s3_uri("x"))]
    assert out == [("bucket", "raw/a.csv"), ("bucket", ""), ("b", ""), None]
    assert parse_s3_uri("s3://b/k/x") == ("b", "k/x")
    import pytest

    with pytest.raises(ValueError):
        parse_s3_uri("http://x")


def test_run_key(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 1, 2, 3, 4, 5),)], "t timestamp_ntz")
    assert col_values(df, run_key("t")) == ["covid_data/20210102030405/data.json"]
    assert run_path(when=dt.datetime(2020, 5, 6, 7, 8, 9)) == "covid_data/20200506070809/data.json"
