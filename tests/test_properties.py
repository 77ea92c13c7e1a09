"""Property tests: Spark expressions against small Python models."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from postlake.functions import clean_text, is_blank, model_text, parse_hashtags, to_long

SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        　"
ALPHABET = st.sampled_from(list(SPACES) + list("aZ9_.@,:/'[]\"-+") + ["é", "ß", "ww", "http://", "https://", "www.", "e"])
TEXTS = st.lists(st.lists(ALPHABET, max_size=30).map("".join), min_size=20, max_size=60)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def spark_values(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[1] for r in df.select("i", expr).orderBy("i").collect()]


@SETTINGS
@given(TEXTS)
def test_strip_and_blank_equal_python(spark, values):
    assert spark_values(spark, values, model_text("x")) == [v.strip() for v in values]
    assert spark_values(spark, values, is_blank("x")) == [v.strip() == "" for v in values]


def legacy_long(s):
    """Model of the non-ANSI string -> long cast (whitespace/control trimmed,
    decimals truncated, anything else null, 64-bit range)."""
    t = s.strip("".join(chr(c) for c in range(0x21)) + "\x7f")
    m = re.fullmatch(r"([+-]?)([0-9]*)(?:\.([0-9]*))?", t)
    if not t or not m or (not m.group(2) and t.find(".") < 0):
        return None
    if m.group(2) == "" and "." not in t:
        return None
    v = int(m.group(2) or "0")
    v = -v if m.group(1) == "-" else v
    return v if -(2**63) <= v < 2**63 else None


NUMS = st.lists(
    st.one_of(
        st.integers(-(2**64), 2**64).map(str),
        st.floats(allow_nan=False, allow_infinity=False).map(repr),
        st.lists(st.sampled_from(list("0123456789.+- e\t")), max_size=8).map("".join),
    ),
    min_size=20,
    max_size=60,
)


@SETTINGS
@given(NUMS)
def test_long_cast_matches_legacy_model(spark, values):
    assert spark_values(spark, values, to_long("x")) == [legacy_long(v) for v in values]


def py_clean(s):
    s = re.sub(r"https?://\S+|www\.\S+", " ", s, flags=re.ASCII)
    s = re.sub(r"@\w+", " ", s, flags=re.ASCII)
    s = re.sub(r"[ \t\n\x0b\f\r]+", " ", s)
    return s.strip(" ").lower()


@SETTINGS
@given(TEXTS)
def test_clean_text_matches_ascii_regex_model(spark, values):
    assert spark_values(spark, values, clean_text("x")) == [py_clean(v) for v in values]


def py_hashtags(s):
    s = re.sub(r"[\[\]']", "", s or "")
    parts = re.split(r"[ \t\n\x0b\f\r]*,[ \t\n\x0b\f\r]*", s)
    return [p.strip(" ").lower() for p in parts if p.strip(" ").lower() != ""]


@SETTINGS
@given(TEXTS)
def test_hashtags_match_model(spark, values):
    assert spark_values(spark, values, parse_hashtags("x")) == [py_hashtags(v) for v in values]
