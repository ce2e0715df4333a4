"""Property tests (hypothesis): Spark expressions against plain-Python references."""

import bisect
import datetime as dt
import re

from hypothesis import HealthCheck, given, settings, strategies as st

from tierstore.functions.partitioning import partition_number
from pyspark.sql import functions as F

from tierstore.functions.patterns import escape_rule_pattern, like

SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(years=st.lists(st.integers(1995, 2035), min_size=0, max_size=8, unique=True),
       stamps=st.lists(st.datetimes(dt.datetime(1990, 1, 1), dt.datetime(2040, 1, 1)), min_size=1, max_size=20))
def test_partition_number_is_bisect_right(spark, years, stamps):
    bounds = sorted(dt.datetime(y, 1, 1) for y in years)
    df = spark.createDataFrame([(t,) for t in stamps], "ts timestamp_ntz")
    got = [r[0] for r in df.select(partition_number("ts", years)).collect()]
    assert got == [1 + bisect.bisect_right(bounds, t) for t in stamps]


def like_reference(value: str, pattern: str) -> bool:
    """LIKE without escape: % = any run, _ = one character, everything else literal."""
    rx = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern)
    return re.fullmatch(rx, value, flags=re.S) is not None


ALPHABET = st.sampled_from(list("ab%_\\~[ .:$"))


@SETTINGS
@given(pairs=st.lists(st.tuples(st.text(ALPHABET, max_size=6), st.text(ALPHABET, max_size=5)), min_size=1, max_size=30))
def test_like_with_column_patterns_keeps_backslash_and_tilde_literal(spark, pairs):
    df = spark.createDataFrame(pairs, "v string, p string")
    got = df.select("v", "p", like(F.col("v"), escape_rule_pattern(F.col("p")), case_sensitive=True).alias("m")).collect()
    assert all(r["m"] == like_reference(r["v"], r["p"]) for r in got), [
        (r["v"], r["p"], r["m"]) for r in got if r["m"] != like_reference(r["v"], r["p"])]
