"""Business key of a counter with sentinels: NULL text compares as '', NULL int as -1.

So NULL and '' are the same counter (not null-safe equality). With ``case_sensitive=False``
(the default, like a case-insensitive collation) the text parts are lower-cased as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierstore.schemas import BUSINESS_KEY, KEY_INTS

KEY_PREFIX = "k_"


def sentinel(col: str, case_sensitive: bool = False) -> Column:
    if col in KEY_INTS:
        return F.coalesce(F.col(col), F.lit(-1))
    c = F.coalesce(F.col(col), F.lit(""))
    return c if case_sensitive else F.lower(c)


def key_columns(case_sensitive: bool = False) -> list[Column]:
    """The seven sentinel key columns, named ``k_<part>``."""
    return [sentinel(c, case_sensitive).alias(KEY_PREFIX + c) for c in BUSINESS_KEY]


KEY_NAMES = [KEY_PREFIX + c for c in BUSINESS_KEY]


def with_key(df: DataFrame, case_sensitive: bool = False) -> DataFrame:
    return df.select("*", *key_columns(case_sensitive))
