"""LIKE matching with patterns that come from a column (classification rules).

'%' and '_' are wildcards; backslash is an ordinary character. Spark treats backslash as the
default escape, so matching uses '~' as escape character and a literal '~' in a rule is
doubled first.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ESCAPE = "~"


def escape_rule_pattern(pattern: Column) -> Column:
    return F.replace(pattern, F.lit(ESCAPE), F.lit(ESCAPE + ESCAPE))


def like(value: Column, pattern: Column, case_sensitive: bool = False) -> Column:
    """``value LIKE pattern ESCAPE '~'`` (or ILIKE); ``pattern`` must already be escaped."""
    fn = F.like if case_sensitive else F.ilike
    return fn(value, pattern, F.lit(ESCAPE))


def like_constant(value: Column, pattern: str, case_sensitive: bool = False) -> Column:
    """LIKE against a constant pattern (pushed down where the source can)."""
    escaped = pattern.replace(ESCAPE, ESCAPE + ESCAPE)
    return like(value, F.lit(escaped), case_sensitive)
