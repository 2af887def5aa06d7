"""How alike two texts are."""

from __future__ import annotations

import difflib
from collections import Counter

import pandas as pd
from pyspark.sql import Column, functions as F

#: Longer texts are compared by their characters' counts alone.
LONG = 50_000


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def sequence_ratio(a: Column | str, b: Column | str) -> Column:
    """difflib's ratio of matching blocks, in the order given: it depends on it, and on its junk heuristic."""

    @F.pandas_udf("double")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(left, right)])

    return run(a, b)


def quick_ratio(a: Column | str, b: Column | str) -> Column:
    """2 * shared characters (as multisets) / characters of both; 1.0 for two empty texts."""

    @F.pandas_udf("double")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right):
            if x is None or y is None:
                out.append(None)
                continue
            total = len(x) + len(y)
            out.append(2.0 * (Counter(x) & Counter(y)).total() / total if total else 1.0)
        return pd.Series(out, dtype="float64")

    return run(_col(a), _col(b))


def text_ratio(a: Column | str, b: Column | str) -> Column:
    """sequence_ratio(), or quick_ratio() where either side is long: one pass of a UDF that branches inside."""

    @F.pandas_udf("double")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right):
            if x is None or y is None:
                out.append(None)
                continue
            m = difflib.SequenceMatcher(None, x, y)
            out.append(m.quick_ratio() if len(x) > LONG or len(y) > LONG else m.ratio())
        return pd.Series(out)

    return run(a, b)


def guarded_ratio(a: Column | str, b: Column | str, ratio=sequence_ratio) -> Column:
    """1.0 if both are empty, 0.0 if one is, else the ratio."""
    a, b = (F.coalesce(_col(x), F.lit("")) for x in (a, b))
    return F.when((a == "") & (b == ""), 1.0).when((a == "") | (b == ""), 0.0).otherwise(ratio(a, b))


def line_jaccard(a: Column | str, b: Column | str) -> Column:
    """Shared distinct lines over all distinct lines."""
    x, y = F.split(_col(a), "\n", -1), F.split(_col(b), "\n", -1)
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))


def match_kind(a: Column | str, b: Column | str, least: float = 0.9) -> Column:
    """exact, prefix (of either in the other), similar lines, or mismatch."""
    a, b = _col(a), _col(b)
    return F.when(a == b, "exact").when(a.startswith(b) | b.startswith(a), "prefix").when(line_jaccard(a, b) >= least, "similar").otherwise("mismatch")
