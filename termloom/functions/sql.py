"""The library's Python functions under SQL names, for spark.sql()."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import SparkSession, functions as F, types as T

from .responses import tolerant_json
from .terminal import Screen, fold


class Lines:
    """UDTF: the lines of a text, from 1."""

    def eval(self, text: str | None):
        for n, line in enumerate([] if text is None else text.split("\n"), 1):
            yield n, line


def register(spark: SparkSession) -> None:
    """fold_backspaces(text), terminal_screen(text, width, height), sequence_ratio(a, b), tolerant_json(reply), and the
    table function text_lines(text)."""

    def folded(texts: pd.Series) -> pd.Series:
        return texts.map(fold, na_action="ignore")

    def shown(texts: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else Screen(int(w), int(h)).feed(t).text() for t, w, h in zip(texts, width, height)])

    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)])

    def parsed(replies: pd.Series) -> pd.Series:
        return replies.map(tolerant_json)

    for name, fn, kind in (("fold_backspaces", folded, T.StringType()), ("terminal_screen", shown, T.StringType()), ("sequence_ratio", ratio, T.DoubleType()), ("tolerant_json", parsed, T.StringType())):
        spark.udf.register(name, F.pandas_udf(fn, kind))
    spark.udtf.register("text_lines", F.udtf(Lines, returnType="line_no int, line string"))
