"""Crawled pages: listings, metadata, upserts, sampling, and pluggable fetching."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions import text as tx

#: A fetcher takes batches with a url column and yields url, status, body, error.
Fetcher = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def fetch(urls: DataFrame, fetcher: Fetcher | DataFrame) -> DataFrame:
    """Pages by a fetcher that runs inside tasks, or from a table of pages (url, html). A page that can't be had has
    status 0 and an error."""
    if isinstance(fetcher, DataFrame):
        pages = fetcher.select("url", F.col("html").alias("body"))
        found = urls.select("url").join(pages, "url", "left")
        return found.select("url", F.when(F.col("body").isNull(), 0).otherwise(200).alias("status"), "body", F.when(F.col("body").isNull(), "not found").alias("error"))
    return urls.select("url").mapInPandas(fetcher, "url string, status int, body string, error string")


def listed(pages: DataFrame, marker: str, html: str = "html") -> DataFrame:
    """Links that follow each marker in listing pages, in order: url, page columns kept."""
    pieces = F.slice(F.split(html, marker, -1), 2, 2**31 - 1)
    links = F.filter(F.transform(pieces, lambda p: F.regexp_extract(p, r'href="([^"]*)"', 1)), lambda x: x != "")
    return pages.select(*[c for c in pages.columns if c not in (html, "url")], F.explode(links).alias("url"))


def unseen(urls: DataFrame, existing: DataFrame, key: str = "url") -> DataFrame:
    return urls.join(existing.select(key), key, "left_anti")


def upserted(existing: DataFrame, batch: DataFrame, key: str = "url") -> DataFrame:
    """existing and the rows of batch whose key is new; repeats inside the batch stay."""
    return existing.unionByName(unseen(batch, existing, key), allowMissingColumns=True)


def metadata(pages: DataFrame, html: str = "html") -> DataFrame:
    return pages.withColumn("meta", tx.html_fields(html)).select(*[c for c in pages.columns if c != html], "meta.*")


def naturally_ordered(files: DataFrame, folder: str = "folder", name: str = "name") -> DataFrame:
    return files.orderBy(folder, tx.natural_key(name), name)


def sampled(files: DataFrame, n: int = 50, by: str = "version", name: str = "name", seed: int = 42) -> DataFrame:
    """At most n files of each group, by a hash of seed and name: the same ones whatever the partitioning."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(name)))
    return files.withColumn("place", F.row_number().over(W.partitionBy(by).orderBy(digest, name))).where(F.col("place") <= n).drop("place")
