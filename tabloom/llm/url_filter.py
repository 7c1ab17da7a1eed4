"""URL filter: prefix rules, and a blocked Bloom filter before an exact join.

``listed`` is a table of URLs to block, of any size.  Their canonical forms
set bits of a blocked Bloom filter: one 64-byte block per URL, six bits in
it, so a probe touches one cache line.  The filter never exceeds
``max_bytes`` (a longer list only raises the share of false positives), which
bounds the broadcast.  Possible hits alone go to an exact hash join with the
list, which removes the false positives; everything else is never shuffled.

Rules (host, path, verdict) are a short parameter and go before the list: a
rule fits its host and all subdomains when the URL's path starts with the
rule's; the longest ``host + path`` wins, then the longer host.

Defined cases: a null URL or one without ``://`` has empty host and path, fits
no rule and is not listed (verdict allow); null page ids stay; repeated
rows are judged alike; an empty list or table gives no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import ascii_lower, stage_table

WORDS = 8             # 64-bit words of a block
PROBES = 6            # bits set in a block
BITS_PER_KEY = 16
MAX_BYTES = 64 << 20  # bound of the broadcast filter


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL, both empty without ``://``."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise(F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1)),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.``, path without trailing slashes; null
    where there is no host."""
    return F.when(host != "", F.concat(F.regexp_replace(host, r"^www\.", ""),
                                       F.regexp_replace(path, r"/+\z", "")))


def _bits(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each hash and the (n, PROBES) bit numbers inside it."""
    u = h.view(np.uint64)
    block = (u >> np.uint64(32)) % np.uint64(blocks)
    low = u & np.uint64(0xFFFFFFFF)
    step = (low >> np.uint64(16)) | np.uint64(1)
    k = np.arange(PROBES, dtype=np.uint64)
    return block.astype(np.int64), ((low[:, None] + k * step[:, None] + k * k) %
                                    np.uint64(64 * WORDS)).astype(np.int64)


def _words(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and its mask of WORDS 64-bit words for each hash."""
    block, bits = _bits(h, blocks)
    mask = np.zeros((len(h), WORDS), dtype=np.uint64)
    rows = np.arange(len(h))
    for k in range(PROBES):
        b = bits[:, k]
        mask[rows, b >> 6] |= np.uint64(1) << (b & 63).astype(np.uint64)
    return block, mask


def build_filter(keys: DataFrame, n: int, max_bytes: int = MAX_BYTES) -> np.ndarray:
    """(blocks, WORDS) uint64 from a frame of one long column of hashes."""
    blocks = int(max(1, min(max_bytes // (8 * WORDS), -(-n * BITS_PER_KEY // (64 * WORDS)))))
    col = keys.columns[0]
    fields = ", ".join(f"w{i} long" for i in range(WORDS))

    def masks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            block, mask = _words(pdf[col].to_numpy(np.int64), blocks)
            order = np.argsort(block, kind="stable")
            block, mask = block[order], mask[order]
            first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            mask = np.bitwise_or.reduceat(mask, first, axis=0).view(np.int64)
            yield pd.DataFrame({"block": block[first]} | {
                f"w{i}": mask[:, i] for i in range(WORDS)})

    merged = keys.mapInPandas(masks, f"block long, {fields}").groupBy("block").agg(
        *[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
    out = np.zeros((blocks, WORDS), dtype=np.uint64)
    got = merged.toPandas()  # at most max_bytes / 64 rows
    if len(got):
        out[got["block"].to_numpy()] = np.stack(
            [got[f"w{i}"].to_numpy(np.int64).view(np.uint64) for i in range(WORDS)], axis=1)
    return out


def probe(h: np.ndarray, bloom: np.ndarray) -> np.ndarray:
    block, mask = _words(h, len(bloom))
    return ((bloom[block] & mask) == mask).all(axis=1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The text ``host + path`` of the longest fitting rule, or null."""
    out = F.lit(None).cast("string")
    for r_host, r_path, _ in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]))):
        fits = ((host == r_host) | host.endswith("." + r_host)) & path.startswith(r_path)
        out = F.when(fits, F.lit(r_host + r_path)).otherwise(out)
    return out


def canonical_list(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Distinct canonical forms of a table of URLs, and their hashes."""
    host, path = url_parts(F.col(url_col))
    return (urls.select(canonical(host, path).alias("canon")).where("canon is not null")
            .groupBy("canon").agg(F.xxhash64("canon").alias("h")))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], listed: DataFrame,
               id_col: str = "page_id", url_col: str = "url", listed_col: str = "url",
               max_bytes: int = MAX_BYTES) -> DataFrame:
    """page_id, host, path, rule, listed, verdict per page row."""
    names = stage_table(canonical_list(listed, listed_col), "url-list")
    n = names.count()
    bloom = pages.sparkSession.sparkContext.broadcast(
        build_filter(names.select("h"), n, max_bytes))

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        return pd.Series(probe(h.to_numpy(np.int64), bloom.value))

    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("canon", canonical(F.col("host"), F.col("path")))
    rows = rows.withColumn("maybe", F.col("canon").isNotNull()
                           & maybe(F.xxhash64(F.coalesce("canon", F.lit("")))))
    rows = stage_table(rows, "url-probes")
    hits = rows.where("maybe")
    exact = hits.join(names.select(F.col("canon").alias("name")),
                      F.col("canon") == F.col("name"), "left").withColumn(
        "listed", F.col("name").isNotNull()).drop("name")
    every = exact.unionByName(rows.where("not maybe").withColumn("listed", F.lit(False)))
    rule = rule_of(F.col("host"), F.col("path"), rules)
    verdict = F.lit(None).cast("string")
    for r_host, r_path, says in rules:
        verdict = F.when(F.col("rule") == r_host + r_path, F.lit(says)).otherwise(verdict)
    return every.withColumn("rule", rule).select(
        "page_id", "host", "path", "rule", "listed",
        F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))
