"""Exact dedup by a heavy-hitter split.

Digests of the normalised texts are summarised by Misra-Gries counters, one
bounded summary per task, merged by a grouped sum.  The candidates (at most
``counters`` + 1 rows) are verified by an exact count, and the verified ones
are broadcast: their rows are resolved map-side and never shuffled by key.
All other digests hold at most a ``2 / counters`` share of the rows each and
take an ordinary shuffle.

Defined cases: null text counts as empty, so null and empty texts are
copies of each other; null ids are smaller than any id; a group whose ids
are all null keeps its rows (``keep_id`` null); an empty table gives an
empty result; rows that repeat one id and one text all report the same
decision, and ``dedup_documents`` returns one of them.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import ascii_lower, nest, stage_table, unnest

COUNTERS = 1024  # bound of every summary and of the broadcast table


def text_digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the text, A-Z lower-cased, in UTF-8."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256)


def misra_gries(df: DataFrame, key: str, counters: int = COUNTERS) -> DataFrame:
    """Merged summaries: (key, weight), with weight <= count and
    count - weight <= rows / (counters + 1) for every key.

    Only keys whose weight exceeds both 1 and rows / (counters + 1) are
    returned, so there are at most ``counters`` + 1 of them.
    """
    def summarise(batches):
        counts: dict = {}
        rows = 0
        for pdf in batches:
            rows += len(pdf)
            for k, c in pdf["k"].value_counts().items():
                counts[k] = counts.get(k, 0) + int(c)
            if len(counts) > counters:
                cut = sorted(counts.values(), reverse=True)[counters]
                counts = {k: c - cut for k, c in counts.items() if c > cut}
        yield pd.DataFrame({"k": [*counts, None], "weight": [*counts.values(), 0],
                            "seen": [0] * len(counts) + [rows]})

    parts = df.select(F.col(key).alias("k")).mapInPandas(
        summarise, "k string, weight long, seen long")
    merged = stage_table(parts.groupBy("k").agg(
        F.sum("weight").alias("weight"), F.sum("seen").alias("seen")), "misra-gries")
    rows = merged.agg(F.sum("seen")).first()[0] or 0
    floor = max(1.0, rows / (counters + 1))
    return merged.where(F.col("k").isNotNull() & (F.col("weight") > floor)).select("k", "weight")


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = stage_table(docs.select(
        F.col(id_col).alias("doc_id"), text_digest(F.col(text_col)).alias("digest"),
        F.char_length(F.coalesce(F.col(text_col), F.lit(""))).alias("chars")), "digests")
    heavy = F.broadcast(misra_gries(rows, "digest", counters).select(F.col("k").alias("digest")))
    # verified: the exact count, and one length (a digest clash would show two)
    winners = (rows.join(heavy, "digest", "left_semi").groupBy("digest")
               .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
                    F.min("chars").alias("lo"), F.max("chars").alias("hi"))
               .where("lo = hi").drop("lo", "hi"))
    winners = F.broadcast(stage_table(winners, "winners"))
    solved = rows.join(winners, "digest").select("doc_id", "digest", "keep_id", "group_size")
    w = Window.partitionBy("digest", "chars")
    rest = rows.join(winners, "digest", "left_anti").select(
        "doc_id", "digest", F.max("doc_id").over(w).alias("keep_id"),
        F.count(F.lit(1)).over(w).alias("group_size"))
    both = solved.unionByName(rest)
    return both.select("doc_id", "keep_id", "group_size",
                       F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                       F.col("digest").alias("text_sha256"))


def dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    counters: int = COUNTERS) -> DataFrame:
    """The documents that stay, with all their columns."""
    decisions = stage_table(decide(docs, id_col, text_col, counters), "decisions")
    kept = decisions.where("kept").groupBy("doc_id", "text_sha256").agg(
        F.count(F.lit(1)).alias("rows"))
    kept = stage_table(kept, "kept").toDF("keep_id", "keep_digest", "rows")
    out = nest(docs, id=F.col(id_col), digest=text_digest(F.col(text_col))).join(
        kept, F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("digest") == F.col("keep_digest")))
    once = out.where(F.col("rows") == 1)
    if not kept.where("rows > 1").isEmpty():
        once = once.unionByName(out.where(F.col("rows") > 1).dropDuplicates(["keep_id", "digest"]))
    return unnest(once, docs.columns)
