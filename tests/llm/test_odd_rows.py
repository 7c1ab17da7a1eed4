"""Ids that repeat under other texts, names that clash, many full windows."""
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabloom.llm import exact_dedup, mixing, near_dedup, packing, url_filter

BASE = " ".join(f"w{i}" for i in range(80))
OTHER = " ".join(f"z{i}" for i in range(80))


def texts(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_near_dedup_keeps_texts_of_shared_ids(spark):
    a, b = BASE, OTHER
    near_b = b.replace("z79", "y79")
    rows = [(1, a), (1, b), (2, near_b), (0, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in
           near_dedup.near_groups(df).collect()}
    assert got == {(1, 0, False), (1, 1, True), (2, 1, False), (0, 0, True)}
    assert texts(near_dedup.dedup_documents(df)) == {(0, a): 1, (1, b): 1}


def test_near_dedup_leaves_one_of_rows_that_share_the_kept_id(spark):
    near = BASE.replace("w79", "y79")
    rows = [(1, BASE), (1, near), (1, BASE), (1, OTHER), (1, ""), (1, ""), (None, BASE)]
    got = texts(near_dedup.dedup_documents(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))
    # the two components of id 1, the rows without words, the row without id
    assert got[(1, OTHER)] == 1 and got[(1, "")] == 2 and got[(None, BASE)] == 1
    assert got[(1, BASE)] + got[(1, near)] == 1


NAMES = ["row", "id", "key", "gone_id", "gone_key", "text_key", "digest", "rows", "copies", "nth",
         "keep_id", "keep_digest", "first", "t_id", "t_source", "t_size", "size", "_copies", "_rows",
         "_id", "_digest_of_row", "_keep_id", "_keep_rows", "_gone", "class", "rep", "a.b", "col"]


@pytest.mark.parametrize("stage", [exact_dedup.dedup_documents, near_dedup.dedup_documents,
                                   mixing.mix_documents])
def test_stages_keep_columns_of_any_name(spark, stage):
    rows = [(i, BASE if i % 3 else OTHER, f"s{i % 2}") for i in range(6)] + [(1, BASE, "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns(
        {n: F.concat(F.lit(n), F.col("doc_id")) for n in NAMES})
    out = stage(df)
    assert out.columns == df.columns
    got = out.collect()
    assert got and all(r[n] == f"{n}{r['doc_id']}" for r in got for n in NAMES)


def test_full_windows_are_spread(spark):
    pieces = spark.range(20000, numPartitions=8).select(
        F.col("id").alias("doc_id"), F.col("id").alias("row_key"), F.lit(0).cast("long").alias("start"),
        F.when(F.col("id") % 10 == 0, 5).otherwise(16).cast("long").alias("length"))
    got = packing.pack(pieces, window=16, group_pieces=500)
    full = got.where("length = 16")
    assert full.select("sequence_id").distinct().count() == 18000
    assert full.groupBy(F.spark_partition_id()).count().count() == 8
    rest = got.where("length = 5").groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert rest.agg(F.max("n")).first()[0] <= 16
    assert not set(r[0] for r in rest.select("sequence_id").collect()) & set(
        r[0] for r in full.select("sequence_id").collect())


def test_path_that_ends_in_a_line_break(spark):
    df = spark.createDataFrame([("h", "/p/\n"), ("h", "/p//")], "host string, path string")
    got = [r[0] for r in df.select(url_filter.canonical(F.col("host"), F.col("path"))).collect()]
    assert got == ["h/p/\n", "h/p"]


def test_score_is_that_of_the_fitted_weights(spark, monkeypatch):
    """Scores recomputed word by word from the weights and counts."""
    import numpy as np

    from tabloom.llm import lm
    kept = {}
    fit = lm.fit

    def keep(coded, sent, *more):
        kept["v"], kept["w"] = sent.value, fit(coded, sent, *more)
        return kept["w"]

    monkeypatch.setattr(lm, "fit", keep)
    monkeypatch.setattr(lm, "FREQUENT", 150)
    vocabulary = lm.vocabulary
    monkeypatch.setattr(lm, "vocabulary", lambda counts: vocabulary(counts, 150))
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{int(k) % 400}" for k in rng.zipf(1.3, 40))) for i in range(60)]
    rows += [(60, ""), (61, None), (62, "w1"), (63, "never seen before")]
    got = {r["doc_id"]: r for r in lm.score(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    v, w = kept["v"], lm.Weights(kept["v"], kept["w"])
    train = Counter(t for i, text in rows if not got[i]["held_out"] for t in [*lm.words(text), b""])
    codes = lm.Codes(v.frequent)
    for i, text in rows:
        total, before = 0.0, [v.start] * lm.CONTEXT
        for t in [*lm.words(text), b""]:
            code = codes[t]
            h = sum(w.r[before[-1 - k]].astype(float) * w.c[k] for k in range(lm.CONTEXT))
            z = w.q.astype(float) @ h + w.bias
            z -= z.max()
            total += (z[v.out_of[code]] - np.log(np.exp(z).sum())) / np.log(10)
            unit = lm._class_of(t)
            if code >= len(v.frequent):
                total += (np.log10((train[t] - v.cut[unit]) / v.size[unit]) if train[t]
                          else v.log_unknown[unit])
            else:
                total += v.log_inside[code]
            before.append(v.in_of[code])
        assert got[i]["score"] == pytest.approx(total, rel=1e-4), i
    assert len(v.frequent) == 150 < len(train)
