"""URLs, vectors, the queries' SQL, and the pipeline."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import ann, url_filter
from tabloom.llm.queries import ORACLE, QUERIES, URL_RULES, tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    import duckdb
    got = QUERIES[name](spark, SF).toPandas()
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLE[name]).df()
    cols = sorted(got.columns)
    key = next(([k] for k in ("page_id", "doc_id") if k in cols), cols)
    assert cols == sorted(want.columns) and len(got) == len(want)
    a = got[cols].sort_values(key).reset_index(drop=True)
    b = want[cols].sort_values(key).reset_index(drop=True)
    for c in cols:
        assert ((a[c] == b[c]) | (a[c].isna() & b[c].isna())).all(), c


def test_url_filter(spark):
    rows = [(1, "HTTP://WWW.Example.com/en/x?y"), (2, "http://m.example.com/en/"),
            (3, "http://example.com/fr"), (4, "http://a.net/es/1"), (5, "http://org/p/"),
            (6, "http://ORG/p#f"), (7, None), (8, "no scheme"), (9, "http://"),
            (None, "http://notexample.com?q=://x"), (5, "http://org/p/"), (11, "http://org/q")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn(
        "verdict", F.lit("mine")).withColumn("canon", F.lit("mine"))
    listed = spark.createDataFrame([("https://org/p",), (None,), ("",)], "url string")
    got = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in
           url_filter.judge_urls(pages, URL_RULES, listed).collect()}
    assert got == {
        (1, "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        (2, "m.example.com", "/en/", "example.com/en/", "block"),
        (3, "example.com", "/fr", "com/", "allow"), (4, "a.net", "/es/1", "net/es/", "block"),
        (5, "org", "/p/", None, "block"), (6, "org", "/p", None, "block"),
        (7, "", "", None, "allow"), (8, "", "", None, "allow"), (9, "", "", None, "allow"),
        (None, "notexample.com", "", None, "allow"), (11, "org", "/q", None, "allow")}
    assert url_filter.judge_urls(pages.limit(0), URL_RULES, listed.limit(0)).count() == 0


def test_bloom_filter_misses_nothing(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("h"))
    bloom = url_filter.build_filter(keys, 5000)
    h = np.array([r["h"] for r in keys.collect()], dtype=np.int64)
    assert url_filter.probe(h, bloom).all()
    other = np.random.default_rng(1).integers(-2**62, 2**62, 20000)
    assert url_filter.probe(other, bloom).mean() < 0.02
    small = url_filter.build_filter(keys, 5000, max_bytes=640)
    assert small.nbytes <= 640 and url_filter.probe(h, small).all()


def brute(rows, queries, k):
    out = {}
    for q, v in queries:
        d = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), i)
                   for i, w in rows if i != q)
        out[q] = d[:k]
    return out


def test_nearest(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[500:900] = x[0]                      # one very common vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(5001, None), (5002, [0.0] * 16), (5003, [float("nan")] * 16), (5004, [None] * 16),
           (5005, [float("inf")] * 16), (None, x[1].tolist())]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn(
        "score", F.lit(1)).withColumn("rank", F.lit("x"))
    got = ann.nearest(df, df.where("vec_id % 50 = 0 or vec_id > 5000"), shard_rows=400).collect()
    want = brute(rows, [r for r in rows if r[0] % 50 == 0], 10)
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert set(found) == set(want) and all(len(v) == 10 for v in found.values())
    hit = [len({i for _, i in want[q]} & {i for _, i in found[q]}) / 10 for q in want]
    assert np.mean(hit) >= 0.9
    assert found[500] == [(0.0, i) for i in [0, *range(501, 510)]]
    true = dict(rows)
    for q, near in found.items():
        for s, i in near:
            assert s == pytest.approx(np.linalg.norm(np.array(true[q]) - np.array(true[i])), abs=1e-12)
    few = df.where("vec_id < 4")
    assert ann.nearest(few, few).count() == 12
    assert ann.nearest(few.limit(0), few.limit(0)).count() == 0


def test_pipeline_agrees_with_its_parts(spark):
    """Each stage against plain Python on the rows it was given."""
    import corpus_pipeline
    from tabloom.llm import mixing
    from tabloom.llm.common import stage_table, table
    from tests.llm.test_documents import brute_components
    docs = table(spark, SF, "documents")
    labels = {r["doc_id"]: r for r in table(spark, SF, "labels").collect()}
    stages = dict(corpus_pipeline.STAGES)
    step = {}
    for name, fn in corpus_pipeline.STAGES:
        step[name] = stage_table(fn(spark, docs, SF), f"test-{name}")
        if name != "packing":
            assert step[name].columns == docs.columns
        docs = step[name]
    assert list(stages) == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    kept = {r["doc_id"]: r["text"] for r in step["quality"].collect()}
    good = [i for i, r in labels.items() if r["quality"] == 1]
    assert np.mean([i in kept for i in good]) >= 0.98
    groups = {}
    for i, t in kept.items():
        groups.setdefault(t.encode().lower(), []).append(i)
    single = {max(v) for v in groups.values()}
    assert {r["doc_id"] for r in step["exact_dedup"].collect()} == single
    want = brute_components([(i, kept[i]) for i in single], 80)
    apart = {i for i, (_, c) in want.items() if i == c}
    assert {r["doc_id"] for r in step["near_dedup"].collect()} == apart
    take = {r["doc_id"]: r["copies"] for r in mixing.copies(step["near_dedup"]).collect()}
    mixed = {r["doc_id"]: r["count"] for r in step["mixing"].groupBy("doc_id").count().collect()}
    assert mixed == {i: n for i, n in take.items() if n}
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    tokens = sum(n * (len(t.encode(kept[i], add_special_tokens=False).ids) + 1)
                 for i, n in mixed.items())
    assert step["packing"].agg(F.sum("length")).first()[0] == tokens
