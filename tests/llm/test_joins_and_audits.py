"""N-gram join, divergence audit and whitening against brute force."""
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tabloom.llm import divergence, set_join, whiten


# ------------------------------------------------------------- n-gram join
def shingles(t):
    w = (t or "").encode().lower().split()
    if not w:
        return frozenset()
    k = min(len(w), 5)
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def brute_join(rows, percent=80):
    """{(id, text): (size, lowest id reachable, links)} of rows with an id."""
    rows = [r for r in rows if r[0] is not None]
    sets = [shingles(t) for _, t in rows]
    near = defaultdict(set)
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                near[i].add(j)
                near[j].add(i)
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i not in seen:
            reach, todo = {i}, [i]
            while todo:
                new = near[todo.pop()] - reach
                reach |= new
                todo += new
            seen |= reach
            for j in reach:
                out[j] = (rows[j][0], len(sets[j]), min(rows[x][0] for x in reach), len(near[j]))
    return sorted(out)


def joined(df, percent=80):
    got = [tuple(r) for r in set_join.join_groups(df, percent=percent).select(
        "doc_id", "n_shingles", "component_id", "n_links").collect()]
    return sorted(r for r in got if r[0] is not None), [r for r in got if r[0] is None]


def test_join_with_odd_rows(docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got, null = joined(docs)
    assert got == brute_join(rows)
    assert null == [(None, 116, None, 0)]
    assert set_join.join_groups(no_docs).count() == 0


def variants(n, words=60, edits=2, seed=3):
    """Texts near one another, some of them linked only through others."""
    rng = np.random.default_rng(seed)
    base = [f"b{i}" for i in range(words)]
    out = []
    for _ in range(n):
        t = list(base)
        for at in rng.integers(0, words, rng.integers(0, edits + 1)):
            t[at] = f"v{rng.integers(40)}"
        out.append(" ".join(t[:words - int(rng.integers(0, 6))]))
    return out


@pytest.mark.parametrize("group,block", [(64, 1024), (2, 1024), (2, 7)])
def test_join_by_pairs_and_by_blocks(spark, monkeypatch, group, block):
    monkeypatch.setattr(set_join, "GROUP", group)
    monkeypatch.setattr(set_join, "BLOCK", block)
    texts = variants(60) + variants(25, words=200, edits=6, seed=4) + [
        f"alone {i} " + " ".join(f"q{i}x{j}" for j in range(20)) for i in range(20)]
    # ids that repeat under other texts, copies in other letters
    rows = [(i % 90, t) for i, t in enumerate(texts)] + [(200, texts[0].upper()), (201, texts[70])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got, _ = joined(df)
    assert got == brute_join(rows)
    assert max(r[3] for r in got) > 10


def test_join_at_the_threshold(spark):
    # 10 shingles each, 9 or 8 shared: 8 of 12 is below 80, 9 of 11 above
    base = [f"w{i}" for i in range(14)]
    near = base[:13] + ["x"]
    far = base[:12] + ["x", "y"]
    four = [f"k{i}" for i in range(44)]    # 40 shingles, 36 shared of 44 or 45
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far)), (4, " ".join(four)),
            (5, " ".join(four[:40])), (6, " ".join(four[:36] + ["m"] * 9))]
    got, _ = joined(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute_join(rows)


# --------------------------------------------------------------- divergence
def brute_audit(rows, least):
    fold = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    docs = [(la or "", so or "", Counter(fold.findall((t or "").translate(lower))))
            for la, so, t in rows]
    out = []
    for lang in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == lang]
        df = Counter(t for _, _, c in here for t in c)
        kept = sorted(t for t, n in df.items() if n >= least)
        count = defaultdict(Counter)
        for _, s, c in here:
            count[s].update({t: c[t] for t in c if df[t] >= least})
        whole = sum(count.values(), Counter())

        def p(c):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        ps, q = {s: p(count[s]) for s in count}, p(whole)
        for s in count:
            pair = [(sum(f(ps[s][t], ps[o][t]) for t in kept), o) for o in count if o != s]
            term = [(f(ps[s][t], q[t]), t) for t in kept if count[s][t] and ps[s][t] > q[t]]
            for part, items, top in (("pair", pair, len(pair)), ("term", term, 10)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, t, v, i + 1) for i, (v, t) in enumerate(items[:top])]
    return sorted(out)


def audit_rows():
    rng = np.random.default_rng(5)
    stems = ["a", "ab", "abc", "abcdefgh", "abcdefghi", "é", "über", "ÜBER", "日本語日本語", "x" * 70,
             "x" * 70 + "y", *(f"t{chr(97 + i)}" for i in range(20))]
    rows = []
    for i in range(160):
        ws = [stems[int(k)] for k in rng.zipf(1.4, 12) % len(stems)]
        text = " ".join(w.upper() if rng.random() < .3 else w for w in ws) + f" rare{chr(97 + i % 26)}3z"
        rows.append((["en", "de", None, ""][i % 4], [None, "", "s1", "s2", "s3"][i % 5], text))
    return rows + [("fr", "only", "too few here"), ("en", "empty", None), ("en", "s1", "1 2 3 _")]


@pytest.mark.parametrize("block", [96, 2])
def test_audit(spark, monkeypatch, block):
    monkeypatch.setattr(divergence, "SOURCE_BLOCK", block)
    monkeypatch.setattr(divergence, "TERM_BUCKET", 8)
    rows = audit_rows()
    df = spark.createDataFrame([(r[0], r[1], r[2], "x", 1) for r in rows],
                               "lang string, source string, text string, term string, n int")
    got = sorted(tuple(r) for r in divergence.audit(df.repartition(4)).collect())
    want = brute_audit(rows, 10)
    assert got == want
    assert {r[0] for r in got if r[2] == "term"} >= {"en", "de", ""}


def test_audit_discards_and_finds_prefixes(spark, no_docs):
    lists = divergence.term_lists(spark.createDataFrame(
        [("en", "s", "abcd abce " + "z" * 40)] * 2 + [("en", "s", "abcf")], "lang string, source string, text string"))
    got = {bytes(r["term"]) for r in divergence.kept_terms(lists, 2).collect()}
    assert got == {b"abcd", b"abce", b"z" * 40}
    counts = {bytes(r["item"]): r["docs"] for r in
              divergence.level_counts(lists, 0, 2, None).collect()}
    assert counts == {b"ab\0": 3, b"zz\0": 2}
    assert divergence.audit(no_docs).count() == 0


# ---------------------------------------------------------------- whitening
def brute_whiten(vectors, k):
    x = np.floor(1024 * np.array(vectors, dtype=float)).astype(np.int64) + 100000
    n, s = len(x), x.sum(axis=0)
    gap = n * x - s
    e, u = np.linalg.eigh((gap / n).T @ (gap / n) / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return gap, e, (gap / n) @ u / np.sqrt(e)


def check_whiten(spark, vectors, k=8):
    df = spark.createDataFrame([(i, [float(c) for c in v], 1) for i, v in enumerate(vectors)],
                               "vec_id long, embedding array<float>, x int")
    vectors = [np.array(v, dtype=np.float32).astype(float) for v in vectors]
    got = whiten.whiten(df.repartition(3), k=k).toPandas().sort_values(["component", "vec_id"])
    gap, e, z = brute_whiten(vectors, min(k, len(vectors[0])))
    m = got["component"].max()
    assert len(got) == m * len(vectors)
    mine = got["whitened"].to_numpy().reshape(m, -1).T
    assert got["identity_error"].iloc[0] < 1e-9 and (got["n"] == len(vectors)).all()
    assert (got["deviation"].to_numpy()[:len(vectors)] == (gap ** 2).sum(axis=1)).all()
    total = (gap / len(gap)) ** 2
    share = got["explained"].to_numpy().reshape(m, -1)[:, 0]
    assert np.allclose(share, e[:m] * len(gap) / total.sum(), rtol=1e-9)
    return mine, z[:, :m]


def test_whitening(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(300, 12)) * np.linspace(3, 0.5, 12) + 0.25
    mine, want = check_whiten(spark, vectors)
    signs = np.sign((mine * want).sum(axis=0))
    assert np.abs(mine - want * signs).max() < 1e-9


def test_whitening_with_repeated_eigenvalues(spark):
    # +- unit vectors: all eigenvalues equal; one sequence sees one of them
    eye = np.eye(6) * 0.5
    mine, _ = check_whiten(spark, np.r_[eye, -eye], k=6)
    assert np.allclose(mine.T @ mine / len(mine), np.eye(6), atol=1e-9)


def test_whitening_with_flat_directions(spark):
    rng = np.random.default_rng(2)
    flat = rng.integers(-3, 4, size=(50, 2)) / 4.0
    vectors = np.c_[flat, flat[:, 0], np.ones(50)]
    mine, want = check_whiten(spark, vectors)
    assert mine.shape[1] == 2


def test_whitening_odd_rows(spark):
    schema = "vec_id long, embedding array<float>"
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.0, 1.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (None, [2.0, 5.0])]
    odd = [(4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (9, [])]
    got = whiten.whiten(spark.createDataFrame(good + odd, schema)).collect()
    assert sorted(str(r["vec_id"]) for r in got) == sorted(
        str(i) for i, _ in good for _ in range(2))
    assert {r["n"] for r in got} == {4}
    assert whiten.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whiten.whiten(spark.createDataFrame(odd[:1] + odd[5:], schema)).count() == 0
    assert whiten.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 5, schema)).count() == 0
