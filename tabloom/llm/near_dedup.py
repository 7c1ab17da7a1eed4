"""MinHash near-dedup with sequential Bayesian verification.

1. Every document gets its set of 5-word shingles (64-bit hashes), a digest
   of the set, 192 min-hashes, and keys of a few min-hashes each: 32 of six
   for a threshold of 0.85, 38 of five for 0.8 (``layout``).
2. Documents with one set are one class; its smallest id stands for it.
3. Classes that share a band key are candidates.  First each member of a
   bucket meets four pivots of the bucket (the members first in four global
   random orders, so one group has the same pivots in every band).  The
   links found are closed to components.  In buckets that still hold more
   than one component, every pair of different components is decided too:
   as candidate pairs in buckets of up to 24 members, and in larger ones on
   full sets in blocks of members, which return links but no pairs.
4. Verification compares 32 min-hashes at a time.  With a uniform prior the
   posterior of the similarity after n comparisons with m matches is
   Beta(m + 1, n - m + 1); a pair whose posterior chance of reaching the
   threshold falls below ``miss`` is pruned.  Survivors are decided on their
   full sets.

A pair at the threshold 0.85 shares no band key with probability
(1 - 0.85**6)**32 = 2.6e-7, one at 0.8 with (1 - 0.8**5)**38 = 2.8e-7, and
more similar pairs far less.

Defined cases: null text is empty; documents without words are linked with
nothing and stay; null ids take no part (component null, kept); rows that
repeat an id are compared each with its own set; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import nest, spread, stage_table, unnest

SHINGLE = 5
LANES = 192
BAND_MISS = 3e-7      # chance that a pair at the threshold shares no band key
BATCH = 32            # min-hashes compared at a time
MISS = 1e-6           # chance of pruning a pair that reaches the threshold
PIVOTS = 4
CACHE_WORDS = 150_000
FEW_EDGES = 400_000   # edges of 16 bytes that one task closes to components
SMALL = 24            # members of a bucket whose pairs are made as rows
BLOCK = 256           # members of a block of a larger bucket
BROADCAST_IDS = 1_000_000  # ids of 8 bytes; past it the ids join by a shuffle

_RNG = np.random.default_rng(20240601)
_MIX = _RNG.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PERM = _RNG.integers(1, 2**31, LANES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_BAND = _RNG.integers(1, 2**63, LANES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_WORDS: dict[bytes, int] = {}


def _finish(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; A-Z lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    get, hashes = _WORDS.get, []
    for w in words:
        h = get(w)
        if h is None:
            h = xxhash.xxh3_64_intdigest(w)
            if len(_WORDS) < CACHE_WORDS:
                _WORDS[w] = h
        hashes.append(h)
    h = np.array(hashes, dtype=np.uint64)
    k = min(len(h), shingle)
    mixed = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        mixed += h[i:len(h) - k + 1 + i] * _MIX[i]
    return np.unique(_finish(mixed))


def signature(s: np.ndarray) -> np.ndarray:
    """LANES min-hashes (uint32) of a set that isn't empty."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(LANES, 0xFFFFFFFF, dtype=np.uint32)
    for lo in range(0, len(x), 4096):
        np.minimum(out, (x[lo:lo + 4096, None] * _PERM[None, :]).min(axis=0), out=out)
    return out


def layout(percent: int) -> tuple[int, int]:
    """(min-hashes of a band, bands): the longest bands that miss a pair at
    the threshold with BAND_MISS at most."""
    for rows in range(LANES, 1, -1):
        if (1 - (percent / 100) ** rows) ** (LANES // rows) <= BAND_MISS:
            return rows, LANES // rows
    return 1, LANES


def band_keys(sig: np.ndarray, percent: int = 85) -> np.ndarray:
    """(n, bands) signed 64-bit keys; keys of different bands differ."""
    rows, bands = layout(percent)
    parts = sig[:, :rows * bands].reshape(-1, bands, rows).astype(np.uint64)
    mixed = (parts * _BAND[:rows * bands].reshape(1, bands, rows)).sum(axis=2, dtype=np.uint64)
    mixed += np.arange(bands, dtype=np.uint64)[None] * np.uint64(0xD1B54A32D192ED03)
    return _finish(mixed).view(np.int64)


def set_digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def sketch(docs: DataFrame, id_col: str, text_col: str, percent: int = 85) -> DataFrame:
    """doc_id, text_key, n_shingles, digest, lanes (low 16 bits of each
    min-hash), keys."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()),
                        ("n_shingles", pa.int64()),
                        ("digest", pa.binary()), ("lanes", pa.binary()),
                        ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digest, sigs = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text)
                n.append(len(s))
                digest.append(set_digest(s))
                sigs.append(signature(s) if len(s) else np.zeros(LANES, dtype=np.uint32))
            if not n:
                continue
            sig = np.stack(sigs)
            keys = band_keys(sig, percent)
            lanes = (sig & np.uint32(0xFFFF)).astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()),
                 pa.array(digest, pa.binary()), pa.array([r.tobytes() for r in lanes], pa.binary()),
                 pa.array(list(keys), pa.list_(pa.int64()))], schema=schema)

    rows = spread(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                              F.col(text_col).alias("text"),
                              F.xxhash64(text_col).alias("text_key")))
    return rows.mapInArrow(
        run, "doc_id long, text_key long, n_shingles long, digest binary, lanes binary, keys array<long>")


def least_matches(lanes: int, threshold: float, miss: float) -> np.ndarray:
    """By comparisons n: the fewest matches that keep a pair.

    P(J >= t | m of n) = P(Binomial(n + 1, t) <= m).
    """
    out = np.zeros(lanes + 1, dtype=np.int64)
    for n in range(1, lanes + 1):
        total = 0.0
        for m in range(n + 1):
            total += math.exp(math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m)
                              + m * math.log(threshold) + (n + 1 - m) * math.log1p(-threshold))
            if total >= miss:
                out[n] = m
                break
    return out


def posterior_survivors(a: list[bytes], b: list[bytes], floor: np.ndarray,
                        batch: int = BATCH) -> np.ndarray:
    """True for pairs that no batch of min-hashes prunes."""
    x = np.frombuffer(b"".join(a), "<u2").reshape(len(a), -1)
    y = np.frombuffer(b"".join(b), "<u2").reshape(len(b), -1)
    live = np.arange(len(a))
    matches = np.zeros(len(a), dtype=np.int64)
    for lo in range(0, x.shape[1], batch):
        hi = min(lo + batch, x.shape[1])
        matches[live] += (x[live, lo:hi] == y[live, lo:hi]).sum(axis=1)
        live = live[matches[live] >= floor[hi]]
    out = np.zeros(len(a), dtype=bool)
    out[live] = True
    return out


def verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str,
           percent: int, miss: float) -> DataFrame:
    """The links (a, b) among candidate pairs (a, b) of class ids.

    ``classes``: doc_id, n_shingles, digest, lanes of the class
    representatives.
    """
    floor = least_matches(LANES, percent / 100, miss)

    def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                keep = posterior_survivors(pdf["lanes_a"].tolist(), pdf["lanes_b"].tolist(), floor)
                yield pdf.loc[keep, ["a", "b"]]

    side = classes.select("doc_id", "n_shingles", "lanes")
    both = (pairs.join(side.toDF("a", "n_a", "lanes_a"), "a")
            .join(side.toDF("b", "n_b", "lanes_b"), "b"))
    # sets whose sizes are further apart than the threshold cannot reach it
    both = both.where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    left = stage_table(both.select("a", "b", "lanes_a", "lanes_b").mapInPandas(
        prune, "a long, b long"), "survivors")
    items = full_sets(left.select(F.explode(F.array("a", "b")).alias("id")).distinct(), classes,
                      docs, id_col, text_col)
    full = (left.join(items.toDF("a", "items_a"), "a").join(items.toDF("b", "items_b"), "b"))
    shared = full.select("a", "b", (F.size("items_a") + F.size("items_b")).alias("sum"),
                         F.size(F.array_intersect("items_a", "items_b")).alias("both"))
    return shared.where(f"100 * both >= {percent} * (sum - both)").select("a", "b")


def full_sets(ids: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str,
              text_col: str) -> DataFrame:
    """(doc_id, items) of the classes with these ids: their sets, made anew."""
    ids = stage_table(ids, "needed")
    wanted = stage_table(classes.join(ids, classes["doc_id"] == ids["id"], "left_semi").select(
        "doc_id", "rep", "digest"), "wanted")
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text"))
    needed = wanted.select("rep").distinct()
    needed = F.broadcast(needed) if wanted.count() <= BROADCAST_IDS else needed
    texts = texts.join(needed, "rep", "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shingle_set(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([set_digest(s) for s in got], pa.binary()),
                 pa.array([s.view(np.int64) for s in got], pa.list_(pa.int64()))],
                names=["rep", "digest", "items"])

    items = texts.mapInArrow(sets, "rep long, digest binary, items array<long>")
    return stage_table(items.join(wanted, ["rep", "digest"])
                       .dropDuplicates(["doc_id"]).select("doc_id", "items"), "sets")


def block_links(sets: list[np.ndarray], side: np.ndarray, comp: np.ndarray,
                percent: int) -> list[tuple[int, int]]:
    """Links that join components among one block's members, decided on
    their full sets; at most one per pair of components, and no cycles.

    Shingles of a single member meet nothing; the others are the columns of
    a 0/1 matrix whose products count the intersections.  ``side`` 0 and 1:
    members of the two blocks (pairs across only, if both are there).
    """
    size = np.array([len(s) for s in sets])
    names, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), size)
    keep = uses[column] > 1
    owner, column = owner[keep], column[keep]
    ranks = np.cumsum(uses > 1) - 1
    column = ranks[column]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for lo in range(0, int(column.max(initial=-1)) + 1, 4096):
        part = (column >= lo) & (column < lo + 4096)
        m = np.zeros((len(sets), 4096), dtype=np.float32)
        m[owner[part], column[part] - lo] = 1
        both += m @ m.T
    linked = 100 * both >= percent * (size[:, None] + size[None, :] - both)
    linked &= comp[:, None] < comp[None, :]  # symmetric so far: one of two suffices
    if side.any() and not side.all():
        linked &= side[:, None] != side[None, :]
    x, y = np.nonzero(linked)
    parent: dict[int, int] = {}

    def top(c: int) -> int:
        while parent.setdefault(c, c) != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    out = []
    for cx, cy in np.unique(np.stack([comp[x], comp[y]], axis=1), axis=0).tolist():
        if top(cx) != top(cy):
            parent[top(cx)] = top(cy)
            out.append((cx, cy))
    return out


def links_in_blocks(members: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between components, found inside large buckets.

    ``members``: key, n (of the bucket), doc_id, c (component).  A bucket is
    cut into blocks of about BLOCK members and every two blocks meet in one
    group, so a group's rows are bounded and no pair becomes a row.
    """
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = members.withColumn("own", F.pmod(F.xxhash64("doc_id", F.lit(7)), parts).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    dealt = dealt.select("key", F.least("own", "other").alias("i"),
                         F.greatest("own", "other").alias("j"), "own", "doc_id", "c")
    dealt = dealt.join(items, "doc_id")

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        got = block_links([np.asarray(v, dtype=np.int64) for v in pdf["items"]],
                          (pdf["own"] == pdf["j"]).to_numpy(), pdf["c"].to_numpy(), percent)
        return pd.DataFrame(got, columns=["a", "b"], dtype="int64")

    return dealt.groupBy("key", "i", "j").applyInPandas(kernel, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component): smallest id reachable, for every id in an edge.

    Alternates large-star and small-star steps, which end after O(log^2 n)
    rounds; each round's edges are written to the shared folder.
    """
    now = stage_table(edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    # a checked, small edge list needs no exchange: one partition meets
    # every grouping and join below; a longer one is shuffled
    few = now.count() <= FEW_EDGES
    seen = None
    while True:
        now = now.coalesce(1) if few else now
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        both = both.coalesce(1) if few else both
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # after a large star every edge points down: u > v
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select("u", F.explode(F.array(
            F.struct(F.col("u").alias("p"), F.col("m").alias("q")),
            F.struct(F.col("v").alias("p"), F.col("m").alias("q")))).alias("e")).select(
            F.col("e.p").alias("u"), F.col("e.q").alias("v")).where("u <> v")
        now = stage_table(small.distinct(), "edges")
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast(
            "decimal(38,0)"))).first())
        if mark == seen or mark[0] == 0:
            break
        seen = mark
    tops = now.select(F.col("v").alias("id")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        tops.select("id", F.col("id").alias("component")))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                percent: int = 85, miss: float = MISS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document.

    Links reach ``100 * intersection >= percent * union``.
    """
    return decide(docs, id_col, text_col, percent, miss).drop("text_key", "component")


def decide(docs: DataFrame, id_col: str, text_col: str, percent: int, miss: float = MISS
           ) -> DataFrame:
    """``near_groups`` with ``text_key``, a hash of the text, and a number of
    the ``component``: two of them can have one id that other texts share."""
    rows = stage_table(sketch(docs, id_col, text_col, percent), "sketches")
    sets = rows.where("n_shingles > 0 and doc_id is not null")
    # a class is numbered apart from ids, which other texts may share
    reps = stage_table(sets.groupBy("digest").agg(F.min("doc_id").alias("rep")).withColumn(
        "class", F.monotonically_increasing_id()), "classes")
    classes = stage_table(
        sets.join(reps.withColumnRenamed("rep", "doc_id"), ["doc_id", "digest"])
        .dropDuplicates(["class"]).select(F.col("class").alias("doc_id"), F.col("doc_id").alias(
            "rep"), "n_shingles", "digest", "lanes", "keys"), "class-sketches")
    # buckets of two classes or more
    buckets = classes.select("doc_id", F.explode("keys").alias("key"))
    order = [F.struct(F.xxhash64("doc_id", F.lit(i)).alias("o"), F.col("doc_id").alias("p"))
             for i in range(PIVOTS)]
    pivots = buckets.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), *[F.min(o)["p"].alias(f"p{i}") for i, o in enumerate(order)])
    pivots = pivots.where("n > 1").select("key", "n", F.array_distinct(F.array(
        *[f"p{i}" for i in range(PIVOTS)])).alias("pivots"))
    members = stage_table(buckets.join(pivots, "key"), "members")
    pairs = members.select(F.col("doc_id"), F.explode("pivots").alias("p")).where("doc_id <> p")
    pairs = stage_table(pairs.select(F.least("doc_id", "p").alias("a"),
                                     F.greatest("doc_id", "p").alias("b")).distinct(), "pairs")
    links = stage_table(verify(pairs, classes, docs, id_col, text_col, percent, miss), "links")
    found = stage_table(components(links), "components")
    # members apart from their bucket's main component
    named = members.select("key", "n", "doc_id").join(
        found.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "key", "n", "doc_id", F.coalesce("component", "doc_id").alias("c"))
    named = stage_table(named, "bucket-components")
    mixed = named.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    mixed = mixed.where("lo <> hi").select("key")
    mixed = stage_table(named.join(mixed, "key", "left_semi"), "mixed-buckets")
    small = mixed.where(F.col("n") <= SMALL)
    apart = small.select("key", F.col("doc_id").alias("a"), F.col("c").alias("ca")).join(
        small.select("key", F.col("doc_id").alias("b"), F.col("c").alias("cb")), "key").where(
        "a < b and ca <> cb").select("a", "b").distinct()
    apart = stage_table(apart.join(pairs, ["a", "b"], "left_anti"), "pairs-apart")
    large = mixed.where(F.col("n") > SMALL)
    more = None
    if not apart.isEmpty():
        more = verify(apart, classes, docs, id_col, text_col, percent, miss)
    if not large.isEmpty():
        items = full_sets(large.select(F.col("doc_id").alias("id")).distinct(), classes, docs,
                          id_col, text_col)
        inside = links_in_blocks(large, items, percent)
        more = inside if more is None else more.unionByName(inside)
    more = links.limit(0) if more is None else stage_table(more, "more-links")
    if not more.isEmpty():
        found = stage_table(components(found.select(
            F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more)),
            "components")
    classed = stage_table(reps.join(found, reps["class"] == found["id"], "left").select(
        "digest", "rep", F.coalesce("component", "class").alias("component")), "class-components")
    lowest = classed.groupBy("component").agg(F.min("rep").alias("component_id"))
    classed = classed.join(lowest, "component").select("digest", "component", "component_id")
    slim = rows.select("doc_id", "text_key", "n_shingles", "digest")
    linked = slim.where("n_shingles > 0 and doc_id is not null").join(classed, "digest").select(
        "doc_id", "text_key", "n_shingles", "component", "component_id")
    alone = slim.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", "text_key", "n_shingles", F.lit(None).cast("long").alias("component"),
        F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = 85) -> DataFrame:
    """The documents that stay, with all their columns: one of each group,
    and all documents without words or id.

    Rows go by id and text.  Of rows of a group that share the id that stays,
    the one with the least hash of its text stays, and of equal ones, one.
    """
    groups = stage_table(decide(docs, id_col, text_col, percent), "near-groups")
    stays = groups.where("kept and component is not null")
    shared = stage_table(stays.groupBy("component").agg(
        F.count(F.lit(1)).alias("rows"), F.min("text_key").alias("first"),
        F.first("doc_id").alias("shared_id")).where("rows > 1"), "shared-ids")
    gone = groups.where("not kept").select("doc_id", "text_key")
    again = not shared.isEmpty()
    if again:
        gone = gone.unionByName(stays.join(shared, "component").where("text_key <> first").select(
            "doc_id", "text_key"))
    gone = stage_table(gone.distinct().toDF("gone_id", "gone_key"), "near-copies")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    rows = nest(docs, id=F.col(id_col).cast("long"), key=F.xxhash64(text_col))
    left = rows.join(gone, (F.col("id") == F.col("gone_id")) & (F.col("key") == F.col("gone_key")),
                     "left_anti")
    if again:
        hit = (F.col("id") == F.col("shared_id")) & (F.col("key") == F.col("first"))
        alike = left.join(shared, hit, "left_semi")
        left = left.join(shared, hit, "left_anti").unionByName(alike.dropDuplicates(["id", "key"]))
    return unnest(left, docs.columns)
