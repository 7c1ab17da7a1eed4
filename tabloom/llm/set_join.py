"""N-gram Jaccard join by rare-first prefix filtering.

The global order of shingles is by document frequency, then by hash.  Two
sets with similarity t or more share a shingle among the first
``n - ceil(t * n) + 1`` of each (its prefix), so only prefixes are joined.

1. ``screen``: shingles of one document only come first in that order and
   meet nothing.  Tasks send 32-bit fingerprints of their shingles, each
   once per chunk of documents, to buckets of the hash space; buckets return
   how many of a document's shingles are shared.  A document whose prefix
   is full of unshared ones has no partner and goes no further (a clash of
   fingerprints can only keep a document).
2. Equal sets of the rest are one class.  Frequencies of classes' shingles
   are counted exactly; ``heads`` holds every class's shared shingles in the
   global order.
3. ``postings``: the shared shingles in the prefixes.  Shingles found in the
   same classes would join the same pairs, so one of them stands for all.
4. Postings meet in groups by shingle and size: sizes are binned by powers
   of 1 / t, so partners lie in one bin or in neighbouring ones (the length
   filter as a join key).  Small groups are joined to pairs; of a pair that
   shares the shingles at indices i and j of their heads, no more than
   ``min(i, j) + 1 + min(rest, rest')`` shingles can be common (positional
   filter), nor more than ``min(i, j) + 1`` and the sum over segments of the
   hash space of the lesser count after i and j (suffix filter).  The pairs
   left are made distinct and each is decided once on the whole heads.
5. Large groups never become pairs: they are cut into blocks, every two
   blocks meet in one group, and a kernel applies the filters, leaves a pair
   to the first group both belong to, and returns each member's number of
   links and a spanning forest of them.

Defined cases: null text is empty; documents without words are linked with
nothing; rows with a null id take no part (component null, no links); rows
that repeat an id are compared each with its own text; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import spread, stage_table
from tabloom.llm.near_dedup import BROADCAST_IDS, components, set_digest, shingle_set

CHUNK = 1 << 20          # shingles that a screening task sends at a time
BUCKET_BYTES = 16 << 20  # fingerprints of a bucket, about
LEAST_BUCKETS = 64
SEGMENTS = 32            # of the hash space, for the suffix filter
GROUP = 64               # members of a group that is joined to pairs
BLOCK = 1024             # members of a block of a larger group, at most
BLOCK_ITEMS = 1 << 20    # and their shingles, about


def prefix_length(n, percent: int):
    """n - ceil(percent / 100 * n) + 1, in whole numbers."""
    return n - (n * percent + 99) // 100 + 1


# ------------------------------------------------------------- 1. screening
def fingerprints(docs: DataFrame, buckets: int) -> DataFrame:
    """A row per chunk (bucket -1: its documents) and a row per chunk and
    bucket: ``body``, fingerprints that one document of the chunk has, in
    document order; ``ends``, where each document's end; ``many``,
    fingerprints that more than one document of the chunk has."""
    bits = max(buckets - 1, 1).bit_length()
    schema = pa.schema([("bucket", pa.int32()), ("seq", pa.int64()), ("ids", pa.list_(pa.int64())),
                        ("given", pa.list_(pa.bool_())), ("n", pa.list_(pa.int64())),
                        ("digest", pa.list_(pa.binary())), ("shared", pa.list_(pa.int64())),
                        ("body", pa.binary()), ("ends", pa.binary()), ("many", pa.binary())])

    def send(seq: int, ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
        n = np.array([len(s) for s in sets], dtype=np.int64)
        owner = np.repeat(np.arange(len(sets)), n)
        items = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
        # sets are sorted: a stable sort by item keeps the documents' order
        order = np.argsort(items, kind="stable")
        sorted_items = items[order]
        first = np.ones(len(items), dtype=bool)
        first[1:] = sorted_items[1:] != sorted_items[:-1]
        run = np.cumsum(first) - 1
        uses = np.bincount(run, minlength=run[-1] + 1 if len(run) else 0)
        once = np.zeros(len(items), dtype=bool)
        once[order] = uses[run] == 1
        shared = n - np.bincount(owner[once], minlength=len(sets))
        rows: list[list] = [[-1], [seq], [[i or 0 for i in ids]], [[i is not None for i in ids]],
                            [n], [[set_digest(s) for s in sets]], [shared], [None], [None], [None]]
        single, whose = items[once], owner[once]
        repeated = sorted_items[first][uses > 1]
        at = (single >> np.uint64(64 - bits)).astype(np.int64)
        # bucket by bucket, in document order
        order = np.lexsort((whose, at))
        mark = ((single[order] << np.uint64(bits)) >> np.uint64(32)).astype("<u4")
        at, whose = at[order], whose[order]
        rep_at = (repeated >> np.uint64(64 - bits)).astype(np.int64)
        rep_mark = ((repeated << np.uint64(bits)) >> np.uint64(32)).astype("<u4")
        edges = np.searchsorted(at, np.arange((1 << bits) + 1))
        rep_edges = np.searchsorted(rep_at, np.arange((1 << bits) + 1))
        for b in range(1 << bits):
            lo, hi, rlo, rhi = edges[b], edges[b + 1], rep_edges[b], rep_edges[b + 1]
            if hi > lo or rhi > rlo:
                ends = np.cumsum(np.bincount(whose[lo:hi], minlength=len(sets))).astype("<u4")
                for column, value in zip(rows, (b, seq, None, None, None, None, None,
                                                mark[lo:hi].tobytes(), ends.tobytes(),
                                                rep_mark[rlo:rhi].tobytes())):
                    column.append(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        sets: list[np.ndarray] = []
        size = seq = 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                sets.append(shingle_set(text))
                size += len(sets[-1])
                if size >= CHUNK:
                    yield send(seq, ids, sets)
                    ids, sets, size, seq = [], [], 0, seq + 1
        if ids:
            yield send(seq, ids, sets)

    rows = docs.mapInArrow(
        run, "bucket int, seq long, ids array<long>, given array<boolean>, n array<long>, "
             "digest array<binary>, shared array<long>, body binary, ends binary, many binary")
    # a task's chunks are numbered, tasks by their partition; frozen by staging
    return rows.withColumn("chunk", F.concat_ws("-", F.spark_partition_id(), "seq")).drop("seq")


def _shared_counts(pdf: pd.DataFrame) -> pd.DataFrame:
    """By chunk: documents and how many of their single fingerprints another
    chunk has too."""
    bodies = [np.frombuffer(b, "<u4") for b in pdf["body"]]
    manys = [np.frombuffer(b, "<u4") for b in pdf["many"]]
    seen, uses = np.unique(np.concatenate(bodies + [np.unique(b) for b in manys] * 2),
                           return_counts=True)
    shared = seen[uses > 1]
    out = []
    for chunk, body, ends in zip(pdf["chunk"], bodies, pdf["ends"]):
        if not len(body) or not len(shared):
            continue
        at = np.minimum(np.searchsorted(shared, body), len(shared) - 1)
        hits = np.r_[0, np.cumsum(shared[at] == body)]
        per = np.diff(hits[np.r_[0, np.frombuffer(ends, "<u4")]])
        docs = np.flatnonzero(per)
        if len(docs):
            out.append((chunk, docs.astype("<u4").tobytes(), per[docs].astype("<u4").tobytes()))
    return pd.DataFrame(out, columns=["chunk", "docs", "hits"])


def screen(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, n, digest, alive (may have a partner) of every row."""
    chars = docs.agg(F.sum(F.char_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, math.ceil(chars / 6 * 4 / BUCKET_BYTES))
    sent = stage_table(fingerprints(spread(docs), buckets), "fingerprints")
    hits = sent.where("bucket >= 0").select("bucket", "chunk", "body", "ends", "many").groupBy(
        "bucket").applyInPandas(_shared_counts, "chunk string, docs binary, hits binary")
    chunks = sent.where("bucket = -1").select("chunk", "ids", "given", "n", "digest", "shared")

    def decide(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame(columns=["doc_id", "n", "digest", "alive"])
        r = rows.iloc[0]
        n, shared = np.array(r["n"]), np.array(r["shared"])
        for at, count in zip(found["docs"], found["hits"]):
            shared[np.frombuffer(at, "<u4")] += np.frombuffer(count, "<u4")
        given = np.array(r["given"], dtype=bool)
        ids = pd.Series(np.array(r["ids"], dtype=np.int64), dtype="Int64").where(given)
        alive = (n > 0) & (n - shared < prefix_length(n, percent)) & given
        return pd.DataFrame({"doc_id": ids, "n": n, "digest": list(r["digest"]), "alive": alive})

    return chunks.groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInPandas(
        decide, "doc_id long, n long, digest binary, alive boolean")


# ------------------------------------------------------------ 2. heads
def class_sets(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(cid, n, items) of classes (cid, digest, rep, ...): sets made anew."""
    ids = stage_table(classes.select(F.col("rep").alias("id")).distinct(), "class-ids")
    needed = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = docs.join(needed, docs["doc_id"] == needed["id"], "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shingle_set(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([set_digest(s) for s in got], pa.binary()),
                 pa.array([s.view(np.int64) for s in got], pa.list_(pa.int64()))],
                names=["rep", "digest", "items"])

    found = texts.mapInArrow(sets, "rep long, digest binary, items array<long>")
    return found.join(classes.select("cid", "n", "rep", "digest"), ["rep", "digest"]) \
        .select("cid", "n", "items").dropDuplicates(["cid"])


def heads(sets: DataFrame) -> DataFrame:
    """(cid, n, head): each class's shingles that other classes have too, as
    (df, s) in the global order; classes without any are left out."""
    tokens = sets.select("cid", "n", F.explode("items").alias("s"))
    shared = stage_table(tokens.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1"),
                         "shared-shingles")
    return tokens.join(shared, "s").groupBy("cid").agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "s"))).alias("head"))


# ---------------------------------------------------------- 3. postings
def segment_counts(s: np.ndarray) -> np.ndarray:
    return np.bincount((s.astype(np.uint64) >> np.uint64(59)).astype(np.int64), minlength=SEGMENTS)


def postings(tops: DataFrame, percent: int) -> DataFrame:
    """(s, cid, n, i, rest, tail): shared shingles in the prefixes; index in
    the head, shingles after it, and their number by segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], [], [], []]
            for cid, n, head in zip(*(c.to_pylist() for c in batch.columns)):
                # the n - len(head) unshared shingles come first
                left = prefix_length(n, percent) - (n - len(head))
                s = np.array([t["s"] for t in head], dtype=np.int64)
                counts = segment_counts(s)
                for i in range(min(max(left, 0), len(head))):
                    counts = counts - segment_counts(s[i:i + 1])
                    for column, value in zip(cols, (int(s[i]), cid, n, i, len(head) - i - 1,
                                                    counts.tolist())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int32()),
                 pa.array(cols[4], pa.int32()), pa.array(cols[5], pa.list_(pa.int32()))],
                names=["s", "cid", "n", "i", "rest", "tail"])

    return tops.select("cid", "n", "head").mapInArrow(
        run, "s long, cid long, n long, i int, rest int, tail array<int>")


def one_per_list(found: DataFrame) -> DataFrame:
    """Of shingles with the same classes, the postings of one."""
    lists = found.groupBy("s").agg(
        F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("cid")).alias("x"),
        F.bit_xor(F.xxhash64("cid", F.lit(5))).alias("y")).where("m > 1")
    kept = lists.groupBy("m", "x", "y").agg(F.min("s").alias("s")).select("s")
    return found.join(kept, "s", "left_semi")


def grouped(found: DataFrame, percent: int) -> DataFrame:
    """Postings by group (s, g): size bins g (``low``) and g + 1."""
    bin_ = F.floor(F.log(F.col("n").cast("double")) / F.lit(-math.log(percent / 100)) + 1e-9)
    both = found.withColumn("bin", bin_.cast("int"))
    both = both.withColumn("g", F.explode(F.array(F.col("bin"), F.col("bin") - 1)))
    return both.withColumn("low", F.col("bin") == F.col("g")).drop("bin")


# ------------------------------------------------------ 4. small groups
def need(n_a, n_b, percent: int):
    """Fewest common shingles that reach the threshold."""
    return -((-percent * (n_a + n_b)) // (100 + percent))


def small_pairs(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs of small groups that pass all three filters."""
    def side(x: str) -> DataFrame:
        return members.select("s", "g", *[F.col(c).alias(f"{c}_{x}") for c in (
            "cid", "low", "n", "i", "rest", "tail")])

    met = side("a").join(side("b"), ["s", "g"]).where(
        "(low_a and low_b and cid_a < cid_b) or (low_a and not low_b)")
    met = met.where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    needed = F.ceil(F.lit(percent) * (F.col("n_a") + F.col("n_b")) / F.lit(100 + percent) - 1e-9)
    before = F.least("i_a", "i_b") + 1
    met = met.where(before + F.least("rest_a", "rest_b") >= needed)
    after = F.aggregate(F.zip_with("tail_a", "tail_b", lambda x, y: F.least(x, y)),
                        F.lit(0), lambda t, x: t + x)
    met = met.where(before + after >= needed)
    return met.select(F.least("cid_a", "cid_b").alias("a"),
                      F.greatest("cid_a", "cid_b").alias("b")).distinct()


def verify(pairs: DataFrame, tops: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets reach the threshold; shingles outside the heads
    are in one class only, so heads decide."""
    side = tops.select("cid", "n", F.col("head.s").alias("items"))
    both = (pairs.join(side.toDF("a", "n_a", "items_a"), "a")
            .join(side.toDF("b", "n_b", "items_b"), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            keep = []
            for n_a, n_b, x, y in zip(t["n_a"].to_pylist(), t["n_b"].to_pylist(),
                                      t["items_a"], t["items_b"]):
                common = len(np.intersect1d(x.values.to_numpy(), y.values.to_numpy(),
                                            assume_unique=True))
                keep.append(100 * common >= percent * (n_a + n_b - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "n_a", "n_b", "items_a", "items_b").mapInArrow(
        run, "a long, b long")


# ------------------------------------------------------ 5. large groups
def block_links(s: int, pdf: pd.DataFrame, i: int, j: int, percent: int
                ) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(links of each member, a spanning forest of the links) among the
    members of one or two blocks, pairs of earlier groups left out."""
    n = pdf["n"].to_numpy(dtype=np.int64)
    weight = pdf["weight"].to_numpy(dtype=np.int64)
    at, rest = pdf["i"].to_numpy(dtype=np.int64), pdf["rest"].to_numpy(dtype=np.int64)
    low, own, cid = pdf["low"].to_numpy(bool), pdf["own"].to_numpy(), pdf["cid"].to_numpy()
    m = len(pdf)
    ok = low[:, None] | low[None, :]
    if i != j:
        ok &= own[:, None] != own[None, :]
    np.fill_diagonal(ok, False)
    ok &= 100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :])
    needed = need(n[:, None], n[None, :], percent)
    before = np.minimum(at[:, None], at[None, :]) + 1
    ok &= before + np.minimum(rest[:, None], rest[None, :]) >= needed
    tail = np.array(pdf["tail"].tolist(), dtype=np.int32).reshape(m, SEGMENTS)
    after = np.zeros((m, m), dtype=np.int32)
    for k in range(SEGMENTS):
        after += np.minimum(tail[:, k][:, None], tail[:, k][None, :])
    ok &= before + after >= needed

    def common(sets: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((m, m), dtype=np.float32)
        size = np.array([len(v) for v in sets])
        names, column, uses = np.unique(np.concatenate(sets), return_inverse=True,
                                        return_counts=True)
        owner, keep = np.repeat(np.arange(m), size), uses[column] > 1
        column = (np.cumsum(uses > 1) - 1)[column[keep]]
        owner = owner[keep]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        for lo in range(0, int(column.max(initial=-1)) + 1, 4096):
            part = slice(*np.searchsorted(column, [lo, lo + 4096]))
            x = np.zeros((m, 4096), dtype=np.float32)
            x[owner[part], column[part] - lo] = 1
            out += x @ x.T
        return out

    # a pair that a small group joins, or that meets at an earlier shingle
    earlier = [np.r_[np.asarray(a, dtype=np.int64), h[h < s]] for a, h in zip(
        pdf["small"], (np.asarray(h, dtype=np.int64) for h in pdf["large"]))]
    if ok.any():
        ok &= common(earlier) == 0
    if ok.any():
        both = common([np.asarray(v, dtype=np.int64) for v in pdf["items"]])
        ok &= 100 * both >= percent * (n[:, None] + n[None, :] - both)
    links = ok @ weight
    unseen = np.ones(m, dtype=bool)
    edges = []
    for root in range(m):
        reached = [root] if unseen[root] else []
        unseen[root] = False
        for x in reached:
            new = np.flatnonzero(ok[x] & unseen)
            unseen[new] = False
            reached += new.tolist()
            edges += [(int(cid[x]), int(cid[y])) for y in new]
    return links, edges


def large_links(members: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Rows (cid, links, null, null) and (null, null, a, b) of large groups.

    ``members``: postings by group with ``m``, the group's size; ``known``:
    cid, g, weight, items and the shingles of its small and large groups in
    the bin g, which is the same in all groups where a pair meets.
    """
    size = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(
        F.lit(BLOCK_ITEMS) * F.pow(F.lit(percent / 100), F.col("g") + 2)))).cast("int")
    blocks = F.ceil(F.col("m") / size).cast("int")
    dealt = members.withColumn("own", F.pmod(F.xxhash64("cid", F.lit(7)), blocks).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("s", "g", F.least("own", "other").alias("a"),
                         F.greatest("own", "other").alias("b"), "own", "cid", "n", "i", "rest",
                         "tail", "low").join(known, ["cid", "g"])

    def kernel(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        links, edges = block_links(int(key[0]), pdf, int(key[2]), int(key[3]), percent)
        some = np.flatnonzero(links)
        out = [(int(pdf["cid"].iloc[x]), int(links[x]), None, None) for x in some]
        out += [(None, None, a, b) for a, b in edges]
        return pd.DataFrame(out, columns=["cid", "links", "a", "b"], dtype=object)

    return dealt.groupBy("s", "g", "a", "b").applyInPandas(
        kernel, "cid long, links long, a long, b long")


# --------------------------------------------------------------- the join
def join_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links: one row per document.

    Documents link when ``100 * intersection >= percent * union``;
    ``n_links`` counts the documents linked with one directly.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    profile = stage_table(screen(rows, percent), "set-profile")
    classes = profile.where("alive").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.count(F.lit(1)).alias("weight"))
    classes = stage_table(classes.withColumn("cid", F.monotonically_increasing_id()), "set-classes")
    tops = stage_table(heads(stage_table(class_sets(classes, rows), "class-sets")), "heads")
    found = stage_table(one_per_list(stage_table(postings(tops, percent), "postings")), "lists")
    members = grouped(found, percent)
    sizes = members.groupBy("s", "g").agg(F.count(F.lit(1)).alias("m"),
                                          F.bool_or("low").alias("any_low")).where("m > 1 and any_low")
    members = stage_table(members.join(sizes.drop("any_low"), ["s", "g"]), "groups")
    pairs = small_pairs(members.where(F.col("m") <= GROUP), percent)
    links = stage_table(verify(stage_table(pairs, "set-pairs"), tops, percent), "set-links")
    weights = classes.select("cid", "weight")
    counts = links.join(weights.toDF("b", "w"), "b").select(F.col("a").alias("cid"), "w").unionByName(
        links.join(weights.toDF("a", "w"), "a").select(F.col("b").alias("cid"), "w"))
    edges = links
    large = members.where(F.col("m") > GROUP)
    if not large.isEmpty():
        in_large = large.select("cid", "g").distinct()
        small = F.col("m") <= GROUP
        known = members.join(in_large, ["cid", "g"], "left_semi").groupBy("cid", "g").agg(
            F.collect_set(F.when(small, F.col("s"))).alias("small"),
            F.collect_set(F.when(~small, F.col("s"))).alias("large"))
        known = known.join(weights, "cid").join(
            tops.select("cid", F.col("head.s").alias("items")), "cid")
        more = stage_table(large_links(large, known, percent), "large-links")
        counts = counts.unionByName(more.where("cid is not null").select(
            "cid", F.col("links").alias("w")))
        edges = edges.unionByName(more.where("a is not null").select("a", "b"))
    counts = counts.groupBy("cid").agg(F.sum("w").alias("linked"))
    found = components(edges)
    reached = classes.join(found, classes["cid"] == found["id"], "left").select(
        "cid", "digest", "rep", "weight", F.coalesce("component", "cid").alias("component"))
    reached = stage_table(reached, "class-components")
    lowest = reached.groupBy("component").agg(F.min("rep").alias("component_id"))
    classed = reached.join(lowest, "component").join(counts, "cid", "left").select(
        "digest", "component_id",
        (F.col("weight") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    slim = profile.select("doc_id", F.col("n").alias("n_shingles"), "digest", "alive")
    linked = slim.where("alive").join(classed, "digest").select(
        "doc_id", "n_shingles", "component_id", "n_links")
    return linked.unionByName(slim.where("not alive").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"),
        F.lit(0).cast("long").alias("n_links")))
