"""Approximate nearest neighbours on robust-pruned directed graphs.

Equal vectors are one node (their ids ride along, as many as a query can
return), so a vector that a third of the rows share cannot fill the graph
with ties.  Nodes are dealt by hash into shards of about ``shard_rows``; each
shard builds its own graph: nodes join in batches of growing size, a greedy
beam search over the graph so far proposes neighbours, relaxed distance
pruning (keep p, drop every c with alpha * d(p, c) <= d(node, c)) keeps
diverse edges, and edges are added backwards and pruned again.  A second
round repeats the search over the finished graph.  Queries go in blocks to
every shard, are answered by beam search, and the shards' best are merged
with exact double-precision distances.

Defined cases: vectors that are null, zero, of another length than the
query, or hold null or non-finite components take no part, as query or as
candidate; equal distances go to the smaller id; null ids take no part;
repeated ids are reported once per row; fewer candidates than ``k`` are all
returned; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import stage_table

SHARD_ROWS = 4096
QUERY_BLOCK = 2048
DEGREE = 32
BUILD_BEAM = 48
SEARCH_BEAM = 100
ALPHA = 1.2


def _distances(x: np.ndarray, rows: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distances of to[i] to x[rows[i, j]]."""
    d = x[rows] - to[:, None, :]
    return np.einsum("ijk,ijk->ij", d, d)


def beam_search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, entry: np.ndarray,
                beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, squared distances) of each query's beam, nearest first.

    All queries advance together: each expands its nearest unexpanded node.
    ``graph`` holds -1 for missing edges.
    """
    q = len(queries)
    ids = np.full((q, beam), -1, dtype=np.int64)
    dist = np.full((q, beam), np.inf, dtype=x.dtype)
    e = min(len(entry), beam)
    ids[:, :e] = entry[:e]
    dist[:, :e] = _distances(x, np.broadcast_to(entry[:e], (q, e)), queries)
    done = np.ones((q, beam), dtype=bool)
    done[:, :e] = False
    # a byte per query and node; blocks of queries and shards bound it
    seen = np.zeros((q, len(x)), dtype=bool)
    seen[:, entry[:e]] = True
    live = np.arange(q)
    while len(live):
        d = np.where(done[live], np.inf, dist[live])
        best = d.argmin(axis=1)
        go = np.isfinite(d[np.arange(len(live)), best])
        live, best = live[go], best[go]
        if not len(live):
            break
        done[live, best] = True
        near = graph[ids[live, best]]
        fresh = (near >= 0) & ~seen[live[:, None], near]
        seen[live[:, None], np.where(near >= 0, near, ids[live, best][:, None])] = True
        nd = np.where(fresh, _distances(x, np.maximum(near, 0), queries[live]), np.inf)
        all_d = np.concatenate([dist[live], nd], axis=1)
        all_i = np.concatenate([ids[live], np.where(fresh, near, -1)], axis=1)
        all_done = np.concatenate([done[live], ~fresh], axis=1)
        top = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        r = np.arange(len(live))[:, None]
        dist[live], ids[live], done[live] = all_d[r, top], all_i[r, top], all_done[r, top]
    order = np.argsort(dist, axis=1, kind="stable")
    r = np.arange(q)[:, None]
    return ids[r, order], dist[r, order]


def robust_prune(x: np.ndarray, nodes: np.ndarray, cand: np.ndarray, dist: np.ndarray,
                 degree: int, alpha: float) -> np.ndarray:
    """(len(nodes), degree) edges from candidates (-1: none), diverse ones first kept."""
    dist = np.where((cand < 0) | (cand == nodes[:, None]), np.inf, dist)
    order = np.argsort(dist, axis=1, kind="stable")
    r = np.arange(len(nodes))
    cand, dist = cand[r[:, None], order], dist[r[:, None], order]
    same = np.zeros_like(cand, dtype=bool)
    same[:, 1:] = (cand[:, 1:] == cand[:, :-1])
    dist[same] = np.inf
    vec = x[np.maximum(cand, 0)]
    norm = np.einsum("ijk,ijk->ij", vec, vec)
    cross = norm[:, :, None] + norm[:, None, :] - 2 * np.matmul(vec, vec.transpose(0, 2, 1))
    open_ = np.isfinite(dist)
    out = np.full((len(nodes), degree), -1, dtype=np.int64)
    a2 = alpha * alpha
    for k in range(degree):
        pick = np.where(open_, dist, np.inf).argmin(axis=1)
        has = open_[r, pick]
        if not has.any():
            break
        out[has, k] = cand[r, pick][has]
        open_[r, pick] = False
        open_ &= ~(has[:, None] & (a2 * cross[r, pick] <= dist))
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM,
                alpha: float = ALPHA, rounds: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(graph, entry points): the node nearest the mean and a few far ones."""
    n = len(x)
    graph = np.full((n, degree), -1, dtype=np.int64)
    centre = ((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin()
    order = np.r_[centre, np.delete(np.arange(n), centre)]
    entry = np.array([centre])
    for turn in range(rounds):
        at, step = (1, 1) if turn == 0 else (0, 256)
        while at < n:
            nodes = order[at:at + step]
            ids, dist = beam_search(x, graph, x[nodes], entry, min(beam, n))
            own = graph[nodes]
            cand = np.concatenate([ids, own], axis=1)
            cd = np.concatenate([dist, np.where(
                own >= 0, _distances(x, np.maximum(own, 0), x[nodes]), np.inf)], axis=1)
            graph[nodes] = robust_prune(x, nodes, cand, cd, degree, alpha)
            _add_backward(x, graph, nodes, degree, alpha)
            at += step
            step = min(256, 2 * step)
    return graph, entry


def _add_backward(x, graph, nodes, degree, alpha) -> None:
    src = np.repeat(nodes, degree)
    dst = graph[nodes].ravel()
    src, dst = src[dst >= 0], dst[dst >= 0]
    known = (graph[dst] == src[:, None]).any(axis=1)
    src, dst = src[~known], dst[~known]
    if not len(dst):
        return
    order = np.argsort(dst, kind="stable")
    src, dst = src[order], dst[order]
    targets, first, count = np.unique(dst, return_index=True, return_counts=True)
    used = (graph[targets] >= 0).sum(axis=1)
    roomy = used + count <= degree
    slot = np.arange(len(dst)) - np.repeat(first, count) + np.repeat(used, count)
    ok = np.repeat(roomy, count)
    graph[dst[ok], slot[ok]] = src[ok]
    full = np.flatnonzero(~roomy)
    for lo in range(0, len(full), 256):
        part = full[lo:lo + 256]
        width = degree + int(count[part].max())
        cand = np.full((len(part), width), -1, dtype=np.int64)
        cand[:, :degree] = graph[targets[part]]
        for j, p in enumerate(part):
            cand[j, degree:degree + count[p]] = src[first[p]:first[p] + count[p]]
        at = targets[part]
        d = np.where(cand >= 0, _distances(x, np.maximum(cand, 0), x[at]), np.inf)
        graph[at] = robust_prune(x, at, cand, d, degree, alpha)


def _vectors(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column]) if len(column) else \
        np.zeros((0, 0))


def usable(vec: str) -> str:
    """SQL condition of a vector that takes part."""
    finite = (f"forall({vec}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    return f"{vec} is not null and {finite} and exists({vec}, x -> x <> 0)"


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id",
            vec_col: str = "embedding", k: int = 10, shard_rows: int = SHARD_ROWS,
            degree: int = DEGREE, build_beam: int = BUILD_BEAM, search_beam: int = SEARCH_BEAM,
            alpha: float = ALPHA, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest other rows."""
    def clean(df: DataFrame, name: str) -> DataFrame:
        df = df.select(F.col(id_col).cast("long").alias(name), F.col(vec_col).alias("vec"))
        return df.where(F.col(name).isNotNull()).where(usable("vec"))

    # equal vectors are one node; k + 1 ids are all that a query can use.
    # The rank limit runs before the shuffle too, so a hot vector moves few rows.
    rows = clean(vectors, "id").withColumn("hash", F.xxhash64("vec"))
    w = Window.partitionBy("hash", "vec").orderBy("id")
    first = rows.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= k + 1)
    nodes = stage_table(first.groupBy("hash", "vec").agg(
        F.sort_array(F.collect_list("id")).alias("ids")), "ann-nodes")
    n = nodes.count()
    shards = max(1, -(-n // shard_rows))
    nodes = nodes.withColumn("shard", F.pmod(F.xxhash64("hash"), F.lit(shards)))
    asked = clean(queries, "query_id")
    asked = stage_table(asked, "ann-queries")
    blocks = max(1, -(-asked.count() // query_block))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))

    def index(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in pdf.groupby(pdf["vec"].map(len)):
            part = part.reset_index(drop=True)
            x = _vectors(part["vec"]).astype(np.float32)
            graph, entry = build_graph(x, degree, build_beam, alpha)
            out.append(pd.DataFrame({
                "shard": part["shard"], "node": np.arange(len(x)), "entry": int(entry[0]),
                "vec": part["vec"], "ids": part["ids"],
                "edges": [e[e >= 0] for e in graph]}))
        return pd.concat(out)

    schema = (f"shard long, node long, entry long, vec {rows.schema['vec'].dataType.simpleString()},"
              " ids array<long>, edges array<long>")
    graph = stage_table(nodes.groupBy("shard").applyInPandas(index, schema), "ann-graph")

    def search(key, index_pdf: pd.DataFrame, asked_pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(index_pdf) and len(asked_pdf):
            lengths = asked_pdf["vec"].map(len)
            for dim, part in index_pdf.groupby(index_pdf["vec"].map(len)):
                q = asked_pdf[lengths == dim]
                if len(q):
                    out.append(_answer(part.sort_values("node"), q, k, degree, search_beam))
        return pd.concat(out) if out else pd.DataFrame(
            {"query_id": [], "vec_id": [], "score": []}).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    all_blocks = F.expr(f"explode(sequence(0L, {blocks - 1}L))")
    all_shards = F.expr(f"explode(sequence(0L, {shards - 1}L))")
    found = graph.withColumn("block", all_blocks).groupBy("shard", "block").cogroup(
        asked.withColumn("shard", all_shards).groupBy("shard", "block")).applyInPandas(
        search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _answer(part: pd.DataFrame, asked: pd.DataFrame, k: int, degree: int,
            beam: int) -> pd.DataFrame:
    exact = _vectors(part["vec"])
    x = exact.astype(np.float32)
    graph = np.full((len(x), degree), -1, dtype=np.int64)
    for i, e in enumerate(part["edges"]):
        graph[i, :len(e)] = e
    q = _vectors(asked["vec"])
    beam = max(beam, k + 1)
    got, _ = beam_search(x, graph, q.astype(np.float32), np.array([part["entry"].iloc[0]]), beam)
    members = part["ids"].to_list()
    qid, vid, score = [], [], []
    for i, query in enumerate(asked["query_id"]):
        near = got[i][got[i] >= 0]
        d = np.sqrt(((exact[near] - q[i]) ** 2).sum(axis=1))
        rows = sorted((s, int(m)) for s, node in zip(d.tolist(), near) for m in members[node]
                      if m != query)[:k]
        qid += [query] * len(rows)
        vid += [m for _, m in rows]
        score += [s for s, _ in rows]
    return pd.DataFrame({"query_id": np.array(qid, dtype=np.int64),
                         "vec_id": np.array(vid, dtype=np.int64),
                         "score": np.array(score, dtype=np.float64)})
