"""DBSCAN (C3) of one or many settings over the same passes.

Points lie in blocks of near ones; pairs of blocks whose bounding boxes are
further apart than the largest ``eps`` are never formed.  Each pair of
blocks meets three times, however long the chains of points are, and a
pair's distances are computed once for all settings (eps, min_samples):

1. the weight within eps of every point, which tells the core points;
2. inside every block the components of its core points, then, between
   blocks, a spanning forest of those components: the edges of a graph of
   block components, which ``connected`` closes;
3. for every point that is no core point, the first cluster with a core
   point within eps.

Clusters are numbered from 0 by their smallest point id; a border point
takes the smallest number (the reference takes the first cluster its scan
reaches; core points, noise and the number of clusters do not depend on
that); other points are noise (-1).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators import blocks as B
from tabloom.operators.columns import col
from tabloom.operators.graphs import connected, numbered
from tabloom.session import cut_lineage

CHUNK = 512
COMP_BITS = 13      # a block's components
BLOCK_BITS = 32


def merge_duplicates(df: DataFrame, id_col: str, features: list[str],
                     weight: str | None = None) -> DataFrame:
    """Equal rows as one point: smallest id ``pid``, summed weight ``w``."""
    w = F.lit(1.0) if weight is None else col(weight).cast("double")
    return df.groupBy(*[(col(f).cast("double") + F.lit(0.0)).alias(f) for f in features]).agg(
        F.min(col(id_col)).cast("long").alias("pid"), F.sum(w).alias("w"))


def near_blocks(points: DataFrame, features: list[str], eps: float, rows: int = B.ROWS
                ) -> B.Blocks:
    """Blocks of points that follow one another by cells of side eps."""
    cells = [F.floor(col(f) / eps) for f in features]
    parts = max(1, points.sparkSession.sparkContext.defaultParallelism)
    order = points.repartitionByRange(parts, *cells).sortWithinPartitions(*cells, "pid")
    return B.pack(order, features, "pid", "w", rows)


def _codes(a: B.Block, b: B.Block, levels: np.ndarray) -> np.ndarray:
    """How many of the rising ``levels`` each squared distance exceeds."""
    out = np.zeros((a.m, b.m), dtype=np.uint8)
    for lo in range(0, a.m, CHUNK):
        x = a.x[lo:lo + CHUNK]
        d2 = np.zeros((len(x), b.m))
        for j in range(x.shape[1]):
            gap = x[:, j][:, None] - b.x[:, j][None, :]
            gap *= gap
            d2 += gap
        for level in levels:
            out[lo:lo + CHUNK] += d2 > level
    return out


def _forest(adjacent: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of rows and columns (numbered after the rows)."""
    n, m = adjacent.shape
    unseen_r, unseen_c = np.ones(n, dtype=bool), np.ones(m, dtype=bool)
    edges = []
    for root in range(n):
        if not unseen_r[root]:
            continue
        unseen_r[root] = False
        todo = [root]
        for v in todo:
            if v < n:
                new = np.flatnonzero(adjacent[v] & unseen_c)
                unseen_c[new] = False
                new = new + n
            else:
                new = np.flatnonzero(adjacent[:, v - n] & unseen_r)
                unseen_r[new] = False
            edges += [(v, int(y)) for y in new]
            todo += new.tolist()
    return edges


def _components(adjacent: np.ndarray) -> np.ndarray:
    """Component numbers of a symmetric boolean matrix."""
    out = np.full(len(adjacent), -1, dtype=np.int32)
    unseen, n = np.ones(len(adjacent), dtype=bool), 0
    for root in range(len(adjacent)):
        if unseen[root]:
            unseen[root] = False
            todo = [root]
            for v in todo:
                out[v] = n
                new = np.flatnonzero(adjacent[v] & unseen)
                unseen[new] = False
                todo += new.tolist()
            n += 1
    return out


def _or_by(rows: np.ndarray, group: np.ndarray, axis: int) -> np.ndarray:
    order = np.argsort(group, kind="stable")
    starts = np.flatnonzero(np.diff(group[order], prepend=-1))
    return np.logical_or.reduceat(np.take(rows, order, axis=axis), starts, axis=axis)


def density_clusters(blocks: B.Blocks, settings: list[tuple[float, float]]) -> B.Blocks:
    """Blocks with one label per setting (eps, min_samples)."""
    eps = np.array([e for e, _ in settings])
    least = np.array([m for _, m in settings])
    levels, place = np.unique(eps * eps, return_inverse=True)
    t, reach = len(settings), float(eps.max())
    if len(levels) > 250:
        raise ValueError("at most 250 different eps at a time")

    # 1. core points
    def weights(a: B.Block, b: B.Block) -> list[tuple]:
        code = _codes(a, b, levels).astype(np.int64)
        width = len(levels) + 1

        def within(mine: np.ndarray, m: int, w: np.ndarray) -> bytes:
            got = np.bincount(mine.ravel(), w, m * width).reshape(m, width)
            return np.cumsum(got, axis=1)[:, place].tobytes()

        rows = code + (np.arange(a.m) * width)[:, None]
        out = [(a.id, b.id, within(rows, a.m, np.broadcast_to(b.w[None, :], code.shape).ravel()))]
        if a.id != b.id:
            rows = code + (np.arange(b.m) * width)[None, :]
            out.append((b.id, a.id, within(rows, b.m, np.broadcast_to(
                a.w[:, None], code.shape).ravel())))
        return out

    sums = B.sum_states(B.tiles(blocks, weights, "block long, other long, v binary", reach), blocks)

    # 2. components inside blocks: labels are local numbers, -1 for no core
    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for b, v in zip(B.iterate(iter([batch])), batch.column("v").to_pylist()):
                core = np.frombuffer(v, "<f8").reshape(b.m, t) >= least
                code = _codes(b, b, levels)
                local = np.full((b.m, t), -1, dtype="<i4")
                for s in range(t):
                    mine = np.flatnonzero(core[:, s])
                    if len(mine):
                        local[mine, s] = _components(code[np.ix_(mine, mine)] <= place[s])
                got.append(local.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in ("block", "m", "ids", "w", "x")] + [
                    pa.array(got, pa.binary())], names=["block", "m", "ids", "w", "x", "labels"])

    local = blocks.with_table(cut_lineage(blocks.table.join(sums, "block").select(
        "block", "m", "ids", "w", "x", "v").mapInArrow(inside, B.FIELDS + ", labels binary")))

    def node(block: int, s, comp):
        return (np.int64(s) << (BLOCK_BITS + COMP_BITS)) + (np.int64(block) << COMP_BITS) + comp

    def across(a: B.Block, b: B.Block) -> list[tuple]:
        if a.id == b.id:
            return []
        code, out = _codes(a, b, levels), []
        for s in range(t):
            i, j = np.flatnonzero(a.labels[:, s] >= 0), np.flatnonzero(b.labels[:, s] >= 0)
            if not len(i) or not len(j):
                continue
            ga, gb = a.labels[i, s], b.labels[j, s]
            near = _or_by(_or_by(code[np.ix_(i, j)] <= place[s], ga, 0), gb, 1)
            n = len(near)
            for u, v in _forest(near):
                u, v = min(u, v), max(u, v) - n
                out.append((int(node(a.id, s, u)), int(node(b.id, s, v))))
        return out

    edges = B.tiles(local, across, "a long, b long", reach)
    closed = connected(edges)

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in B.iterate(batches):
            found: list[tuple] = []
            for s in range(t):
                mine = np.flatnonzero(b.labels[:, s] >= 0)
                if len(mine):
                    low = np.full(b.labels[mine, s].max() + 1, np.iinfo(np.int64).max)
                    np.minimum.at(low, b.labels[mine, s], b.ids[mine])
                    found += [(b.id, s, c, int(node(b.id, s, c)), int(v))
                              for c, v in enumerate(low)]
            cols = list(zip(*found)) if found else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                 pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int64()),
                 pa.array(cols[4], pa.int64())], names=["block", "s", "comp", "node", "low"])

    every = local.table.mapInArrow(nodes, "block long, s int, comp int, node long, low long")
    every = cut_lineage(every.join(closed, F.col("node") == F.col("id"), "left").select(
        "block", "s", "comp", "low", F.coalesce("component", "node").alias("root")))
    roots = numbered(every.groupBy("s", "root").agg(F.min("low").alias("low")), ["s", "low"])
    base = roots.groupBy("s").agg(F.min("number").alias("base"))
    roots = roots.join(base, "s").select("s", "root", (F.col("number") - F.col("base")).cast(
        "int").alias("number"))
    named = every.join(roots, ["s", "root"]).groupBy("block").agg(
        F.collect_list(F.struct("s", "comp", "number")).alias("named"))

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for b, names in zip(B.iterate(iter([batch])), batch.column("named").to_pylist()):
                final = np.full((b.m, t), -1, dtype="<i4")
                table: list[dict[int, int]] = [{} for _ in range(t)]
                for r in names or ():
                    table[r["s"]][r["comp"]] = r["number"]
                for s in range(t):
                    if table[s]:
                        to = np.array([table[s][c] for c in range(len(table[s]))], dtype="<i4")
                        mine = b.labels[:, s] >= 0
                        final[mine, s] = to[b.labels[mine, s]]
                got.append(final.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in ("block", "m", "ids", "w", "x")] + [
                    pa.array(got, pa.binary())], names=["block", "m", "ids", "w", "x", "labels"])

    core = blocks.with_table(cut_lineage(local.table.join(named, "block", "left").mapInArrow(
        rename, B.FIELDS + ", labels binary")))

    # 3. border points
    def border(a: B.Block, b: B.Block) -> list[tuple]:
        code = _codes(a, b, levels)

        def lowest(mine: np.ndarray, theirs: np.ndarray, code: np.ndarray) -> bytes:
            out = np.full(mine.shape, np.inf)
            for s in range(t):
                i, j = np.flatnonzero(mine[:, s] < 0), np.flatnonzero(theirs[:, s] >= 0)
                if len(i) and len(j):
                    near = code[np.ix_(i, j)] <= place[s]
                    out[i, s] = np.where(near, theirs[j, s][None, :].astype(float), np.inf).min(
                        axis=1)
            return out.tobytes()

        return [(a.id, b.id, lowest(a.labels, b.labels, code))] + (
            [(b.id, a.id, lowest(b.labels, a.labels, code.T))] if a.id != b.id else [])

    lows = B.sum_states(B.tiles(core, border, "block long, other long, v binary", reach), core,
                        merge=np.minimum)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for b, v in zip(B.iterate(iter([batch])), batch.column("v").to_pylist()):
                low = np.frombuffer(v, "<f8").reshape(b.m, t)
                got.append(np.where((b.labels < 0) & np.isfinite(low), np.where(
                    np.isfinite(low), low, 0), b.labels).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in ("block", "m", "ids", "w", "x")] + [
                    pa.array(got, pa.binary())], names=["block", "m", "ids", "w", "x", "labels"])

    return blocks.with_table(cut_lineage(core.table.join(lows, "block").mapInArrow(
        finish, B.FIELDS + ", labels binary")))
