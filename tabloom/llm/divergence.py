"""Source divergence audit by iceberg prefix refinement.

Which terms of a language are frequent enough to compare is found without
counting its rare terms, which are most of them.  Level by level, prefixes
of 4, 8, 16, ... bytes are counted by distinct documents; prefixes below the
threshold are discarded, and only terms that extend a kept one are looked at
in the next level.  A term that ends within a level's length is counted
whole there.  The rounds end when no kept prefix is left to extend.

The kept prefixes of a level travel to the next as a bitmap of their hashes
of at most ``MOST_BITS`` bits: a false hit only lets a prefix be counted that
the next threshold discards, so the result is exact at any size.  Counts
are summed by task before each shuffle, and joined exactly to the kept terms.

The divergences are whole numbers.  Pairs of sources are summed in groups of
one term bucket and two source blocks, whose sizes are bounded; a group adds
only what its terms differ from a term that neither source has.

Defined cases: null text, language and source count as ''; a source without
kept terms has count 0 for all; a language without kept terms has value 0
for all its pairs and no term rows; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import spread, stage_table

FIRST_LEVEL = 4          # bytes of the first prefixes; each level doubles them
LEAST_DOCS = 10
MOST_BITS = 1 << 27      # of a bitmap: 16 MB
PIECE = 1 << 15          # bits of a bitmap that one group sets
CHUNK = 1 << 20          # tokens of the documents that are coded together
FLUSH = 500_000          # prefix counts that a task holds at a time
TRIPLES = 4_000_000      # and counts by source and term
TERM_BUCKET = 2048       # terms of a group of pair sums, about
SOURCE_BLOCK = 96        # and sources of each of its sides
UNIT = 1_000_000_000
OPEN = b"\0"             # ends a prefix; no term holds it

# Letters A-Z fold to a-z; ASCII that is no letter separates terms; every
# byte of a non-ASCII character belongs to one.
_FOLD = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20
              for c in (ord(chr(b).lower()) if b < 0x80 else b for b in range(256)))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Numbers(dict):
    """Numbers new keys in the order they come."""

    def __missing__(self, key) -> int:
        self[key] = n = len(self)
        return n


LISTS = ("lang string, vocab binary, ids binary, counts binary, ends binary, of binary, "
         "sources array<string>")


def term_lists(docs: DataFrame) -> DataFrame:
    """Chunks of documents of one language: ``vocab``, their distinct terms;
    ``ids`` and ``counts`` of each document's terms; ``ends``, where each
    document's stop; ``of``, each document's position in ``sources``."""
    names = [f.split()[0] for f in LISTS.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[Numbers, list, Numbers, list]] = {}
        size = 0

        def out(lang: str, vocab: Numbers, found: list, sources: Numbers, of: list
                ) -> pa.RecordBatch:
            ids = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
            wide = max(len(vocab), 1)
            doc = np.repeat(np.arange(len(found)), [len(f) for f in found])
            key, counts = np.unique(doc * wide + ids, return_counts=True)
            ends = np.searchsorted(key // wide, np.arange(len(found)), side="right")
            cells = [b" ".join(vocab), *(v.astype("<u4").tobytes() for v in (
                key % wide, counts, ends, np.array(of)))]
            return pa.RecordBatch.from_arrays(
                [pa.array([lang]), *(pa.array([c], pa.binary()) for c in cells),
                 pa.array([list(sources)], pa.list_(pa.string()))], names=names)

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                vocab, found, sources, of = held.setdefault(lang, (Numbers(), [], Numbers(), []))
                found.append(np.fromiter(map(vocab.__getitem__, terms(text)), np.int64))
                of.append(sources[source])
                size += len(found[-1]) + 1
                if size >= CHUNK:
                    for key, parts in held.items():
                        yield out(key, *parts)
                    held, size = {}, 0
        for key, parts in held.items():
            yield out(key, *parts)

    return spread(docs).mapInArrow(run, LISTS)


class Chunk:
    """One row of ``term_lists``."""

    def __init__(self, row: dict):
        self.lang, self.key = row["lang"], row["lang"].encode("utf-8", "surrogatepass")
        self.vocab = row["vocab"].split()
        self.ids = np.frombuffer(row["ids"], "<u4").astype(np.int64)
        self.counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
        ends = np.frombuffer(row["ends"], "<u4").astype(np.int64)
        self.of = np.frombuffer(row["of"], "<u4").astype(np.int64)
        self.doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        self.sources = row["sources"]


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Chunk({n: batch.column(n)[i].as_py() for n in batch.schema.names})


def _slot(lang: bytes, item: bytes, bits: int) -> int:
    return xxhash.xxh3_64_intdigest(lang + b"\0" + item) & (bits - 1)


class Bitmap:
    """Hashes of kept (lang, item)s; may say yes to others."""

    def __init__(self, bits: int, data: bytes):
        self.bits, self.data = bits, data
        self.asked: dict[bytes, dict[bytes, bool]] = {}

    def known(self, lang: bytes) -> dict[bytes, bool]:
        """Answers given so far, of a bounded number."""
        found = self.asked.setdefault(lang, {})
        if sum(map(len, self.asked.values())) > FLUSH:
            found.clear()
            self.asked = {lang: found}
        return found

    def has(self, lang: bytes, item: bytes) -> bool:
        at = _slot(lang, item, self.bits)
        return bool(self.data[at >> 3] >> (at & 7) & 1)


def bitmap(kept: DataFrame, rows: int) -> Bitmap:
    """Of the rows (lang, item); its pieces are built by separate groups."""
    bits = PIECE
    while bits < MOST_BITS and bits < 16 * rows:
        bits *= 2

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [_slot(lang.encode("utf-8", "surrogatepass"), item, bits)
                  for lang, item in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64())], names=["at"])

    def piece(pdf: pd.DataFrame) -> pd.DataFrame:
        at = pdf["at"].to_numpy()
        flags = np.zeros(PIECE, dtype=np.uint8)
        flags[at % PIECE] = 1
        return pd.DataFrame({"piece": [int(at[0]) // PIECE],
                             "data": [np.packbits(flags, bitorder="little").tobytes()]})

    at = kept.select("lang", "item").mapInArrow(slots, "at long").distinct()
    pieces = at.groupBy(F.expr(f"at div {PIECE}")).applyInPandas(piece, "piece long, data binary")
    data = bytearray(bits // 8)
    for r in pieces.collect():  # MOST_BITS at most
        data[r["piece"] * PIECE // 8:(r["piece"] + 1) * PIECE // 8] = r["data"]
    return Bitmap(bits, bytes(data))


def level_counts(lists: DataFrame, low: int, high: int, parents) -> DataFrame:
    """(lang, item, docs): distinct documents of terms of ``low`` + 1 to
    ``high`` bytes and of the open prefixes of ``high`` bytes (with a byte
    OPEN), where the prefix of ``low`` bytes was kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = parents.value if parents is not None else None
        counts: dict[str, dict[bytes, int]] = {}
        size = 0

        def out() -> pa.RecordBatch:
            langs = [k for k, c in counts.items() for _ in c]
            return pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()),
                 pa.array([i for c in counts.values() for i in c], pa.binary()),
                 pa.array([n for c in counts.values() for n in c.values()], pa.int64())],
                names=["lang", "item", "docs"])

        for c in chunks(batches):
            items = Numbers()
            item_of = np.full(len(c.vocab), -1, dtype=np.int64)
            known = kept.known(c.key) if kept is not None else None
            for i, t in enumerate(c.vocab):
                if len(t) <= low:
                    continue
                if known is not None:
                    head = t[:low]
                    ok = known.get(head)
                    if ok is None:
                        ok = known[head] = kept.has(c.key, head + OPEN)
                    if not ok:
                        continue
                item_of[i] = items[t if len(t) <= high else t[:high] + OPEN]
            if items:
                item = item_of[c.ids]
                mine = item >= 0
                pair = np.unique(c.doc[mine] * len(items) + item[mine])
                docs = np.bincount(pair % len(items), minlength=len(items)).tolist()
                counter = counts.setdefault(c.lang, {})
                size -= len(counter)
                for i, n in zip(items, docs):
                    counter[i] = counter.get(i, 0) + n
                size += len(counter)
            if size >= FLUSH:
                yield out()
                counts.clear()
                size = 0
        yield out()

    return lists.mapInArrow(run, "lang string, item binary, docs long").groupBy(
        "lang", "item").agg(F.sum("docs").alias("docs"))


def kept_terms(lists: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """(lang, term) of the terms in at least ``least`` documents of a language."""
    sc = lists.sparkSession.sparkContext
    low, high, parents, found = 0, FIRST_LEVEL, None, None
    while True:
        level = stage_table(level_counts(lists, low, high, parents).where(F.col("docs") >= least),
                            f"prefixes-{high}")
        open_ = F.expr("right(hex(item), 2) = '00'")
        whole = level.where(~open_).select("lang", F.col("item").alias("term"))
        found = whole if found is None else found.unionByName(whole)
        left = level.where(open_)
        rows = left.count()
        if not rows:
            return found
        parents = sc.broadcast(bitmap(left, rows))
        low, high = high, high * 2


def _merged(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(source, term, count) triples with equal keys added."""
    s, t, c = (np.concatenate([p[i] for p in parts]) for i in range(3))
    wide = int(t.max(initial=0)) + 1
    key, at = np.unique(s * wide + t, return_inverse=True)
    return key // wide, key % wide, np.bincount(at, c, len(key)).astype(np.int64)


def term_counts(lists: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, term, c): occurrences of the kept terms.

    Tasks add their chunks and send triples in buckets of terms."""
    sc = lists.sparkSession.sparkContext
    rows = kept.count()
    sent = sc.broadcast(bitmap(kept.withColumnRenamed("term", "item"), rows))
    buckets = max(32, rows // 1024)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = sent.value
        held: dict[str, list] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for lang, (names, sources, parts) in held.items():
                s, t, c = _merged(parts)
                words = list(names)
                bucket = np.array([zlib.crc32(w) % buckets for w in words])[t]
                order = np.argsort(bucket, kind="stable")
                s, t, c, bucket = s[order], t[order], c[order], bucket[order]
                edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
                for lo, hi in zip(edges, edges[1:]):
                    here, at = np.unique(t[lo:hi], return_inverse=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang]), pa.array([int(bucket[lo])], pa.int32()),
                         pa.array([b" ".join(words[i] for i in here)], pa.binary()),
                         pa.array([list(sources)], pa.list_(pa.string())),
                         *(pa.array([v.astype("<i8").tobytes()], pa.binary())
                           for v in (s[lo:hi], at, c[lo:hi]))],
                        names=["lang", "bucket", "words", "sources", "s", "t", "c"])

        for c in chunks(batches):
            names, sources, parts = held.setdefault(c.lang, (Numbers(), Numbers(), []))
            to = np.full(len(c.vocab), -1, dtype=np.int64)
            for i, t in enumerate(c.vocab):
                at = names.get(t)
                if at is not None:
                    to[i] = at
                elif marked.has(c.key, t):
                    to[i] = names[t]
            if not len(to):
                continue
            term = to[c.ids]
            mine = term >= 0
            of = np.array([sources[x] for x in c.sources], dtype=np.int64)[c.of]
            if mine.any():
                parts.append(_merged([(of[c.doc[mine]], term[mine], c.counts[mine])]))
                size += len(parts[-1][0])
            if size >= TRIPLES:
                yield from out()
                held, size = {}, 0
        held = {k: v for k, v in held.items() if v[2]}
        yield from out()

    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        names, sources, parts = Numbers(), Numbers(), []
        for r in pdf.to_dict("records"):
            of = np.array([sources[x] for x in r["sources"]], dtype=np.int64)
            to = np.array([names[t] for t in r["words"].split()], dtype=np.int64)
            parts.append((of[np.frombuffer(r["s"], "<i8")], to[np.frombuffer(r["t"], "<i8")],
                          np.frombuffer(r["c"], "<i8")))
        s, t, c = _merged(parts)
        words, names_of = np.array(list(names), dtype=object), np.array(list(sources), dtype=object)
        return pd.DataFrame({"lang": str(key[0]), "source": names_of[s], "term": words[t], "c": c})

    found = lists.mapInArrow(
        run, "lang string, bucket int, words binary, sources array<string>, s binary, t binary, "
             "c binary").groupBy("lang", "bucket").applyInPandas(
        add, "lang string, source string, term binary, c long")
    return found.join(kept, ["lang", "term"])


def share(count: Column | str, total: str = "n", kinds: str = "v") -> Column:
    """1 + floor(UNIT * (count + 2) / (total + 2 * kinds))."""
    return F.expr(f"1 + cast({UNIT} as decimal(10,0)) * cast({count} + 2 as decimal(20,0)) "
                  f"div cast({total} + 2 * {kinds} as decimal(20,0))")


def distance(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q))."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def pair_sums(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket of terms and the sources of one or two blocks: by pair,
    the sum of the terms' distances less that of absent terms.

    Rows without a term name the sources; the others hold p of a term."""
    names = pdf[pdf["term"].isna()]
    sources = names["source"].tolist()
    p0 = names["p"].to_numpy(dtype=np.int64)
    side = names["own"].to_numpy()
    rows = pdf[pdf["term"].notna()]
    at = rows["source"].map({s: i for i, s in enumerate(sources)}).to_numpy(dtype=np.int64)
    _, line = np.unique(rows["term"].to_numpy(dtype=object), return_inverse=True)
    p = np.repeat(p0[None], line.max(initial=-1) + 1, axis=0)
    p[line, at] = rows["p"].to_numpy(dtype=np.int64)
    one = int(names["a"].iloc[0]) == int(names["b"].iloc[0])
    out = []
    for i in range(len(sources)):
        others = np.flatnonzero((np.arange(len(sources)) > i) if one else (side > side[i]))
        if len(others):
            gap = p[:, [i]] - p[:, others]
            base = p0[i] - p0[others]
            sums = (gap * gap // (p[:, [i]] + p[:, others])
                    - base * base // (p0[i] + p0[others])).sum(axis=0)
            out += [(pdf["lang"].iloc[0], sources[i], sources[j], int(x))
                    for j, x in zip(others, sums)]
    return pd.DataFrame(out, columns=["lang", "source", "item", "value"])


def pair_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of a language's
    sources; ``groups``: lang, source, n, v, p0, sources."""
    side = F.ceil(F.col("sources") / SOURCE_BLOCK).cast("int")
    blocked = groups.withColumn("own", F.pmod(F.xxhash64("source"), side).cast("int"))
    blocked = blocked.withColumn("to", F.explode(F.sequence(F.lit(0), side - 1)))
    blocked = blocked.withColumn("a", F.least("own", "to")).withColumn("b", F.greatest("own", "to"))
    buckets = F.ceil(F.col("v") / TERM_BUCKET).cast("int")
    named = blocked.where("v > 0").select(
        "lang", F.explode(F.sequence(F.lit(0), buckets - 1)).alias("bucket"), "a", "b", "own",
        "source", F.lit(None).cast("binary").alias("term"), F.col("p0").alias("p"))
    held = counts.join(blocked, ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), buckets).cast("int").alias("bucket"), "a", "b", "own",
        "source", "term", share("c").alias("p"))
    sums = named.unionByName(held).groupBy("lang", "bucket", "a", "b").applyInPandas(
        pair_sums, "lang string, source string, item string, value long")
    sums = sums.select("lang", F.least("source", "item").alias("x"),
                       F.greatest("source", "item").alias("y"), "value").groupBy(
        "lang", "x", "y").agg(F.sum("value").alias("value"))
    both = sums.select("lang", F.col("x").alias("source"), F.col("y").alias("item"), "value")
    both = both.unionByName(sums.select("lang", F.col("y").alias("source"),
                                        F.col("x").alias("item"), "value"))
    # every pair of a language's sources is a row of the result
    left = groups.select("lang", "source", "v", F.col("p0").alias("p"))
    right = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q"))
    pairs = left.join(right, "lang").where("source <> item")
    absent = F.when(F.col("v") > 0, F.col("v") * distance("p", "q")).otherwise(F.lit(0))
    return pairs.join(both, ["lang", "source", "item"], "left").select(
        "lang", "source", "item", (F.coalesce("value", F.lit(0)) + absent).alias("value"))


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = 10, lang_col: str = "lang",
          source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: the source's distance to each other source of its
    language; part ``term``: the ``top`` terms that it uses more than its
    language does, by distance.
    """
    blank = F.lit("")
    rows = docs.select(F.coalesce(F.col(lang_col), blank).alias("lang"),
                       F.coalesce(F.col(source_col), blank).alias("source"),
                       F.col(text_col).alias("text"))
    lists = stage_table(term_lists(rows), "term-lists")
    kept = stage_table(kept_terms(lists, least), "kept-terms")
    counts = stage_table(term_counts(lists, kept), "term-counts")
    kinds = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    groups = lists.select("lang", F.explode("sources").alias("source")).distinct()
    sizes = counts.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    per_lang = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(
        kinds, "lang", "left").select("lang", "sources", F.coalesce("v", F.lit(0)).alias("v"))
    groups = groups.join(sizes, ["lang", "source"], "left").join(per_lang, "lang").select(
        "lang", "source", "sources", F.coalesce("n", F.lit(0)).alias("n"), "v")
    groups = stage_table(groups.withColumn("p0", F.when(F.col("v") > 0, share("0"))), "groups")
    pairs = pair_values(counts, groups)
    # the language as a whole
    whole = counts.groupBy("lang", "term").agg(F.sum("c").alias("c"))
    whole = whole.join(groups.groupBy("lang").agg(F.sum("n").alias("n"), F.first("v").alias("v")),
                       "lang").select("lang", "term", share("c").alias("q"))
    named = counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share("c").alias("p")).join(whole, ["lang", "term"])
    named = named.where("p > q").select("lang", "source", F.col("term").cast("string").alias("item"),
                                        distance("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")

    def ranked(df: DataFrame, part: str) -> DataFrame:
        return df.select("lang", "source", F.lit(part).alias("part"), "item",
                         F.col("value").cast("long"), F.row_number().over(order).alias("rank"))

    return ranked(pairs, "pair").unionByName(ranked(named, "term").where(F.col("rank") <= top))
