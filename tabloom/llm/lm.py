"""Log-bilinear language model, trained by noise-contrastive estimation.

Units: the ``heads`` most frequent tokens each, and the other words by their
last three bytes in ``classes`` classes.  The model predicts the next unit
from the ``CONTEXT`` tokens before it (a diagonal matrix per position), with
logits ``h . q + bias`` that one matrix product normalises over all units:

    log10 P(w | history) = log10 softmax(h Q' + b)[unit(w)] + log10 P(w | unit)

Inside a class, P(w | unit) is the training count less an absolute discount
over the class's tokens; the discounts sum to the class's one outcome for
unknown words.  So the probabilities of all training words and the classes'
unknown outcomes sum to 1 after every history.

Every text is split once: chunks of documents are staged as numbers of their
own vocabularies, from which words are counted, weights trained and texts
scored.  All training documents count words and train weights.  Tasks train
on their rows from common weights; Spark averages the weights by tokens; two rounds
take one half of the rows each.  The ``frequent`` words travel with the job
(a bounded table); counts of all other words, whose number grows with the
corpus, stay a distributed table and are joined to the words of documents.

Defined cases: null text is empty and scores its end token; a null id is a
training row (its text counts as empty for the hash); repeated rows are
scored each; without training rows every word is unknown; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import spread, stage_table

END = b""            # the end token; no word is empty
CONTEXT = 3
DIM = 24
HEADS = 80           # output units that are one token
CLASSES = 48         # output units by word ending
INPUTS = 4096        # tokens with an input vector of their own
FREQUENT = 1 << 17   # words that travel with the job
NOISE = 48
BATCH = 4096
RATE = 0.15
ROUNDS = 2
FLUSH = 300_000      # words a counting task holds at a time
SCORE_BLOCK = 8192


def words(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased (bytes.lower is ASCII only)."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def held_out(id_col: Column) -> Column:
    text = F.coalesce(id_col.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 7 == 2


class Numbers(dict):
    """Numbers new tokens in the order they come; the end token is 0."""

    def __missing__(self, w: bytes) -> int:
        self[w] = n = len(self)
        return n


CODED = ("ids array<long>, given array<boolean>, held array<boolean>, part array<int>, "
         "vocab binary, n binary, tokens binary")


def code_tokens(rows: DataFrame) -> DataFrame:
    """Chunks of documents, each text split once: ``vocab``, the chunk's
    words; ``n``, tokens by document; ``tokens``, their positions in the
    vocabulary after the end token, 0.  ``rows``: doc_id, text, held, part."""
    names = [f.split()[0] for f in CODED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, held, part in _chunks(batches, 1):
            vocab = Numbers({END: 0})
            flat: list[int] = []
            n = []
            for text in texts:
                ws = words(text)
                flat.extend(map(vocab.__getitem__, ws))
                flat.append(0)
                n.append(len(ws) + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([[i or 0 for i in ids]], pa.list_(pa.int64())),
                 pa.array([[i is not None for i in ids]], pa.list_(pa.bool_())),
                 pa.array([held], pa.list_(pa.bool_())), pa.array([part], pa.list_(pa.int32())),
                 pa.array([b" ".join(vocab)], pa.binary()),
                 pa.array([np.array(n, dtype="<i8").tobytes()], pa.binary()),
                 pa.array([np.array(flat, dtype="<i4").tobytes()], pa.binary())], names=names)

    return rows.mapInArrow(run, CODED)


class Chunk:
    """One row of ``code_tokens``."""

    def __init__(self, row: dict):
        self.ids = [i if g else None for i, g in zip(row["ids"], row["given"])]
        self.held, self.part = np.array(row["held"], dtype=bool), np.array(row["part"])
        self.vocab = [END, *row["vocab"].split()]
        self.n = np.frombuffer(row["n"], "<i8")
        self.tokens = np.frombuffer(row["tokens"], "<i4")

    def of(self, docs: np.ndarray) -> np.ndarray:
        """The tokens of these documents (a mask)."""
        return self.tokens[np.repeat(docs, self.n)]


def coded_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Chunk({n: batch.column(n)[i].as_py() for n in batch.schema.names})


def count_tokens(coded: DataFrame) -> DataFrame:
    """(w, c) over the training documents; each task counts before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
                names=["w", "c"])

        for chunk in coded_chunks(batches):
            uses = np.bincount(chunk.of(~chunk.held), minlength=len(chunk.vocab)).tolist()
            for w, c in zip(chunk.vocab, uses):
                if c:
                    found[w] = found.get(w, 0) + c
            if len(found) > FLUSH:
                yield out()
                found.clear()
        yield out()

    return coded.mapInArrow(run, "w binary, c long").groupBy("w").agg(F.sum("c").alias("c"))


def _class_of(w: bytes) -> int:
    return zlib.crc32(w[-3:]) % CLASSES


class Codes(dict):
    """Token -> code; a word that isn't frequent gets its class's code."""

    def __init__(self, frequent: list[bytes]):
        super().__init__((w, i) for i, w in enumerate(frequent))
        self.n = len(frequent)

    def __missing__(self, w: bytes) -> int:
        return self.n + _class_of(w)


class Vocabulary:
    """Frequent tokens with counts, and class totals: all of bounded size."""

    def __init__(self, frequent: list[bytes], counts: list[int], total: int, distinct: int,
                 class_stats: dict[int, tuple[int, int, int, int]]):
        self.frequent, self.total, self.distinct = frequent, total, distinct
        n = len(frequent)
        cls = np.array([_class_of(w) for w in frequent], dtype=np.int64)
        heads = min(HEADS, n)
        self.heads = heads
        self.units = heads + CLASSES
        of = np.concatenate([cls, np.arange(CLASSES)]).astype(np.int64)
        self.out_of = heads + of
        self.out_of[:heads] = np.arange(heads)
        inputs = min(INPUTS, n)
        self.in_of = inputs + of
        self.in_of[:inputs] = np.arange(inputs)
        self.start = inputs + CLASSES
        self.n_inputs = inputs + CLASSES + 1
        # totals, discounts and unknown shares of the classes
        self.size, self.cut = np.zeros(CLASSES), np.full(CLASSES, 0.5)
        types = np.zeros(CLASSES)
        for k, (size, kinds, n1, n2) in class_stats.items():
            self.size[k], types[k] = size, kinds
            self.cut[k] = min(max(n1 / (n1 + 2 * n2), 0.05), 0.95) if n1 else 0.5
        known = self.size > 0
        self.log_unknown = np.zeros(CLASSES)
        self.log_unknown[known] = np.log10(self.cut[known] * types[known] / self.size[known])
        c = np.array(counts, dtype=np.float64)
        inside = np.zeros(n)
        if n > heads:
            k = cls[heads:]
            inside[heads:] = np.log10((c[heads:] - self.cut[k]) / self.size[k])
        self.log_inside = inside
        self.log_base = np.log10((c + 1) / (total + distinct + 1))
        unit = np.full(self.units, 0.5)
        unit[:heads] += c[:heads]
        unit[heads:] += self.size
        self.unit_share = unit / unit.sum()


def vocabulary(counts: DataFrame, frequent: int = FREQUENT) -> Vocabulary:
    top = counts.orderBy(F.col("c").desc(), "w").limit(frequent).toPandas()
    tokens = [bytes(w) for w in top["w"]]
    total, distinct = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    heads = tokens[:HEADS]
    rest = counts.where(~F.col("w").isin([F.lit(h) for h in heads])) if heads else counts
    stats = rest.groupBy(class_column(F.col("w")).alias("k")).agg(
        F.sum("c"), F.count(F.lit(1)), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2))
    by = {int(r[0]): tuple(int(x or 0) for x in r[1:]) for r in stats.collect()}  # CLASSES rows
    return Vocabulary(tokens, top["c"].tolist(), int(total or 0), int(distinct or 0), by)


def class_column(w: Column) -> Column:
    return (F.crc32(F.substring(w, -3, 3)) % CLASSES).cast("int")


class Weights:
    """Input vectors, output vectors, biases and the context matrices, as
    the rows of one table of DIM columns."""

    def __init__(self, v: Vocabulary, rows: np.ndarray | None = None):
        self.n_in, self.n_out = v.n_inputs, v.units
        if rows is None:
            rng = np.random.default_rng(7)
            rows = np.zeros((self.n_rows(v), DIM), dtype=np.float32)
            rows[:self.n_in + self.n_out] = rng.normal(0, 0.1, (self.n_in + self.n_out, DIM))
            rows[self.n_in + self.n_out:self.n_in + self.n_out + CONTEXT] = 1 / CONTEXT
            flat = np.zeros(rows[self.n_in + self.n_out + CONTEXT:].size, dtype=np.float32)
            flat[:self.n_out] = np.log(v.unit_share)
            rows[self.n_in + self.n_out + CONTEXT:] = flat.reshape(-1, DIM)
        self.rows = rows
        a, b, c = self.n_in, self.n_in + self.n_out, self.n_in + self.n_out + CONTEXT
        self.r, self.q, self.c = rows[:a], rows[a:b], rows[b:c]
        self.bias = rows[c:].reshape(-1)[:self.n_out]

    @staticmethod
    def n_rows(v: Vocabulary) -> int:
        return v.n_inputs + v.units + CONTEXT + -(-v.units // DIM)


def _sum_rows(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows that occur, sums of their values)."""
    index = index.astype(np.int16 if index.max(initial=0) < 1 << 15 else np.int32)
    order = index.argsort(kind="stable")
    index = index[order]
    starts = np.flatnonzero(np.diff(index, prepend=-1))
    return index[starts].astype(np.int64), np.add.reduceat(values[order], starts, axis=0)


def train_batch(w: Weights, g: np.ndarray, ins: np.ndarray, ctx: np.ndarray, target: np.ndarray,
                start: int, share: np.ndarray, rng: np.random.Generator) -> None:
    """One NCE step with noise shared by the batch; ``g``: AdaGrad sums;
    ``ins``: the tokens' own input rows; ``start``: the row before a text."""
    noise = rng.choice(len(share), NOISE, p=share)
    vec = [w.r[ctx[:, k]] for k in range(CONTEXT)]      # batch, DIM each
    h = sum(v * w.c[k] for k, v in enumerate(vec))
    qt, qn = w.q[target], w.q[noise]
    log_k = np.log(NOISE * share).astype(np.float32)
    st = (h * qt).sum(axis=1) + (w.bias - log_k)[target]
    sn = h @ qn.T + (w.bias - log_k)[noise]
    gt = -1 / (1 + np.exp(np.clip(st, -30, 30)))       # sigma(st) - 1
    np.clip(sn, -30, 30, out=sn)
    np.negative(sn, out=sn)
    np.exp(sn, out=sn)
    sn += 1
    gn = np.reciprocal(sn, out=sn)
    gh = gt[:, None] * qt + gn @ qn
    grad = np.zeros_like(w.rows)
    a, b, c = w.n_in, w.n_in + w.n_out, w.n_in + w.n_out + CONTEXT
    rows, sums = _sum_rows(np.concatenate([target, noise]),
                           np.concatenate([gt[:, None] * h, gn.T @ h]))
    grad[a + rows] = sums
    grad[b:c] = np.stack([(v * gh).sum(axis=0) for v in vec])
    bias = np.bincount(target, gt, w.n_out)
    bias += np.bincount(noise, gn.sum(axis=0), w.n_out)
    flat = grad[c:].reshape(-1)
    flat[:w.n_out] = bias
    # most contexts are tokens of the batch: add up by position, then by row
    places, far, far_at = np.zeros_like(h), [], []
    for k in range(CONTEXT):
        value = gh * w.c[k]
        inside = ctx[:, k] != start
        far.append(value[~inside].sum(axis=0, keepdims=True))
        far_at.append([start])
        head = np.flatnonzero(inside[:k + 1])
        far.append(value[head])
        far_at.append(ctx[head, k])
        value[~inside] = 0
        places[:max(len(h) - k - 1, 0)] += value[k + 1:]
    rows, sums = _sum_rows(np.concatenate([ins, *far_at]), np.concatenate([places, *far]))
    grad[rows] = sums
    g += grad * grad
    w.rows -= RATE * grad / np.sqrt(g + 1e-6)


def _sequences(n: np.ndarray, code: np.ndarray, v: Vocabulary) -> np.ndarray:
    """The contexts, as input rows, of documents of n tokens with these codes."""
    out = np.empty((len(code), CONTEXT), dtype=np.int32)
    ins = v.in_of[code].astype(np.int32)
    first = np.cumsum(n) - n
    for k in range(1, CONTEXT + 1):
        out[k:, k - 1] = ins[:-k] if len(ins) > k else ins[:0]
        out[:k, k - 1] = v.start
    for k in range(1, CONTEXT + 1):
        # the first k tokens of a document have fewer than k before them
        for j in range(k):
            at = first[n > j] + j
            out[at, k - 1] = v.start
    return out


def _codes(chunk: Chunk, codes: Codes) -> np.ndarray:
    return np.array([codes[w] for w in chunk.vocab], dtype=np.int32)


def _chunks(batches: Iterator[pa.RecordBatch], column: int, chars: int = 1 << 20):
    """Lists of rows of about ``chars`` characters."""
    for batch in batches:
        cols = [c.to_pylist() for c in batch.columns]
        lo, size = 0, 0
        for i, text in enumerate(cols[column]):
            size += len(text or "")
            if size >= chars or i + 1 == len(cols[column]):
                yield [c[lo:i + 1] for c in cols]
                lo, size = i + 1, 0


def train_round(coded: DataFrame, part: int, sent, weights) -> np.ndarray | None:
    """Average of the tasks' weights after one pass over the training
    documents of this part, by their tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = sent.value
        codes = Codes(v.frequent)
        w = Weights(v, weights.value.copy())
        g = np.zeros_like(w.rows)
        rng = np.random.default_rng(11)
        seen = 0
        for chunk in coded_chunks(batches):
            docs = ~chunk.held & (chunk.part == part)
            if not docs.any():
                continue
            code = _codes(chunk, codes)[chunk.of(docs)]
            ctx = _sequences(chunk.n[docs], code, v)
            ins, target = v.in_of[code], v.out_of[code]
            seen += len(code)
            for lo in range(0, len(code), BATCH):
                at = slice(lo, lo + BATCH)
                train_batch(w, g, ins[at], ctx[at], target[at], v.start, v.unit_share, rng)
        if seen:
            out = (w.rows.astype(np.float64) * seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(out)), pa.int64()),
                 pa.array(np.full(len(out), seen), pa.int64()),
                 *(pa.array(out[:, j]) for j in range(DIM))],
                names=["row", "seen", *(f"x{j}" for j in range(DIM))])

    fields = ", ".join(f"x{j} double" for j in range(DIM))
    sums = coded.mapInArrow(run, f"row long, seen long, {fields}").groupBy("row").agg(
        F.sum("seen").alias("seen"), *[F.sum(f"x{j}").alias(f"x{j}") for j in range(DIM)])
    got = sums.toPandas().sort_values("row")  # as many rows as the model has
    if not len(got):
        return None
    return (got[[f"x{j}" for j in range(DIM)]].to_numpy() / got["seen"].to_numpy()[:, None]
            ).astype(np.float32)


def fit(coded: DataFrame, sent, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of a model of ``sent``'s vocabulary, from coded chunks."""
    sc = coded.sparkSession.sparkContext
    rows = Weights(sent.value).rows
    for k in range(rounds):
        new = train_round(coded, k, sent, sc.broadcast(rows))
        rows = rows if new is None else new
    return rows


def unit_log10(w: Weights, ctx: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """Normalised log10 probabilities, in blocks of matrix products."""
    out = np.empty(len(unit))
    for lo in range(0, len(unit), SCORE_BLOCK):
        part = ctx[lo:lo + SCORE_BLOCK]
        h = sum(w.r[part[:, k]] * w.c[k] for k in range(CONTEXT))
        z = h @ w.q.T
        z += w.bias
        z -= z.max(axis=1, keepdims=True)
        pick = z[np.arange(len(z)), unit[lo:lo + SCORE_BLOCK]].astype(np.float64)
        np.exp(z, out=z)
        out[lo:lo + SCORE_BLOCK] = pick - np.log(z.sum(axis=1, dtype=np.float64))
    return out / math.log(10)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    sc = docs.sparkSession.sparkContext
    rows = spread(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
        held_out(F.col(id_col)).alias("held"),
        F.pmod(F.xxhash64(text_col), F.lit(ROUNDS)).cast("int").alias("part")))
    coded = stage_table(code_tokens(rows), "coded-tokens")
    counts = stage_table(count_tokens(coded), "word-counts")
    v = vocabulary(counts)
    sent = sc.broadcast(v)
    weights = sc.broadcast(fit(coded, sent))
    total, distinct = v.total, v.distinct

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = sent.value
        codes = Codes(v.frequent)
        w = Weights(v, weights.value)
        n_frequent = len(v.frequent)
        inside = np.concatenate([v.log_inside, np.zeros(CLASSES)])
        base = np.concatenate([v.log_base, np.zeros(CLASSES)])
        for chunk in coded_chunks(batches):
            code = _codes(chunk, codes)[chunk.tokens]
            first = np.cumsum(chunk.n) - chunk.n
            value = unit_log10(w, _sequences(chunk.n, code, v), v.out_of[code]) + inside[code]
            known = code < n_frequent
            # words that do not travel: distinct ones of each document
            rare = np.flatnonzero(~known)
            wide = len(chunk.vocab)
            doc = np.searchsorted(first, rare, side="right") - 1
            key, times = np.unique(doc * wide + chunk.tokens[rare], return_counts=True)
            ends = np.searchsorted(key // wide, np.arange(len(chunk.n) + 1)).astype(np.int32)
            names = pa.array([chunk.vocab[i] for i in key % wide], pa.binary())
            yield pa.RecordBatch.from_arrays([
                pa.array(chunk.ids, pa.int64()), pa.array(chunk.held), pa.array(chunk.n),
                pa.array(np.add.reduceat(known.astype(np.int64), first)),
                pa.array(np.add.reduceat(base[code], first)),
                pa.array(np.add.reduceat(value, first)),
                pa.ListArray.from_arrays(pa.array(ends), names),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(times.astype(np.int32)))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score",
                       "rare", "times"])

    scored = coded.mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
             "score double, rare array<binary>, times array<int>")
    scored = stage_table(scored.withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    # words that do not travel with the job: their counts are joined
    uses = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("u")).select(
        "row", F.col("u.rare").alias("w"), F.col("u.times").alias("t"))
    found = uses.join(counts, "w", "left")
    k = class_column(F.col("w"))
    cut, size, unknown = (F.array(*[F.lit(float(x)) for x in a]) for a in (
        v.cut, np.maximum(v.size, 1), v.log_unknown))
    at = k + 1
    seen = F.col("c").isNotNull()
    inside = F.when(seen, F.log10((F.col("c") - F.element_at(cut, at)) / F.element_at(size, at))
                    ).otherwise(F.element_at(unknown, at))
    base = F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(total + distinct + 1)))
    more = found.groupBy("row").agg(
        F.sum(F.when(seen, F.col("t")).otherwise(0)).alias("k"),
        F.sum(base * F.col("t")).alias("b"), F.sum(inside * F.col("t")).alias("s"))
    zero = F.lit(0)
    return scored.drop("rare", "times").join(more, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("k", zero)).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("b", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("s", zero)).alias("score"))
