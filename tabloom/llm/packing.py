"""Token packing: overlong documents cut into full windows, the rest packed
by best-fit decreasing with a segment tree over remaining capacities.

``tokenise_pieces`` turns every text into token ids and cuts the ids into
pieces; whole windows fill a sequence each.  The other pieces are dealt at
random into groups of about ``group_pieces``; inside a group, pieces go in
decreasing length to the tightest open window that still holds them (a
segment tree over capacities 0..window counts open windows per capacity and
finds the smallest capacity at or above the length in log2(window) steps).
The number of groups grows with the corpus, a group's size does not.

Defined cases: null text is empty, and its document is the end token alone;
null ids stay; rows that repeat an id are packed each; an empty table gives
an empty result.  Ties in length go by document id, then start.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import spread, stage_table

WINDOW = 4096
GROUP_PIECES = 8192
CACHE_WORDS = 300_000  # entries of each worker's word cache; past it, words are encoded again

# Letters, digits and the rest in the ranges where Python's classes and the
# tokenizer's agree and lower-casing is one character to one.
_PLAIN = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-į]+")
_PARTS = re.compile(r"[^\W\d_]+|\d|'s|'t|'re|'ve|'m|'ll|'d|(?:_|[^\s\w])+")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes as themselves, the others
    from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: b for b in plain}
    out.update({b: 256 + k for k, b in enumerate(b for b in range(256) if b not in out)})
    return out


class WordEncoder:
    """Little-endian uint32 ids of a text, word by word through a cache.

    White space separates pre-tokens of this tokenizer and is dropped, so
    the ids of a text are those of its words in order.  Words outside the
    plain ranges go through the tokenizer itself.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.limit = cache_words

    def _part(self, part: str) -> bytes:
        got = self.parts.get(part)
        if got is None:
            got = np.array([t.id for t in self.model.tokenize(
                part.encode().decode("latin-1").translate(self.letters))], "<u4").tobytes()
            if len(self.parts) < self.limit:
                self.parts[part] = got
        return got

    def _word(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word) and "<|" not in word:
            got = b"".join([self._part(p) for p in _PARTS.findall(
                unicodedata.normalize("NFC", word).lower())])
        else:
            got = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids,
                           "<u4").tobytes()
        if len(self.words) < self.limit:
            self.words[word] = got
        return got

    def encode(self, text: str) -> bytes:
        get = self.words.get
        out = []
        for w in _SPACE.split(text):
            if w:
                got = get(w)
                out.append(self._word(w) if got is None else got)
        return b"".join(out)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def tokenise_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id",
                    text_col: str = "text", window: int = WINDOW, end_id: int = 2,
                    with_ids: bool = False) -> DataFrame:
    """doc_id, row_key, start, length, ids_crc32, doc_tokens (and ids).

    ``row_key`` tells apart rows that repeat an id.  Every document is cut
    into full windows and at most one shorter piece.
    """
    fields = [("doc_id", pa.int64()), ("row_key", pa.int64()), ("start", pa.int64()),
              ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
    schema = pa.schema(fields)
    ddl = ("doc_id long, row_key long, start long, length long, ids_crc32 long, doc_tokens long"
           + (", ids array<int>" if with_ids else ""))
    end = int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            out: list[list] = [[] for _ in fields]
            for doc, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = enc.encode(text or "") + end
                n = len(ids) // 4
                for start in range(0, n, window):
                    piece = ids[4 * start:4 * (start + window)]
                    row = [doc, key, start, len(piece) // 4, zlib.crc32(piece), n]
                    if with_ids:
                        row.append(np.frombuffer(piece, "<i4"))
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(out, schema)], schema=schema)

    rows = spread(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                              F.col(text_col).alias("text")))
    rows = rows.select("doc_id", F.monotonically_increasing_id().alias("row_key"), "text")
    return rows.mapInArrow(cut, ddl)


class CapacityTree:
    """Open windows by remaining capacity, as a segment tree of counts."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: dict[int, list[int]] = {}

    def add(self, capacity: int, which: int) -> None:
        self.open.setdefault(capacity, []).append(which)
        i = capacity + self.leaves
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove and return (capacity, window) of the tightest fit."""
        i, count = length + self.leaves, self.count
        if not count[i]:
            # up to the first right sibling that holds a window, then down left
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if count[2 * i] else 2 * i + 1
        capacity = i - self.leaves
        which = self.open[capacity].pop()
        while i:
            count[i] -= 1
            i >>= 1
        return capacity, which


def best_fit_decreasing(lengths, window: int) -> tuple[list[int], list[int]]:
    """(window number, offset) per length; lengths come in decreasing order."""
    tree, which, offset, opened = CapacityTree(window), [], [], 0
    for n in lengths:
        n = int(n)
        fit = tree.take(n)
        if fit is None:
            fit, opened = (window, opened), opened + 1
        which.append(fit[1])
        offset.append(window - fit[0])
        if fit[0] > n:
            tree.add(fit[0] - n, fit[1])
    return which, offset


def pack(pieces: DataFrame, window: int = WINDOW, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset; ``pieces`` is read twice, so stage it."""
    rest = pieces.where(F.col("length") < window)
    groups = max(1, -(-rest.count() // group_pieces))
    dealt = rest.withColumn("group", F.pmod(
        F.xxhash64("doc_id", "row_key", "start"), F.lit(groups)))
    cols = [c for c in pieces.columns]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "row_key", "start"],
                              ascending=[False, True, True, True], kind="stable")
        which, offset = best_fit_decreasing(pdf["length"].tolist(), window)
        base = int(pdf["group"].iloc[0]) << 24  # a group opens fewer windows than 2**24
        return pdf[cols].assign(sequence_id=2 * (base + np.array(which, dtype=np.int64)),
                                offset=np.array(offset, dtype=np.int64))

    filled = dealt.groupBy("group").applyInPandas(fill, ddl + ", sequence_id long, offset long")
    # full windows need no partner: each is a sequence, of an odd number
    full = pieces.where(F.col("length") >= window).withColumns({
        "sequence_id": 2 * F.monotonically_increasing_id() + 1, "offset": F.lit(0).cast("long")})
    return filled.unionByName(full)


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id",
                   text_col: str = "text", window: int = WINDOW, end_id: int = 2,
                   group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The packing plan: one row per piece, without the ids."""
    pieces = stage_table(tokenise_pieces(docs, tokenizer, id_col, text_col, window, end_id),
                         "pieces")
    return pack(pieces, window, group_pieces).drop("row_key")


def packed_sequences(docs: DataFrame, tokenizer: str, id_col: str = "doc_id",
                     text_col: str = "text", window: int = WINDOW, end_id: int = 2,
                     pad_id: int = 0, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The sequences themselves: sequence_id, input_ids (padded), n_tokens.

    One sequence holds at most ``window`` ids, so its group is bounded.
    """
    pieces = stage_table(tokenise_pieces(docs, tokenizer, id_col, text_col, window, end_id,
                                         with_ids=True), "pieces-with-ids")
    plan = pack(pieces.drop("ids"), window, group_pieces).select(
        "row_key", "start", "sequence_id", "offset")
    placed = plan.join(pieces.select("row_key", "start", "ids"), ["row_key", "start"])
    joined = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(
        F.struct("offset", "ids"))).alias("p"))
    ids = F.flatten(F.col("p.ids"))
    return joined.select("sequence_id", F.concat(ids, F.array_repeat(
        F.lit(int(pad_id)), F.lit(window) - F.size(ids))).alias("input_ids"),
        F.size(ids).cast("long").alias("n_tokens"))
