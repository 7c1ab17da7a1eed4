"""Mixing sources to target weights by systematic sampling (native Spark).

Each source's share of the wanted total is cut at ``max_repeat`` times its
size and the excess goes to the others by weight until none is above.  A
document of a source is expected ``target / source_size`` times; the prefix
sum of these expectations inside the source, plus one random offset, emits
a copy per integer boundary crossed, so a source's count of copies is within
one of its expectation.  The order of the prefix sum puts documents of like
size together (bands of half an octave, md5 of the id inside), so the words
taken follow the target too.

Prefix sums are cut in three: rows inside a small chunk of a source's band,
chunks inside the band, bands inside the source.  A source that holds a
third of all rows is spread over as many chunks as its rows need.

Defined cases: null text has size 0; null is a source of its own, ranked
last; a source of size 0 has target 0 and its documents are not taken (no
words either way); null ids are ordered first; rows that repeat an id are
documents of their own, each with its own copies; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.common import nest, stage_table, unnest, WORD_PATTERN

CHUNK_ROWS = 4096
OFFSET_STEPS = 1 << 20  # offsets are multiples of 2**-20: sums with counts stay exact


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def size_band(size: Column) -> Column:
    """Two bands an octave, in integers; grows with the size."""
    octave = F.lit(0)
    for k in range(1, 41):
        octave = octave + (size >= F.lit(1 << k)).cast("int")
    return F.when(size < 2, size).otherwise(
        octave.cast("long") * 4 + (size * 2 / F.pow(F.lit(2.0), octave)).cast("long"))


def source_targets(sizes: DataFrame, share: float, weights: tuple[float, ...],
                   max_repeat: float) -> DataFrame:
    """(source, source_size) -> with target; one row per source.

    Water filling in closed form: sources in order of cap per weight are
    full as long as the level that the rest would get reaches their cap.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    capped = sizes.withColumn("weight", w).withColumn("cap", F.col("source_size") * max_repeat)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    every = Window.partitionBy()
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    capped = (capped
              .withColumn("total", share * F.sum("source_size").over(every))
              .withColumn("full_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .withColumn("weight_all", F.sum("weight").over(every)))
    level = (F.col("total") - F.col("full_before")) / (F.col("weight_all") - F.col("weight_before"))
    # the first source that is not filled sets the level of all after it
    capped = capped.withColumn("level", level).withColumn(
        "open", F.col("weight") * F.col("level") < F.col("cap"))
    final = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("level"))))
    capped = capped.withColumn("at", final.over(every)["level"])
    return capped.select("source", "source_size", F.when(
        F.col("at").isNull(), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("weight") * F.col("at"))).cast("double").alias("target"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           source_col: str = "source", share: float = 1.5,
           weights: tuple[float, ...] = (3.0, 1.0, 2.0), max_repeat: float = 2.0,
           seed: int = 0) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken per document."""
    rows = stage_table(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        words(F.col(text_col)).alias("size")), "sizes")
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    n = rows.count()
    parts = max(1, -(-n // CHUNK_ROWS))
    rows = rows.select(
        "doc_id", "source", "size", size_band(F.col("size")).alias("band"), key.alias("key"),
        F.expr(f"(cast(conv(substr(md5(coalesce(cast(doc_id as string), '')), 1, 8), 16, 10)"
               f" as bigint) * {parts}) div 4294967296").alias("chunk"))
    # chunk sums, then where each chunk begins inside its source
    per_chunk = stage_table(rows.groupBy("source", "band", "chunk").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("s")), "chunks")
    per_band = per_chunk.groupBy("source", "band").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    before = Window.unboundedPreceding, -1
    in_source = Window.partitionBy("source").orderBy("band").rowsBetween(*before)
    targets = source_targets(per_band.groupBy("source").agg(F.sum("s").alias("source_size")),
                             share, weights, max_repeat)
    bands = per_band.select("source", "band", F.coalesce(F.sum("n").over(in_source), F.lit(0))
                            .alias("band_start"))
    t = targets.withColumnRenamed("source", "t_source")
    bands = bands.join(t, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    bands = bands.toDF("b_source", "b_band", *bands.columns[2:])
    in_band = Window.partitionBy("source", "band").orderBy("chunk").rowsBetween(*before)
    starts = per_chunk.select("source", "band", "chunk", F.coalesce(
        F.sum("n").over(in_band), F.lit(0)).alias("chunk_start"))
    starts = starts.join(bands, F.col("source").eqNullSafe(F.col("b_source"))
                         & (F.col("band") == F.col("b_band")))
    starts = stage_table(starts.select(
        F.col("source").alias("c_source"), F.col("band").alias("c_band"),
        F.col("chunk").alias("c_chunk"), (F.col("band_start") + F.col("chunk_start")).alias("start"),
        "source_size", "target"), "chunk-starts")
    in_chunk = Window.partitionBy("source", "band", "chunk").orderBy("key", "doc_id", "size")
    ranked = rows.withColumn("rank", F.row_number().over(in_chunk))
    placed = ranked.join(starts, F.col("source").eqNullSafe(F.col("c_source"))
                         & (F.col("band") == F.col("c_band")) & (F.col("chunk") == F.col("c_chunk")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = F.expr(f"cast(conv(substr(md5(concat('{int(seed)}:', coalesce(source, ''))), 1, 5), "
                    f"16, 10) as bigint) / {float(OFFSET_STEPS)}D")
    i = F.col("start") + F.col("rank")
    n_copies = (F.floor(offset + i * rate) - F.floor(offset + (i - 1) * rate)).cast("long")
    return placed.withColumn("copies", n_copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", **options) -> DataFrame:
    """The mixed corpus: every document as often as it is taken.

    Rows that repeat one id in one source with one size share their copies.
    """
    take = stage_table(
        copies(docs, id_col, text_col, source_col, **options)
        .groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("_copies"),
                                                 F.count(F.lit(1)).alias("_rows")), "copies")
    take = take.where("_copies > 0").toDF("t_id", "t_source", "t_size", "copies", "rows")
    out = nest(docs, id=F.col(id_col), source=F.col(source_col), size=words(F.col(text_col))).join(
        take, F.col("id").eqNullSafe(F.col("t_id")) & F.col("source").eqNullSafe(F.col("t_source"))
        & (F.col("size") == F.col("t_size")))
    single = out.where(F.col("rows") == 1)
    if not take.where(F.col("rows") > 1).isEmpty():
        w = Window.partitionBy("t_id", "t_source", "t_size").orderBy(
            F.col("row").getField(text_col))
        q = F.floor(F.col("copies") / F.col("rows"))
        many = out.where(F.col("rows") > 1).withColumn("nth", F.row_number().over(w)).withColumn(
            "copies", (q + (F.col("nth") <= F.col("copies") - q * F.col("rows")).cast("long")))
        single = single.unionByName(many.drop("nth"))
    again = single.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return unnest(again, docs.columns)
