"""Categorical encoding.

Category lists are learned in ONE shuffle for all columns (unpivot to
(column, value), distinct with map-side partial aggregation); only the
distinct values reach the driver, at most one more than ``max_categories``,
which then raises.  Encoding itself is a
projection of 0/1 columns, named ``<column>_<value>`` like pandas'
``get_dummies``; ``assemble`` packs them into an ML vector (stored sparse
when mostly zero).  A frame cannot hold a column for each of very many
values; ``one_hot_vector`` has no such limit and feeds the models.
"""

from __future__ import annotations

import re

from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.columns import col, string_columns

MAX_CATEGORIES = 10_000


def fit_categories(df: DataFrame, cols: list[str],
                   max_categories: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Sorted distinct present values of each column."""
    if not cols:
        return {}
    pairs = (df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("k"), col(c).cast("string").alias("v")) for c in cols])).alias("p"))
        .select("p.k", "p.v").filter(F.col("v").isNotNull()).distinct())
    found = pairs.limit(max_categories + 1).collect()
    if len(found) > max_categories:
        raise ValueError(f"more than {max_categories} categories in {cols}; "
                         "too many to one-hot encode")
    out: dict[str, list[str]] = {c: [] for c in cols}
    for k, v in found:
        out[k].append(v)
    return {c: sorted(v) for c, v in out.items()}


def dummy_names(categories: dict[str, list[str]], drop_first: bool = False,
                prefix: dict[str, str] | None = None) -> list[str]:
    names = []
    for c, values in categories.items():
        p = (prefix or {}).get(c, c)
        names += [f"{p}_{v}" for v in (values[1:] if drop_first else values)]
    return names


def dummies(categories: dict[str, list[str]], drop_first: bool = False,
            prefix: dict[str, str] | None = None, dtype: str = "int") -> list:
    """0/1 expressions; a missing or unseen value gives all zeros."""
    exprs = []
    for c, values in categories.items():
        p = (prefix or {}).get(c, c)
        for v in (values[1:] if drop_first else values):
            exprs.append(F.when(col(c) == F.lit(v), 1).otherwise(0).cast(dtype).alias(f"{p}_{v}"))
    return exprs


def get_dummies(df: DataFrame, cols: list[str] | None = None, drop_first: bool = False,
                categories: dict[str, list[str]] | None = None,
                prefix: dict[str, str] | None = None, dtype: str = "int") -> DataFrame:
    """Other columns first, then the dummies of ``cols``
    (default: all string columns).  ``categories`` from a fit on train
    data makes test data line up (P11): unseen values -> zeros."""
    cols = string_columns(df) if cols is None else cols
    categories = categories if categories is not None else fit_categories(df, cols)
    keep = [col(c) for c in df.columns if c not in cols]
    return df.select(*keep, *dummies(categories, drop_first, prefix, dtype))


def one_hot_vector(df: DataFrame, cols: list[str], numeric: list[str] = (), drop_first: bool = False,
                   output: str = "features", labels: dict[str, list[str]] | None = None
                   ) -> DataFrame:
    """E1/E2 as one sparse vector: the ``numeric`` columns, then a slot per
    sorted value of each of ``cols``, however many.  A missing value gives
    all zeros; slot names are in the vector's attributes (E5).  ``labels``:
    the columns' sorted values where they are known."""
    temp = [f"__i{k}" for k in range(len(cols))]
    slots = []
    if cols:
        if labels is None:
            model = StringIndexer(inputCols=list(cols), outputCols=temp, handleInvalid="keep",
                                  stringOrderType="alphabetAsc").fit(df)
            df, found = model.transform(df), model.labelsArray
        else:
            # one by one: pyspark fills arrays of unequal lengths up with nulls
            found = [labels[c] for c in cols]
            for c, t, v in zip(cols, temp, found):
                if v:
                    df = StringIndexerModel.from_labels(v, c, t, "keep").transform(df)
        # the slot of missing values is the last one, which is dropped
        used = [(t, len(v)) for t, v in zip(temp, found) if len(v) > drop_first]
        if used:
            hot = [f"{t}h" for t, _ in used]
            df = OneHotEncoder(inputCols=[t for t, _ in used], outputCols=hot,
                               dropLast=True).fit(df).transform(df)
            for (_, n), h in zip(used, hot):
                if drop_first:
                    df = VectorSlicer(inputCol=h, outputCol=f"{h}s",
                                      indices=list(range(1, n))).transform(df)
                slots.append(f"{h}s" if drop_first else h)
            temp += hot + [h for h in slots if h not in hot]
    return assemble(df, [*numeric, *slots], output).drop(*temp)


def class_codes(df: DataFrame, target: str, output: str = "label") -> DataFrame:
    """E4 for a model's label: position among the sorted values; a missing
    value is a class of its own, after the others."""
    return StringIndexer(inputCol=target, outputCol=output, handleInvalid="keep",
                         stringOrderType="alphabetAsc").fit(df).transform(df)


def encode_labels(df: DataFrame, column: str, output: str = "code") -> DataFrame:
    """E4 with any number of values: dense codes are positions in a range
    partitioning of the distinct values, and a join puts them on the rows
    (broadcast by the planner while the dictionary is small; adaptive
    execution splits a hot value's rows).  Missing -> -1."""
    from tabloom.operators.graphs import numbered
    values = df.select(col(column).alias("__value")).where("__value is not null").distinct()
    codes = numbered(values, ["__value"], "__code")
    coded = df.join(codes, col(column) == F.col("__value"), "left").withColumn(
        output, F.coalesce(F.col("__code").cast("int"), F.lit(-1)))
    return coded.select(*[col(c) for c in df.columns], output)


def label_codes(c, values: list[str]):
    """Position in the sorted value list, missing/unseen -> -1."""
    arr = F.array(*[F.lit(v) for v in values])
    pos = F.array_position(arr, col(c) if isinstance(c, str) else c)
    return F.coalesce(pos - 1, F.lit(-1)).cast("int")


def assemble(df: DataFrame, inputs: list[str], output: str = "features") -> DataFrame:
    """Numeric columns -> one ML vector; names kept in the ML attributes (E5)."""
    return VectorAssembler(inputCols=inputs, outputCol=output,
                           handleInvalid="error").transform(df)


def feature_names(df: DataFrame, vector: str = "features") -> list[str]:
    """E5: slot names from the assembled column's metadata."""
    meta = df.schema[vector].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    slots = [a for group in attrs.values() for a in group]
    return [a["name"] for a in sorted(slots, key=lambda a: a["idx"])]


def slot_names(df: DataFrame, cols: list[str], vector: str = "features") -> list[str]:
    """E5 for ``one_hot_vector``: a numeric column's name, or
    ``<column>_<value>`` for a slot of one of ``cols``."""
    out = []
    for name in feature_names(df, vector):
        made = re.match(r"__i(\d+)hs?_(.*)", name, re.S)
        out.append(f"{cols[int(made[1])]}_{made[2]}" if made else name)
    return out
