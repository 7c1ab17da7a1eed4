"""K-means (C1): restarts in shared passes (see ``restarts``).

The reference's 24 restarts are 24 starts that move together; the one with
the lowest within-cluster cost is kept (ties: lowest seed).  Rows may carry
weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tabloom.operators import blocks as B
from tabloom.operators.cluster.restarts import Start, best_start, nearest, run_starts
from tabloom.operators.columns import col


def fit_kmeans(df: DataFrame, features: list[str], k: int, n_init: int = 1, seed: int = 42,
               weight: str | None = None, max_iter: int = 300, tol: float = 1e-4) -> dict:
    """``model``: the best start; ``cost``; ``centers``; ``predictions``:
    rows + ``prediction``."""
    starts = [Start(k, seed + run) for run in range(n_init)]
    best = best_start(run_starts(B.pack(df, features, weight=weight), starts, max_iter, tol))
    return {"model": best, "cost": best.cost, "centers": best.centers.tolist(),
            "predictions": predict(df, features, best)}


def predict(df: DataFrame, features: list[str], start: Start,
            output: str = "prediction") -> DataFrame:
    """Any rows + the number of their nearest centre (ties: the lowest)."""
    xs = [f"__x{i}" for i in range(len(features))]
    staged = df.select("*", *[col(f).cast("double").alias(x) for f, x in zip(features, xs)])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def kernel(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = pdf.drop(columns=xs)
            out[output] = nearest(pdf[xs].to_numpy(dtype=np.float64), [start])[0][0]
            yield out

    return staged.mapInPandas(kernel, f"{fields}, `{output}` int")
