"""DBSCAN (C3), exact, Euclidean: one setting of ``density``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators import blocks as B
from tabloom.operators.cluster.density import density_clusters, merge_duplicates, near_blocks
from tabloom.operators.columns import col
from tabloom.session import cut_lineage


def dbscan(df: DataFrame, id_col: str, features: list[str], eps: float, min_samples: float,
           weight: str | None = None, block_rows: int = B.ROWS) -> DataFrame:
    """Input rows + ``prediction`` (cluster number, -1 = noise)."""
    points = cut_lineage(merge_duplicates(df, id_col, features, weight))
    blocks = near_blocks(points, features, eps, block_rows)
    if not blocks.count:
        return df.withColumn("prediction", F.lit(None).cast("int"))
    labels = B.unpack(density_clusters(blocks, [(eps, min_samples)]), ["prediction"])
    named = points.join(labels, points["pid"] == labels["id"]).select(*features, "prediction")
    keyed = df.withColumns({f: col(f).cast("double") + F.lit(0.0) for f in features})
    return keyed.join(named, features, "left")
