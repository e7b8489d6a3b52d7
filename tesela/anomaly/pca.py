"""Linear reconstruction: projection on principal components and back.

A linear autoencoder learns the same subspace (Baldi and Hornik 1989)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconstruct_pca(
    train: DataFrame, df: DataFrame, x: str, out: str, components: int = 4
) -> DataFrame:
    """Add the reconstruction of a z-scored array column of `df`, fitted on `train`."""
    vectors = train.select(array_to_vector(F.col(x).cast("array<double>")).alias("__v"))
    axes = PCA(k=components, inputCol="__v", outputCol="__p").fit(vectors).pc.toArray()
    project = axes @ axes.T

    @F.pandas_udf("array<double>")
    def rebuilt(column: pd.Series) -> pd.Series:
        if column.empty:
            return pd.Series([], dtype=object)
        return pd.Series(list(np.stack(column.to_numpy()).astype(np.float64) @ project))

    return df.withColumn(out, rebuilt(F.col(x)))
