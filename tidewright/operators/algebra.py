"""Row matrices: singular values and products with small matrices."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def singular_values(df: DataFrame, vector: str, k: int, r_cond: float = 1e-9):
    """(s, V): the k largest singular values and right vectors; rows never leave the executors."""
    rows = MLUtils.convertVectorColumnsFromML(df.select(vector), vector)
    svd = RowMatrix(rows).computeSVD(k, computeU=False, rCond=r_cond)
    return svd.s.toArray(), svd.V.toArray()


def times_matrix(df: DataFrame, vector: str, matrix: np.ndarray, name: str) -> DataFrame:
    """Multiply every row vector (or array) by a small matrix, a batch of rows at a time.

    With the matrix V / s the result is the left factor U of each row.
    """
    m = np.ascontiguousarray(matrix, dtype=float)

    @F.pandas_udf("array<double>")
    def product(rows: pd.Series) -> pd.Series:
        return pd.Series(list(np.vstack(rows.to_numpy()) @ m)) if len(rows) else pd.Series([], dtype=object)

    arr = vector_to_array(vector) if dict(df.dtypes)[vector] == "vector" else F.col(vector)
    return df.withColumn(name, product(arr))
