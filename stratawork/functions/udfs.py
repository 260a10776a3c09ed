"""User-defined functions kept for parity; the native twins in ``labels`` are the default."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

from .labels import AMOUNT_BANDS, AMOUNT_TOP


@F.pandas_udf(T.StringType())
def amount_band_udf(amount: pd.Series) -> pd.Series:
    """Vectorised form of :func:`stratawork.functions.labels.amount_band`."""
    labels = [label for _, label in AMOUNT_BANDS]
    bands = np.select([amount < limit for limit, _ in AMOUNT_BANDS], labels, AMOUNT_TOP)
    return pd.Series(bands, dtype=object).where(amount.notna(), None)


@F.pandas_udf(T.FloatType())
def loyalty_score_udf(amount: pd.Series) -> pd.Series:
    """Vectorised form of :func:`stratawork.functions.labels.loyalty_score`."""
    return (amount.astype("float64") / 10.0).clip(upper=100.0).astype("float32")
