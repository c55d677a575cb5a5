"""Rounding of result values as Python does it."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def python_round(value: Column, digits: int) -> Column:
    """Round the exact binary value, half to even; Spark's own functions round its shortest decimal text.

    For the few rows of a result: one-row totals, one row per source, one row per dropped record.  A null stays null.
    """

    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: round(v, digits), na_action="ignore")

    return F.pandas_udf(run, "double")(value)
