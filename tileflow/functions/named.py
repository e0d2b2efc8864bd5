"""Python functions that keep a readable name in query plans."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F


def named_udf(name, function, return_type, vectorized=False, **bound):
    """Wrap ``function`` as a UDF called ``name``, with some arguments bound.

    Bound arguments win over arguments of the same name given in the call.  Values
    travel in Arrow batches; with ``vectorized=True`` the function gets whole pandas
    Series instead of single values.
    """
    if vectorized:
        def call(*columns: pd.Series, **named: pd.Series) -> pd.Series:
            return function(*columns, **{**named, **bound})
    else:
        def call(*values, **kwargs):
            return function(*values, **{**kwargs, **bound})

    call.__name__ = name
    if vectorized:
        return F.pandas_udf(call, return_type)
    return F.udf(call, return_type, useArrow=True)
