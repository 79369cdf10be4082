"""Python UDF surface for the first-name rule.

The default path is the native :func:`tierline.functions.columns.first_name`.
This Arrow-batched variant exists for callers that want the rule evaluated in
Python (it is tested equal to the native one). It crosses into a Python worker
and breaks whole-stage codegen, so keep it off hot paths.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def first_name_arrow(names: pd.Series) -> pd.Series:
    """Vectorised first name over an Arrow batch; NULL or ``''`` -> NULL."""
    head = names.str.split(" ", n=1).str[0].str.split("_", n=1).str[0].str.upper()
    return head.where(names.str.len() > 0, None)
