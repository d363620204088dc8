"""Plan-shaping helpers.

``pin_columns``: Catalyst's CollapseProject folds a projected column back into
the expression that uses it.  When the user is a lambda of a higher-order
function (``transform``/``filter``/``aggregate``), a folded column is
re-evaluated for every array element -- e.g. re-splitting a whole text for
each k-gram, O(n²).  A one-row-per-row ``explode`` is a Generate node the rule
does not cross, so the columns above it are computed once per row.  It is a
narrow operator: no shuffle, no extra pass over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pin_columns(df: DataFrame) -> DataFrame:
    return df.select("*", F.explode(F.array(F.lit(0))).alias("_pin")).drop("_pin")
