"""Vectorized functions that are made when they are first used, so that modules can be imported without a session."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, wraps

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from gristmill.session import ready_for_python


def pandas_column(kind: str) -> Callable:
    """Like pandas_udf(kind), but made at the first call."""

    def put(f: Callable) -> Callable:
        made = cache(lambda: F.pandas_udf(f, kind))

        @wraps(f)
        def call(*columns: Column | str) -> Column:
            if spark := SparkSession.getActiveSession():
                ready_for_python(spark)
            return made()(*columns)

        return call

    return put
