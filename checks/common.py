"""Small helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Sums depend on the order of their terms, so doubles are compared rounded. The
# offset keeps exact halves away from the rounding edge, where one bit decides.
OFFSET = 1.37e-7


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column."""
    offset = OFFSET if digits == 6 else 0.0
    return df.select(*[
        F.round(F.col(f.name) + offset, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def offset_sql(sql: str) -> str:
    """Add the offset to every ``round(expression, 6)``."""
    return sql.replace(", 6)", f" + {OFFSET}, 6)")


class Checks(dict):
    """Registered queries: name -> (query, SQL or None)."""

    def add(self, name, sql=None):
        def register(fn):
            self[name] = (fn, sql)
            return fn
        return register


def r(*columns: str, digits: int = 6) -> str:
    """SQL select items that round the named columns."""
    return ", ".join(f'round("{c}", {digits}) AS "{c}"' for c in columns)


CANDLE_SQL = 'instrument_key, "timestamp", timestamp_out, ' + r("open", "high", "low", "close", "volume", "vwap") + ", trade_count"
