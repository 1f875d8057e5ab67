import datetime as dt
import math

from pyspark.sql import types as T


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def rows(df, order=None):
    out = [r.asDict(recursive=True) for r in df.collect()]
    if order:
        out.sort(key=lambda r: tuple(r[c] for c in order))
    return out


def close(a, b, rel=1e-9):
    if a is None or b is None:
        return a is b
    if isinstance(a, float) or isinstance(b, float):
        return math.isclose(a, b, rel_tol=rel, abs_tol=1e-12)
    return a == b


def norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, list):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        return v.replace(tzinfo=None)
    return v


def bag(rs, cols=None):
    cols = cols or (sorted(rs[0].keys()) if rs else [])
    return sorted((tuple(norm(r[c]) for c in cols) for r in rs), key=repr)


TRADES_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("trade_price", T.DoubleType()), T.StructField("trade_size", T.LongType()),
    T.StructField("exchange", T.StringType()), T.StructField("trade_condition", T.StringType()),
    T.StructField("data_quality_flag", T.StringType()), T.StructField("tick_id", T.LongType()),
])

QUOTES_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("bid_price", T.DoubleType()), T.StructField("ask_price", T.DoubleType()),
    T.StructField("bid_size", T.LongType()), T.StructField("ask_size", T.LongType()),
    T.StructField("exchange", T.StringType()), T.StructField("data_quality_flag", T.StringType()),
    T.StructField("tick_id", T.LongType()),
])

BOOK_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("bid_prices", T.ArrayType(T.DoubleType())), T.StructField("bid_sizes", T.ArrayType(T.LongType())),
    T.StructField("ask_prices", T.ArrayType(T.DoubleType())), T.StructField("ask_sizes", T.ArrayType(T.LongType())),
    T.StructField("data_quality_flag", T.StringType()), T.StructField("tick_id", T.LongType()),
])


def trade(sym, t, price, size, flag="OK", tid=0):
    return (sym, ts(t), float(price), size, "NYSE", "@", flag, tid)


def quote(sym, t, bid, ask, bs=100, asz=100, flag="OK", tid=0):
    return (sym, ts(t), float(bid), float(ask), bs, asz, "NYSE", flag, tid)


def sliding_mean_std(df, value, part, order, rows):
    """The built-in sliding frame (one task per part): the reference of the
    bounded plan."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(-(rows - 1), 0)
    return df.withColumns({"rolling_mean": F.avg(value).over(w), "rolling_std": F.stddev_pop(value).over(w)})


def sliding_previous(df, col, part, order, name):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    return df.withColumn(name, F.lag(col).over(Window.partitionBy(*part).orderBy(*order)))
