"""Small scalar helpers: code labels, version strings, URIs, vector transforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def code_label(c: Column | str, code=1, if_match: str = "Male", otherwise: str = "Female") -> Column:
    """Code -> label; works for numeric and keyword (string) codes, NULL stays NULL."""
    col = _c(c)
    return (F.when(col.isNull(), F.lit(None).cast("string"))
             .when(col.cast("string") == F.lit(str(code)), F.lit(if_match))
             .otherwise(F.lit(otherwise)))


def version_string(ts: Column | str, accuracy: Column | str) -> Column:
    """``v_<yyyyMMdd_HHmmss>_acc_<accuracy to 4 places>`` with every '.' replaced by '_'.

    ``format_number`` with a plain pattern rounds the exact binary value (like
    Python's ``:.4f``); ``format_string('%.4f')`` would round the shortest decimal
    text half-up and differ at ties such as 0.40595."""
    s = F.concat(F.lit("v_"), F.date_format(_c(ts), "yyyyMMdd_HHmmss"), F.lit("_acc_"),
                 F.call_function("format_number", _c(accuracy), F.lit("0.0000")))
    return F.replace(s, F.lit("."), F.lit("_"))


def uri(*parts: Column | str) -> Column:
    """Join path parts with '/' (string literals or columns)."""
    cols = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws("/", *cols)


def normalize_vector(arr: Column | str, mean: float, std: float) -> Column:
    """Element-wise ``(x - mean) / std`` over an array column, JVM-side."""
    return F.transform(_c(arr), lambda x: (x - F.lit(mean)) / F.lit(std))


def argmax(arr: Column | str) -> Column:
    """0-based index of the first maximum element."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")
