"""Row and surrogate keys computed from a row alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that stands for NULL in a hash key, as in the public dbt_utils macro.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column | str, null_token: str = NULL_TOKEN) -> Column:
    """md5 over the columns as text, joined by '-'.

    Use text, integer and date columns: the text of a float differs between engines.
    """
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(null_token))
        for c in cols
    ]
    return F.md5(F.concat_ws("-", *parts))


def row_id(*cols: str) -> Column:
    """sha-256 over the columns as JSON: names and escapes keep different rows apart.

    One JSON call also keeps the generated code of a wide projection small enough to be compiled.
    """
    return F.sha2(F.to_json(F.struct(*cols)), 256)


def random_id() -> Column:
    """A random UUID, different on every evaluation. Prefer :func:`row_id`."""
    return F.uuid()
