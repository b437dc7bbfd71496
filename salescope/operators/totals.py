"""Grand-total rows.

A total row is an aggregate over the report rows, appended with
``unionByName`` and flagged ``is_total``. (ROLLUP does not fit: the totals
sum derived per-key columns, not base rows.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import TOTAL_LABEL


def sheet_total_rows(rows: DataFrame, key_col: str, sum_cols: list[str], *,
                     group_cols: tuple[str, ...] = (), round_scale: int | None = None,
                     int_sum_cols: tuple[str, ...] = ()) -> DataFrame:
    """Sheet-flavour total (A11): every numeric column summed, the key set to
    the total label, other columns null. With ``group_cols`` one total per
    group. Returns only the total rows, in ``rows``' schema plus
    ``is_total``."""
    aggs = []
    for c in sum_cols:
        s = F.sum(c)
        if round_scale is not None and c not in int_sum_cols:
            s = F.round(s, round_scale)
        aggs.append(s.cast(rows.schema[c].dataType if c not in int_sum_cols else "bigint").alias(c))
    tot = rows.groupBy(*group_cols).agg(*aggs) if group_cols else rows.agg(*aggs)
    fill = {f.name: F.lit(None).cast(f.dataType) for f in rows.schema.fields
            if f.name not in sum_cols and f.name not in group_cols and f.name not in (key_col, "is_total")}
    tot = tot.withColumns({key_col: F.lit(TOTAL_LABEL), **fill, "is_total": F.lit(True)})
    return tot.select(*rows.columns, *([] if "is_total" in rows.columns else ["is_total"]))


def append_total(rows: DataFrame, total: DataFrame) -> DataFrame:
    """Rows flagged non-total, then the total rows."""
    body = rows if "is_total" in rows.columns else rows.withColumn("is_total", F.lit(False))
    return body.unionByName(total.select(*body.columns))
