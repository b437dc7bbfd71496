"""Top and bottom movers (R13, R14) on a week comparison.

The reference re-read the comparison file, froze its order in one partition,
pulled the last row (the total) to the driver to skip it, and relied on file
order for the bottom list. Here the total is excluded by its flag and both
lists are ``orderBy(...).limit(k)``, which Spark runs as a per-partition
top-k (TakeOrderedAndProject): no full sort, no single-partition step. Ties
are broken on the key, and the bottom list is exactly the last k rows of the
list ordered by (growth desc, key asc).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dims import enrich_small
from ..operators.filters import exclude_total
from ..schema import PRODUCT_MOVERS_K, STORE_MOVERS_K


def top_k(compare: DataFrame, key: str, k: int, cols: list[str]) -> DataFrame:
    return exclude_total(compare).orderBy(F.col("growth").desc(), F.col(key).asc()).limit(k).select(*cols)


def bottom_k(compare: DataFrame, key: str, k: int, cols: list[str]) -> DataFrame:
    return exclude_total(compare).orderBy(F.col("growth").asc(), F.col(key).desc()).limit(k).select(*cols)


def _pick(compare: DataFrame, key: str, k: int, which: str, cols: list[str]) -> DataFrame:
    if which == "top":
        return top_k(compare, key, k, cols)
    if which == "bottom":
        return bottom_k(compare, key, k, cols)
    raise ValueError("which must be 'top' or 'bottom'")


def store_movers(store_compare: DataFrame, store_dim: DataFrame, which: str = "top",
                 k: int = STORE_MOVERS_K) -> DataFrame:
    """Store, growth, growth_rate, department, platform, operator.
    Store names match the dimension case-insensitively (Q13)."""
    picked = _pick(store_compare, "store", k, which, ["store", "growth", "growth_rate"])
    dim = store_dim.where(F.col("store").isNotNull()).select(
        F.col("store").alias("dim_store"), "department", "platform", "operator")
    out = enrich_small(picked, dim, "store", "dim_store", ["department", "platform", "operator"],
                       case_insensitive=True)
    return out.orderBy(F.col("growth").desc(), F.col("store"))


def product_movers(product_compare: DataFrame, goods_dim: DataFrame, which: str = "top",
                   k: int = PRODUCT_MOVERS_K) -> DataFrame:
    """Product, profit_new, quantity_new, growth, growth_rate, manager."""
    picked = _pick(product_compare, "product", k, which,
                   ["product", "profit_new", "quantity_new", "growth", "growth_rate"])
    dim = goods_dim.where(F.col("sku").isNotNull()).select("sku", "manager")
    out = enrich_small(picked, dim, "product", "sku", ["manager"])
    return out.orderBy(F.col("growth").desc(), F.col("product"))
