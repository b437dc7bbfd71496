"""Dimension joins.

A dimension is broadcast only after its row count has been measured against a
bound (``checked_broadcast``); above the bound the join is left to the
planner -- a shuffle join, with AQE splitting skewed fact keys. Nothing is
broadcast on a guess, and the fact is never shuffled just to meet a small
dimension whose static size estimate happened to be wrong (a derived
dimension's estimate is the product of its inputs).
"""

from __future__ import annotations

from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NOT_PLAIN = (T.MapType, T.ArrayType, T.StructType, T.VariantType)
# Dimensions up to this many rows and this estimated size are broadcast.
DIM_BROADCAST_MAX_ROWS = 500_000
DIM_BROADCAST_MAX_BYTES = 64 * 1024 * 1024
#: columns that the store dimension adds, and those that the goods dimension adds behind a prefix
STORE_COLS = ("department", "platform", "operator")
GOODS_COLS = ("id", "brand", "category", "manager")


def _row_bytes(dim: DataFrame) -> int:
    """Rough width of one row (strings counted at 32 bytes)."""
    width = 8
    for f in dim.schema.fields:
        t = f.dataType
        if isinstance(t, (T.StringType, T.BinaryType)):
            width += 32
        elif isinstance(t, T.DecimalType):
            width += 16
        elif isinstance(t, (T.BooleanType, T.ByteType)):
            width += 1
        elif isinstance(t, (T.IntegerType, T.DateType, T.FloatType, T.ShortType)):
            width += 4
        elif isinstance(t, T.NumericType) or isinstance(t, T.TimestampType):
            width += 8
        else:
            width += 64
    return width


#: rows of the frames that were counted, as far as they were: (rows, whether that is all)
_COUNTED: WeakKeyDictionary[DataFrame, tuple[int, bool]] = WeakKeyDictionary()


def _at_most(dim: DataFrame, limit: int) -> bool:
    """Whether ``dim`` has at most ``limit`` rows. A frame is counted once,
    up to the bound: a plan that joins it twice asks once, and a dimension
    that is read anew is a new frame and is counted anew."""
    rows, whole = _COUNTED.get(dim, (-1, False))
    if not whole and rows <= limit:
        rows = dim.limit(limit + 1).count()
        whole = rows <= limit
        _COUNTED[dim] = (rows, whole)
    return whole and rows <= limit


def checked_broadcast(dim: DataFrame, max_rows: int | None = None,
                      max_bytes: int = DIM_BROADCAST_MAX_BYTES, of: DataFrame | None = None) -> DataFrame:
    """``dim`` with a broadcast hint if it has at most ``max_rows`` rows and
    about ``max_bytes`` bytes, else unchanged (the planner then shuffles).
    The check is a bounded count (it stops reading after the bound), so it
    stays cheap for a dimension of any size. ``of`` is the frame that ``dim``
    was selected from, whose rows bound its own."""
    limit = DIM_BROADCAST_MAX_ROWS if max_rows is None else max_rows
    limit = max(0, min(limit, max_bytes // _row_bytes(dim)))
    return F.broadcast(dim) if _at_most(dim if of is None else of, limit) else dim


def _norm(c, case_insensitive: bool):
    return F.lower(c) if case_insensitive else c


def clean_store_dim(dim: DataFrame) -> DataFrame:
    """Dimension as loaded: null keys dropped (Q2), bookkeeping column gone."""
    out = dim.where(F.col("store").isNotNull())
    return out.drop("updatetime") if "updatetime" in dim.columns else out


def _store_side(dim: DataFrame, case_insensitive: bool) -> DataFrame:
    return clean_store_dim(dim).select(_norm(F.col("store"), case_insensitive).alias("__dim_store"), *STORE_COLS)


def store_is_broadcast(dim: DataFrame) -> bool:
    """Whether ``attach_store_dim`` broadcasts ``dim``."""
    side = _store_side(dim, True)
    return checked_broadcast(side, of=dim) is not side


def attach_store_dim(fact: DataFrame, dim: DataFrame, *, case_insensitive: bool = True,
                     lower_store: bool = False, store_col: str = "store") -> DataFrame:
    """Left join fact -> store dimension adding department, platform, operator.

    ``case_insensitive`` matches on lower-cased names (J1); ``lower_store``
    additionally stores the fact's store name lower-cased (J2). Existing
    dimension columns on the fact are replaced (J3). Duplicate dimension keys
    fan out, as in any left join (Q3; see :func:`duplicate_keys`).
    """
    base = fact.drop(*[c for c in STORE_COLS if c in fact.columns])
    if lower_store:
        base = base.withColumn(store_col, F.lower(F.col(store_col)))
    d = checked_broadcast(_store_side(dim, case_insensitive), of=dim)
    joined = base.join(d, _norm(base[store_col], case_insensitive) == d["__dim_store"], "left")
    return joined.drop("__dim_store")


#: texts that keys which match nothing are dealt to
_PLACES = 1 << 16


def _spread(key: Column, by: list[Column]) -> Column:
    """``key`` as it is joined by a shuffle: behind a mark, and where it is null,
    so that it matches nothing, one of many texts behind another mark, by the
    hash of ``by``. The rows without a key are so dealt over all tasks."""
    place = F.pmod(F.xxhash64(*by), F.lit(_PLACES)).cast("string")
    return F.when(key.isNull(), F.concat(F.lit("-"), place)).otherwise(F.concat(F.lit("="), key))


def _goods_side(goods: DataFrame, prefix: str, columns: tuple[str, ...] = GOODS_COLS) -> DataFrame:
    return goods.where(F.col("sku").isNotNull()).select(F.col("sku").alias(f"__{prefix}_sku"), *[F.col(c).alias(f"{prefix}_{c}") for c in columns])


def goods_are_broadcast(goods: DataFrame) -> bool:
    """Whether ``attach_goods`` broadcasts ``goods``."""
    side = _goods_side(goods, "")
    return checked_broadcast(side, of=goods) is not side


def attach_goods(fact: DataFrame, goods: DataFrame, key_col: str | Column, prefix: str, spread_by: tuple[str | Column, ...] = (), *,
                 columns: tuple[str, ...] = GOODS_COLS, of: DataFrame | None = None) -> DataFrame:
    """Left join on ``key_col = sku`` adding ``{prefix}_id/_brand/_category/
    _manager`` (J4, J5). A null key matches nothing (Q2). Where the goods are
    too many to broadcast, the rows without a key are spread by the columns
    ``spread_by``, all plain ones if none are named. A key that is an expression
    of the fact's columns is made for the join alone. ``columns`` are others of
    ``goods``, which was made row by row from ``of``."""
    sku = f"__{prefix}_sku"
    g = _goods_side(goods, prefix, columns)
    held = checked_broadcast(g, of=goods if of is None else of)
    key = fact[key_col] if isinstance(key_col, str) else key_col
    text = all(isinstance(t, T.StringType) for t in (fact.select(key).schema[0].dataType, goods.schema["sku"].dataType))
    if held is not g or not text:
        return fact.join(held, key == held[sku], "left").drop(sku)
    g = g.withColumn(sku, F.concat(F.lit("="), sku))
    by = [c for c in spread_by if not isinstance(c, str) or c in fact.columns] or [f.name for f in fact.schema if not isinstance(f.dataType, _NOT_PLAIN)]
    return fact.join(g, _spread(key, [fact[c] if isinstance(c, str) else c for c in by]) == g[sku], "left").drop(sku)


#: values up to which a dimension's text column is moved as a number
MOST_VALUES = 1_000


class Numbered:
    """A dimension whose text columns of at most ``MOST_VALUES`` values are one
    number, ``look``, for a fact that is moved after it has met them. ``value``
    gives the text again. A column with more values stays as it is."""

    def __init__(self, dim: DataFrame, columns: tuple[str, ...]):
        self.values: dict[str, list[str]] = {}
        for c in columns:
            if isinstance(dim.schema[c].dataType, T.StringType):
                found = dim.select(c).where(F.col(c).isNotNull()).distinct().limit(MOST_VALUES + 1).collect()
                if len(found) <= MOST_VALUES:
                    self.values[c] = sorted(r[0] for r in found)
        self.plain = tuple(c for c in columns if c not in self.values)
        look, self.steps = F.lit(0).cast("bigint"), {}
        step = 1
        for c, texts in self.values.items():
            held = dim.sparkSession.createDataFrame(pa.table({"__text": pa.array(texts, pa.string()), "__no": pa.array(range(1, len(texts) + 1), pa.int64())}))
            dim = dim.join(F.broadcast(held), dim[c] == held["__text"], "left").withColumn(c, F.coalesce("__no", F.lit(0))).drop("__text", "__no")
            look, self.steps[c] = look + F.col(c) * step, step
            step *= len(texts) + 1
        self.rows = dim.withColumn("look", look).drop(*self.values)

    def value(self, name: str, look: Column) -> Column:
        """The text of column ``name`` where ``look`` is the number; null for 0, which is no text, and for null."""
        texts = self.values[name]
        place = F.pmod((look - F.pmod(look, F.lit(self.steps[name]))) / F.lit(self.steps[name]), F.lit(len(texts) + 1)).cast("int")
        return F.get(F.array(*map(F.lit, texts)).cast("array<string>"), place - 1)


def enrich_small(small: DataFrame, dim: DataFrame, left_key: str, right_key: str,
                 columns: list[str], *, case_insensitive: bool = False) -> DataFrame:
    """Left join a result of proven small size (a top-k list) to a dimension
    of any size.

    The small side's keys are broadcast into a semi join that cuts the
    dimension down to the matching rows first; only then is the (now small)
    dimension joined. The broadcast side is bounded by the caller's k, never
    by the data.
    """
    keys = small.select(_norm(F.col(left_key), case_insensitive).alias("__k")).distinct()
    d = dim.select(_norm(F.col(right_key), case_insensitive).alias("__k"), *columns)
    d = d.join(F.broadcast(keys), "__k", "left_semi")
    s = small.withColumn("__k", _norm(F.col(left_key), case_insensitive))
    return s.join(d, "__k", "left").drop("__k")


def duplicate_keys(dim: DataFrame, key: str, *, case_insensitive: bool = True) -> DataFrame:
    """Keys that occur more than once (after lower-casing when asked):
    these fan a left join out."""
    k = _norm(F.col(key), case_insensitive).alias("key")
    return dim.groupBy(k).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
