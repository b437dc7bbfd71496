"""Column names, table schemas and the fixed values every report depends on.

The order fact uses English column names throughout. ``RAW_ORDER_COLS`` is the
collected column order (26 columns); the collected fact adds the three store
dimension columns, giving the 29 positional names of a header-less file.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for results to match the
# original reports: labels, sentinels, flags, defaults.
# --------------------------------------------------------------------------
TOTAL_LABEL = "总计"               # key of every grand-total row
NOT_UPDATED = "未更新"             # freight sentinel meaning "unknown"
LOSS_YES = "是"                    # loss flag: profit <= 0
LOSS_NO = "否"                     # loss flag: profit > 0
HK_WAREHOUSE = "香港"              # warehouse that carries a fixed handling fee
HK_FEE = 9.5                       # that fee
PERIOD_DAYS = 7                    # length of each compared period
ANCHOR_LAG_DAYS = 2                # "today" is two days before the run date
STORE_MOVERS_K = 5                 # top/bottom stores
PRODUCT_MOVERS_K = 10              # top/bottom products
DEFAULT_SNAPSHOT = 20201105        # target snapshot id used by the reports
ZERO_TARGET_RATE_FILL = 100        # operator report: null rate filled after ranking
MONEY_SCALE = 2

# --------------------------------------------------------------------------
# Order fact
# --------------------------------------------------------------------------
RAW_ORDER_COLS = [
    "order_date", "ship_date", "store", "order_no", "product", "product2",
    "quantity", "unit_price", "currency1", "commission_rate", "settle_total",
    "currency2", "unit_price_cny", "revenue", "cost_price", "currency3",
    "cost_total", "handling_fee", "freight_first", "freight_last",
    "capital_cost", "profit", "warehouse", "country", "tracking_no",
    "payment_status",
]
# The labels that the stores' own files give these columns.
FILE_LABELS = {
    "order_date": "订单时间",
    "ship_date": "发货时间",
    "store": "店铺",
    "order_no": "订单号",
    "product": "产品",
    "product2": "产品2",
    "quantity": "数量",
    "unit_price": "零售单价",
    "currency1": "币种1",
    "commission_rate": "佣金比例",
    "settle_total": "结算总额",
    "currency2": "币种2",
    "unit_price_cny": "零售单价¥",
    "revenue": "结算金额￥",
    "cost_price": "成本价",
    "currency3": "币种3",
    "cost_total": "成本总价￥",
    "handling_fee": "蚂蚁操作费",
    "freight_first": "头/全程运费￥",
    "freight_last": "尾程运费￥",
    "capital_cost": "资金成本",
    "profit": "毛利￥",
    "warehouse": "发货仓位",
    "country": "收件人国家",
    "tracking_no": "物流单号",
    "payment_status": "回款情况",
}
DIM_COLS = ["platform", "department", "operator"]
ORDER_COLS = RAW_ORDER_COLS + DIM_COLS          # 29 positional columns

# Money columns: filled with 0 and rounded to 2 places by cleaning.
MONEY = [
    "unit_price", "unit_price_cny", "settle_total", "revenue", "cost_price",
    "cost_total", "handling_fee", "freight_first", "freight_last",
    "capital_cost", "profit",
]
# Costs subtracted from revenue for the corrected profit.
COSTS = ["cost_total", "handling_fee", "freight_first", "freight_last", "capital_cost"]
# Columns cleaning reads (the raw set minus ship_date).
CLEAN_INPUT_COLS = [c for c in RAW_ORDER_COLS if c != "ship_date"]
# Dimensions of the per-store week comparison, in report order.
COMPARE_DIMENSIONS = {
    "product": "product",
    "brand": "product1_brand",
    "category": "product1_category",
}
MEASURES = ["profit", "revenue", "quantity"]

MONEY_TYPE = T.DecimalType(18, 2)

RAW_ORDERS_STRING = T.StructType([T.StructField(c, T.StringType()) for c in RAW_ORDER_COLS])
ORDERS_STRING_29 = T.StructType([T.StructField(c, T.StringType()) for c in ORDER_COLS])

STORE_DIM = T.StructType([
    T.StructField("store", T.StringType()),
    T.StructField("department", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("operator", T.StringType()),
    T.StructField("updatetime", T.DateType()),
])

GOODS_DIM = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("sku", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("manager", T.StringType()),
])

TARGET = T.StructType([
    T.StructField("snapshot", T.LongType()),
    T.StructField("key", T.StringType()),
    T.StructField("target", T.DoubleType()),
])

TARGET_KINDS = ("department", "platform", "operator")
