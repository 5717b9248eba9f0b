"""Declared table schemas, the fixed business values, and the schema check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------
ACTIVE_DAYS = 365
RECENT_ORDER_DAYS = 90
HORIZON_DAYS = 90
MIN_RETENTION = 0.90
PRODUCT_CODE = r"^[0-9]{5}"
ROW_LIMIT = 200
HIGH_RISK = 0.5
REVERSAL_MINUTES = 16
ENTRY_MAX_UNITS = 5000
ENTRY_MAX_VALUE = 10000
CALL_LIST_SIZE = 100
RETAINED_SHARES = (0.10, 0.20, 0.30)
FEATURES = [
    "recency_days", "frequency", "monetary", "revenue_365d", "orders_90d",
    "distinct_products", "cancel_rate", "avg_order_value", "tenure_days",
]
# Rules by name, as SQL conditions; the first that holds decides. Sales must be positive and cancellations negative, all
# else left the stock unsold; a line whose value does not fit the money type is as unreadable as one without a price.
REJECT_RULES = (
    ("unparseable", "invoice_ts IS NULL OR quantity IS NULL OR price IS NULL OR abs(CAST(price AS DOUBLE) * quantity) >= 1e15"),
    ("bad_debt_adjustment", "startswith(invoice, 'A')"),
    ("non_product_code", f"NOT rlike(stock_code, '{PRODUCT_CODE}')"),
    ("zero_or_negative_price", "price <= 0"),
    ("stock_writeoff", "is_cancellation <> (quantity < 0)"),
)
SEGMENT_RULES = (
    ("Champions", "r_score >= 4 AND f_score >= 4"),
    ("Promising", "r_score >= 4 AND f_score <= 2"),
    ("Loyal", "r_score >= 3 AND f_score >= 3"),
    ("At Risk", "r_score <= 2 AND f_score >= 3"),
    ("Hibernating", "r_score <= 2"),
    ("Needs Attention", "TRUE"),
)
# ----------------------------------------------------------------------------------

# Money is exact inside the engine and published as DOUBLE by the gold tables.
PRICE = T.DecimalType(18, 4)
MONEY = T.DecimalType(18, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def _plus(base: T.StructType, **columns: T.DataType) -> T.StructType:
    return T.StructType(base.fields + _struct(**columns).fields)


_S, _I, _L, _D, _DATE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType()

BRONZE = _struct(
    invoice=_S, stock_code=_S, description=_S, quantity=_S, invoice_date=_S, price=_S,
    customer_id=_S, country=_S,
)

# Each column says which text it is read from, where the names differ, and whether its text is put in upper case.
LINE = T.StructType([
    T.StructField("invoice", _S), T.StructField("stock_code", _S, True, {"upper_case": True}), T.StructField("description", _S),
    T.StructField("quantity", _I), T.StructField("invoice_ts", T.TimestampNTZType(), True, {"read_from": "invoice_date"}),
    T.StructField("price", PRICE), T.StructField("customer_id", _S), T.StructField("country", _S),
])

LABELLED = _plus(LINE, is_cancellation=T.BooleanType(), reject_reason=_S)

SILVER = _plus(LINE, is_cancellation=T.BooleanType(), invoice_date=_DATE, line_value=MONEY)

MONTHLY_KPIS = _struct(
    month=_DATE, country=_S, gross_revenue=_D, cancelled_value=_D, orders=_L, customers=_L,
    units=_L, net_revenue=_D,
)

PRODUCT_PERFORMANCE = _struct(
    stock_code=_S, description=_S, units_sold=_L, gross_revenue=_D, cancelled_value=_D, orders=_L,
)

CUSTOMER_FEATURES = _struct(
    customer_id=_S, country=_S, last_purchase=_DATE, first_purchase=_DATE, frequency=_L,
    monetary=_D, revenue_365d=_D, orders_90d=_L, distinct_products=_L, cancel_rate=_D,
    avg_order_value=_D, recency_days=_I, tenure_days=_I, as_of=_DATE,
)

CUSTOMER_RFM = _plus(CUSTOMER_FEATURES, r_score=_I, f_score=_I, m_score=_I, segment=_S)

CHURN_SNAPSHOT = _plus(CUSTOMER_FEATURES, churned=_I)

CHURN_RISK = _plus(CUSTOMER_RFM, churn_probability=_D, revenue_at_risk=_D, model_run_id=_S)


class SchemaMismatch(ValueError):
    """A table does not have the declared columns."""


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Check names and types against the declared schema; return the columns in its order."""
    found = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in schema.fields}
    if found != wanted:
        odd = sorted(k for k in found.keys() | wanted.keys() if found.get(k) != wanted.get(k))
        raise SchemaMismatch(
            "; ".join(f"{k}: expected {wanted.get(k)}, found {found.get(k)}" for k in odd)
        )
    return df.select(*wanted)
