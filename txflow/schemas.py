"""Record layouts and the fixed values the operators share."""

from pyspark.sql import types as T

# --- fixed values: must equal the documented data model ---------------------
PRODUCT_CATEGORIES = ["Electronics", "Clothing", "Food", "Books", "Toys", "Sports"]
REGIONS = ["North", "South", "East", "West", "Central"]
PAYMENT_METHODS = ["Credit Card", "Debit Card", "PayPal", "Cash", "Gift Card"]

WEEKEND_DAYS = [5, 6]
PEAK_HOURS = (10, 20)
LATE_NIGHT_HOURS = [0, 1, 2, 3, 4]
DAY_PARTS = [(6, "Night"), (12, "Morning"), (18, "Afternoon")]
LAST_DAY_PART = "Evening"
PRICE_TIERS = [(25, "Budget"), (100, "Mid-Range"), (500, "Premium")]
LAST_PRICE_TIER = "Luxury"
HIGH_VALUE_ABOVE = 500
BULK_QUANTITY = 10

UNKNOWN = "Unknown"
NO_EVENT_ID = -1
LATENCY_RANKS = {"p50": 0.50, "p95": 0.95, "p99": 0.99}
REPORT_SECONDS = 5
BACKLOG_ALERT = 1000
# ----------------------------------------------------------------------------

MICROS = 1_000_000

# Ids are 64-bit: 32 bits run out at 2.1 billion transactions.
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("product_category", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("hour_of_day", T.IntegerType()),
        T.StructField("is_fraud", T.StringType()),
    ]
)

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("product_category", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("is_fraud", T.BooleanType()),
    ]
)

# Recorded streams may carry their arrival time, in the unit of ``timestamp``.
RECORDED_EVENT_SCHEMA = T.StructType(
    EVENT_SCHEMA.fields + [T.StructField("arrival", T.DoubleType())]
)
