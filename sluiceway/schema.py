"""Record shapes, table names and default settings."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and settings that downstream readers expect unchanged.
MAIN_TABLE = "ecommerce_events"
DLQ_TABLE = "ecommerce_events_dlq"
PROCESSED_TOPIC = "lake-events"
DLQ_TOPIC = "lake-events-dlq"
DIVERTED_STATUS = "DIVERTED"
DIVERTED_REASON = "NULL_TAX_AMOUNT"
ERROR_THRESHOLD = 0.02
MINIMUM_RECORDS = 50
TAX_NOT_NULL_SHARE = 0.90
TAX_RATE = 0.08
WARNING_BAND_PERCENT = 1.5
CURRENCIES = ("USD", "INR", "EUR")
COUNTRIES = ("USA", "IND", "DEU", "FRA", "GBR", "CAN")
PAYMENT_METHODS = ("CREDIT_CARD", "UPI", "PAYPAL", "APPLE_PAY", "STRIPE")
EVENT_FIELDS = (
    "order_id", "user_id", "amount", "tax_amount", "currency", "country", "payment_method", "timestamp",
)

MONEY = T.DecimalType(18, 2)

CANONICAL = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("amount", MONEY),
    T.StructField("tax_amount", MONEY),
    T.StructField("currency", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("value", T.StringType()),
])

# What a message source hands over: the raw text plus where it came from.
ARRIVAL = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

# Batch handed to the validator as JSON records.
VALIDATOR_BATCH = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("tax_amount", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

# CSV export with a header line.
TRANSACTIONS_CSV = T.StructType([
    T.StructField("transaction_id", T.LongType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("amount", MONEY),
    T.StructField("tax_amount", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
])

REPORT = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("total_assertions", T.IntegerType()),
    T.StructField("successful_assertions", T.IntegerType()),
    T.StructField("success_rate_percent", T.DoubleType()),
    T.StructField("failures", T.ArrayType(T.StringType())),
    T.StructField("metrics", T.StructType([
        T.StructField("total_rows_evaluated", T.LongType()),
        T.StructField("null_tax_count", T.LongType()),
        T.StructField("negative_amount_count", T.LongType()),
    ])),
])
