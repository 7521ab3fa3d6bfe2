"""Checkout events derived from the ``events`` table, with every kind of fault the rules look for.

The same SQL text runs in Spark and in the comparison engine, so both see equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.session import configure

CHECKOUT_SQL = """
e AS (
  SELECT event_id, ts, user_id, CAST(value AS DECIMAL(18,2)) AS v,
         EXTRACT(day FROM ts) BETWEEN 6 AND 8 AS bad_day
  FROM events
), c AS (
  SELECT event_id, ts, user_id,
         CASE WHEN event_id % 97 = 0 THEN CAST(0 AS DECIMAL(18,2))
              WHEN bad_day AND event_id % 10 = 3 THEN CAST(-v AS DECIMAL(18,2)) ELSE v END AS amount,
         CASE WHEN event_id % 400 = 1 THEN event_id - 1 ELSE event_id END AS order_no,
         (bad_day AND event_id % 20 < 3) OR event_id % 500 = 7 AS null_tax,
         event_id % 50 = 13  AS no_tax_key,
         event_id % 211 = 5  AS malformed,
         event_id % 20 = 11  AS drift,
         event_id % 151 = 7  AS no_order_id,
         event_id % 173 = 11 AS no_currency,
         event_id % 199 = 17 AS text_amount,
         CASE WHEN bad_day AND event_id % 10 = 4 THEN 'XYZ' WHEN event_id % 3 = 0 THEN 'USD'
              WHEN event_id % 3 = 1 THEN 'INR' ELSE 'EUR' END AS currency,
         CASE WHEN event_id % 131 = 9 THEN 'ZZZ' WHEN event_id % 6 = 0 THEN 'USA' WHEN event_id % 6 = 1 THEN 'IND'
              WHEN event_id % 6 = 2 THEN 'DEU' WHEN event_id % 6 = 3 THEN 'FRA' WHEN event_id % 6 = 4 THEN 'GBR' ELSE 'CAN' END AS country,
         CASE WHEN event_id % 137 = 9 THEN 'CASH' WHEN event_id % 5 = 0 THEN 'CREDIT_CARD' WHEN event_id % 5 = 1 THEN 'UPI'
              WHEN event_id % 5 = 2 THEN 'PAYPAL' WHEN event_id % 5 = 3 THEN 'APPLE_PAY' ELSE 'STRIPE' END AS payment_method,
         ts + INTERVAL '1' SECOND * CAST(event_id % 120 AS INT) AS ingest_ts
  FROM e
), checkout AS (
  SELECT *, CASE WHEN null_tax OR no_tax_key THEN NULL
                 WHEN amount > 0 THEN CAST(amount * CAST(0.08 AS DECIMAL(3,2)) + (CASE WHEN event_id % 251 = 3 THEN 1 ELSE 0 END) AS DECIMAL(18,2))
                 ELSE CAST(0 AS DECIMAL(18,2)) END AS tax_amount
  FROM c
), raw AS (
  SELECT *, CASE WHEN malformed THEN concat('{"order_id":"ORD-', CAST(order_no AS STRING), '","amount":')
    ELSE concat('{',
      CASE WHEN no_order_id THEN '' ELSE concat('"order_id":"ORD-', CAST(order_no AS STRING), '",') END,
      '"user_id":"USR-', CAST(user_id AS STRING), '",',
      '"amount":', CASE WHEN text_amount THEN '"abc"' ELSE CAST(amount AS STRING) END,
      CASE WHEN no_tax_key THEN '' WHEN null_tax THEN ',"tax_amount":null'
           ELSE concat(',"tax_amount":', CAST(tax_amount AS STRING)) END,
      CASE WHEN no_currency THEN '' ELSE concat(',"currency":"', currency, '"') END,
      ',"country":"', country, '","payment_method":"', payment_method, '"',
      CASE WHEN drift THEN ',"extra_field":"x"' ELSE '' END, '}') END AS value
  FROM checkout
)
"""


def checkout_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: typed columns, the fault flags and the JSON text in ``value``."""
    configure(spark)
    # A name of our own: a view called events may be the user's.
    spark.read.parquet(f"{sf_dir}/events.parquet").createOrReplaceTempView("sluiceway_events")
    raw = spark.sql(f"WITH events AS (SELECT * FROM sluiceway_events), {CHECKOUT_SQL} SELECT * FROM raw")
    return raw.withColumnRenamed("ts", "event_ts").withColumns({
        "order_id": F.concat(F.lit("ORD-"), F.col("order_no").cast("string")),
        "user_key": F.concat(F.lit("USR-"), F.col("user_id").cast("string")),
    })
