"""The end-to-end slice: landed messages to reconciled partner totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mailtally.operators.enrich import intake_summary
from mailtally.operators.routing import route_first
from mailtally.operators.upsert import merge_frames, newest_per_merge_key
from mailtally.plans import fixtures as fx
from mailtally.plans.oracle import RECORDS
from mailtally.plans.queries_messages import kv, kv_rules
from mailtally.plans.registry import query
from mailtally.sources.messages import standardize

KEYS = ["customer_code", "payment_due_label"]


@query(
    f"""
WITH {RECORDS}, merged AS (SELECT * FROM rec WHERE k % 17 <> 0
  QUALIFY row_number() OVER (PARTITION BY customer_code, short_label ORDER BY ts DESC, email_unique_id DESC) = 1)
SELECT customer_name, count(*) AS records, CAST(sum(CAST(payment_amount AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_amount
FROM merged GROUP BY 1
"""
)
def partner_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Standardise, route, extract, merge a late batch into an early one, summarise."""
    messages = standardize(fx.payloads(kv(spark, sf)))
    records = route_first(messages, kv_rules(), label_mode="normalized")
    early = F.col("received_ts") < F.lit("2000-01-01").cast("timestamp")
    stored = newest_per_merge_key(records.filter(early), KEYS)
    merged = merge_frames(stored, records.filter(~early), KEYS)
    return intake_summary(merged)
