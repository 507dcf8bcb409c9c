"""Declared schemas: raw landing (all strings) and the curated contract."""
from pyspark.sql import types as T

S = T.StringType()


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, S, True) for n in names])


# Raw CSV landing zone: read as text, typed by the pipeline (never inferred).
RAW_TRANSACTIONS = _strings(
    "transaction_id", "customer_id", "product_id", "transaction_date", "amount",
    "quantity", "promo_code", "ingestion_timestamp", "source_file",
)
RAW_CUSTOMERS = _strings("customer_id", "customer_name", "email", "region", "signup_date")
RAW_PRODUCTS = _strings("product_id", "product_name", "category", "unit_price")

MONEY = T.DecimalType(10, 2)

CURATED_TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", S),
    T.StructField("customer_id", S),
    T.StructField("product_id", S),
    T.StructField("amount", MONEY),
    T.StructField("transaction_date", T.DateType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("promo_code", S),
    T.StructField("is_imputed", T.BooleanType()),
    T.StructField("ingestion_timestamp", T.TimestampType()),
    T.StructField("source_file", S),
    T.StructField("run_id", S),
    T.StructField("year", S),
    T.StructField("month", S),
    T.StructField("day", S),
])

CURATED_CUSTOMERS = T.StructType([
    T.StructField("customer_id", S),
    T.StructField("customer_name", S),
    T.StructField("email", S),
    T.StructField("region", S),
    T.StructField("signup_date", T.DateType()),
])

CURATED_PRODUCTS = T.StructType([
    T.StructField("product_id", S),
    T.StructField("product_name", S),
    T.StructField("category", S),
    T.StructField("unit_price", MONEY),
])

REJECTED_TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", S),
    T.StructField("customer_id", S),
    T.StructField("product_id", S),
    T.StructField("amount", MONEY),
    T.StructField("transaction_date", T.DateType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("promo_code", S),
    T.StructField("ingestion_timestamp", T.TimestampType()),
    T.StructField("source_file", S),
    T.StructField("reject_reason", S),
    T.StructField("run_id", S),
])

RUN_METRICS = T.StructType([
    T.StructField("run_id", S),
    T.StructField("stage", S),
    T.StructField("raw_count", T.LongType()),
    T.StructField("rejected_count", T.LongType()),
    T.StructField("curated_count", T.LongType()),
    T.StructField("ts", S),
])


def names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]
