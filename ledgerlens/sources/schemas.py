"""Typed table schemas of the payments warehouse.

Money is held as exact decimals (sums do not depend on partition order) and
turned into DOUBLE only at query outputs.
"""
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
FEE = T.DecimalType(24, 6)

MERCHANTS = T.StructType([
    T.StructField("merchant_id", T.LongType()),
    T.StructField("industry", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("merchant_size", T.StringType()),
    T.StructField("sales_channel", T.StringType()),
    T.StructField("signup_date", T.DateType()),
])

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("segment", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("join_date", T.DateType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("txn_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("txn_date", T.DateType()),
    T.StructField("merchant_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("amount", MONEY),
    T.StructField("currency", T.StringType()),
    T.StructField("approved", T.BooleanType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("decline_reason", T.StringType()),
    T.StructField("fee", FEE),
    T.StructField("channel", T.StringType()),
    T.StructField("partition_year", T.IntegerType()),
    T.StructField("partition_month", T.IntegerType()),
])

# Declared by the warehouse DDL but never loaded or queried.
CAMPAIGNS = T.StructType([
    T.StructField("campaign_id", T.LongType()),
    T.StructField("campaign_name", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("end_date", T.DateType()),
    T.StructField("budget", T.DoubleType()),
])

SCHEMAS = {
    "merchants": MERCHANTS,
    "customers": CUSTOMERS,
    "transactions": TRANSACTIONS,
    "campaigns": CAMPAIGNS,
}

# Categorical domains of the payments data.
CHANNELS = ["pos", "ecom", "inapp"]
PAYMENT_METHODS = ["card", "ach", "wallet"]
DECLINE_REASONS = ["insufficient_funds", "fraud_suspected", "network_error",
                   "limit_exceeded", "regulatory_block"]
