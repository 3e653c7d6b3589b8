"""Payments tables derived from the driver's TPC-H-like parquet tables.

The mapping (see FIXTURES.md) is deterministic and written once here; every
query reads ``merchants`` / ``customers`` / ``transactions`` through a
:class:`Tables` object, either derived from the raw tables (``from_raw``) or
from a loaded warehouse (``from_warehouse``).
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas

# Fixture mapping constants.
INDUSTRIES = ["Retail", "Food & Beverage", "Travel", "Entertainment", "SaaS", "Gaming", "Marketplace"]
SALES_CHANNELS = ["direct", "partner", "online"]
EPOCH = "1995-01-01"
SIGNUP_SPREAD_DAYS = 1500
MERCHANT_DATE_MULT = 53
CUSTOMER_DATE_MULT = 37
FEE_SHARE = "0.25"

RAW_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _pick(index: Column, values: list[str]) -> Column:
    out = None
    for i, v in enumerate(values):
        out = F.when(index == i, F.lit(v)) if out is None else out.when(index == i, F.lit(v))
    return out


def merchants_from_raw(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    s = supplier.select("s_suppkey", "s_nationkey", "s_acctbal")
    return (
        s.join(F.broadcast(geo), s.s_nationkey == geo.n_nationkey)  # nation x region: 25 rows
        .select(
            F.col("s_suppkey").cast("bigint").alias("merchant_id"),
            _pick(F.col("s_suppkey") % 7, INDUSTRIES).alias("industry"),
            F.col("r_name").alias("region"),
            F.when(F.col("s_acctbal") < 2000, "small").when(F.col("s_acctbal") < 7000, "medium")
            .otherwise("enterprise").alias("merchant_size"),
            _pick(F.col("s_suppkey") % 3, SALES_CHANNELS).alias("sales_channel"),
            F.date_add(F.lit(EPOCH).cast("date"),
                       ((F.col("s_suppkey") * MERCHANT_DATE_MULT) % SIGNUP_SPREAD_DAYS).cast("int"))
            .alias("signup_date"),
        )
    )


def customers_from_raw(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    c = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    return (
        c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey)
        .select(
            F.col("c_custkey").cast("bigint").alias("customer_id"),
            F.col("c_mktsegment").alias("segment"),
            F.col("r_name").alias("region"),
            F.date_add(F.lit(EPOCH).cast("date"),
                       ((F.col("c_custkey") * CUSTOMER_DATE_MULT) % SIGNUP_SPREAD_DAYS).cast("int"))
            .alias("join_date"),
        )
    )


def transactions_from_raw(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_suppkey", "l_linenumber", "l_extendedprice",
                         "l_tax", "l_returnflag", "l_shipdate")
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    amount = F.col("l_extendedprice").cast(schemas.MONEY)
    approved = F.col("l_returnflag") != F.lit("R")
    fee = (amount * F.col("l_tax").cast("decimal(4,2)") * F.lit(FEE_SHARE).cast("decimal(3,2)")).cast(schemas.FEE)
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)  # fact x fact: shuffle join on the order key
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("txn_id"),
            F.col("l_shipdate").cast("timestamp_ntz").alias("ts"),
            F.to_date("l_shipdate").alias("txn_date"),
            F.col("l_suppkey").cast("bigint").alias("merchant_id"),
            F.col("o_custkey").cast("bigint").alias("customer_id"),
            amount.alias("amount"),
            F.lit("USD").alias("currency"),
            approved.alias("approved"),
            F.when(F.col("o_orderstatus") == "F", "card").when(F.col("o_orderstatus") == "O", "ach")
            .when(F.col("o_orderstatus") == "P", "wallet").alias("payment_method"),
            F.when(approved, F.lit(None).cast("string"))
            .otherwise(_pick(F.col("l_linenumber") % 5, schemas.DECLINE_REASONS)).alias("decline_reason"),
            fee.alias("fee"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "pos")
            .when(F.col("o_orderpriority") == "5-LOW", "inapp").otherwise("ecom").alias("channel"),
            F.year("l_shipdate").cast("int").alias("partition_year"),
            F.month("l_shipdate").cast("int").alias("partition_month"),
        )
    )


class Tables:
    """Access to the three payments tables."""

    def __init__(self, spark: SparkSession, loader, label: str, folder: str | None = None):
        self.spark = spark
        self._loader = loader
        self.label = label
        #: Where the files of a loaded warehouse are.
        self.folder = folder

    @classmethod
    def from_raw(cls, spark: SparkSession, sf_dir: str) -> "Tables":
        def load(name: str) -> DataFrame:
            raw = lambda t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet")
            if name == "merchants":
                return merchants_from_raw(raw("supplier"), raw("nation"), raw("region"))
            if name == "customers":
                return customers_from_raw(raw("customer"), raw("nation"), raw("region"))
            if name == "transactions":
                return transactions_from_raw(raw("lineitem"), raw("orders"))
            return raw(name)
        return cls(spark, load, f"raw:{sf_dir}")

    @classmethod
    def from_warehouse(cls, spark: SparkSession, path: str) -> "Tables":
        def load(name: str) -> DataFrame:
            df = spark.read.schema(schemas.SCHEMAS[name]).parquet(f"{path.rstrip('/')}/{name}")
            return df
        return cls(spark, load, f"warehouse:{path}", path.rstrip("/"))

    @classmethod
    def from_frames(cls, spark: SparkSession, **frames: DataFrame) -> "Tables":
        """Tables over given DataFrames (typed to the warehouse schemas); for tests."""
        def load(name: str) -> DataFrame:
            df = frames[name]
            return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                               for f in schemas.SCHEMAS[name].fields if f.name in df.columns])
        return cls(spark, load, "frames")

    @cached_property
    def merchants(self) -> DataFrame:
        return self._loader("merchants")

    @cached_property
    def customers(self) -> DataFrame:
        return self._loader("customers")

    @cached_property
    def transactions(self) -> DataFrame:
        return self._loader("transactions")

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def replace(self, **frames: DataFrame) -> "Tables":
        """These tables with some replaced."""
        return Tables(self.spark, lambda name: frames.get(name, None) if name in frames else self.table(name), self.label)

    @classmethod
    def from_payments(cls, spark: SparkSession, path: str) -> "Tables":
        """Tables over raw payments files: merchants.parquet, customers.parquet and a
        transactions/year=/month= tree, cast to the warehouse schemas.

        txn_date is the day of ts, and partition_year and partition_month come from the folders.
        """
        base = path.rstrip("/")

        def load(name: str) -> DataFrame:
            if name == "transactions":
                raw = spark.read.option("recursiveFileLookup", "false").parquet(f"{base}/transactions")
                raw = raw.withColumns({"txn_date": F.to_date("ts"), "partition_year": F.col("year"), "partition_month": F.col("month")})
            else:
                raw = spark.read.parquet(f"{base}/{name}.parquet")
            return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.SCHEMAS[name].fields])
        return cls(spark, load, f"payments:{base}")
