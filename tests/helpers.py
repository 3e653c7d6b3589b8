"""Micro-table builders for edge-case tests."""
from __future__ import annotations

import datetime as dt
from decimal import Decimal

from ledgerlens.sources.fixtures import Tables

SF_SMALL = "/root/testdata/sf0.001"


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def txn(i, day, merchant=1, customer=1, amount="100.00", approved=True, method="card", channel="pos",
        reason=None, fee="1.000000"):
    day_ = d(day)
    return dict(txn_id=i, ts=dt.datetime(day_.year, day_.month, day_.day, 12, 0), txn_date=day_,
                merchant_id=merchant, customer_id=customer, amount=Decimal(amount), currency="USD",
                approved=approved, payment_method=method,
                decline_reason=None if approved else (reason or "fraud_suspected"),
                fee=Decimal(fee), channel=channel, partition_year=day_.year, partition_month=day_.month)


def merchant(mid, signup="2024-01-01", industry="Retail", region="EUROPE", size="small", channel="direct"):
    return dict(merchant_id=mid, industry=industry, region=region, merchant_size=size, sales_channel=channel,
                signup_date=d(signup))


def customer(cid, join="2024-01-01", segment="BUILDING", region="EUROPE"):
    return dict(customer_id=cid, segment=segment, region=region, join_date=d(join))


TXN_DDL = ("txn_id bigint, ts timestamp_ntz, txn_date date, merchant_id bigint, customer_id bigint, "
           "amount decimal(18,2), currency string, approved boolean, payment_method string, decline_reason string, "
           "fee decimal(24,6), channel string, partition_year int, partition_month int")
MER_DDL = "merchant_id bigint, industry string, region string, merchant_size string, sales_channel string, signup_date date"
CUS_DDL = "customer_id bigint, segment string, region string, join_date date"


def tables(spark, txns, merchants=None, customers=None) -> Tables:
    merchants = merchants or [merchant(m) for m in sorted({t["merchant_id"] for t in txns})]
    customers = customers or [customer(c) for c in sorted({t["customer_id"] for t in txns})]
    cols = [c.split()[0] for c in TXN_DDL.split(", ")]
    tx = spark.createDataFrame([tuple(t[c] for c in cols) for t in txns], TXN_DDL)
    mcols = [c.split()[0] for c in MER_DDL.split(", ")]
    me = spark.createDataFrame([tuple(m[c] for c in mcols) for m in merchants], MER_DDL)
    ccols = [c.split()[0] for c in CUS_DDL.split(", ")]
    cu = spark.createDataFrame([tuple(c[k] for k in ccols) for c in customers], CUS_DDL)
    return Tables.from_frames(spark, transactions=tx, merchants=me, customers=cu)


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=lambda x: tuple(str(v) for v in x))
