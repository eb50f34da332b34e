"""Transaction views over the given tables.

``txn`` is the typed transaction table. ``landing`` is the same data as a text
landing table shows it: header lines, exact copies, nulls, odd ids, odd labels and
odd timestamps are planted by id, so that every cleaning step has work to do at
every scale. No row of ``txn`` is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.functions.text import literal, name
from txnrisk.schemas import RAW_FIELDS

TYPES = {
    "click": "Online",
    "error": "ATM Withdrawal",
    "purchase": "POS",
    "signup": "Bank Transfer",
    "view": "Direct Debit",
}
SEGMENTS = {
    "AUTOMOBILE": "Travel",
    "BUILDING": "Electronics",
    "FURNITURE": "Clothing",
    "HOUSEHOLD": "Groceries",
    "MACHINERY": "Restaurants",
}
CITIES = ["Tokyo", "Mumbai", "London", "Sydney", "New York", "Cape Town"]
DEVICES = ["Mobile", "Tablet", "Laptop"]
CARDS = ["Visa", "Mastercard", "Amex", "Discover"]
AUTHS = ["Biometric", "Password", "OTP", "PIN"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index: str) -> str:
    return f"element_at(array({', '.join(map(literal, values))}), cast({index} + 1 AS int))"


def _lookup(mapping: dict[str, str], c: str) -> str:
    return f"CASE {c} " + " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in mapping.items()) + " END"


# Transaction columns over events (``k`` from its properties, ``at`` its time to the second) and customer.
TXN_SQL = {
    "transaction_id": "concat('TXN_', event_id)",
    "user_id": "concat('USER_', user_id)",
    "transaction_amount": "cast(value AS decimal(10,2))",
    "transaction_type": _lookup(TYPES, "event_type"),
    "timestamp": "at",
    "account_balance": "cast(c_acctbal AS decimal(10,2))",
    "device_type": _pick(DEVICES, "k % 3"),
    "location": _pick(CITIES, "c_nationkey % 6"),
    "merchant_category": _lookup(SEGMENTS, "c_mktsegment"),
    "ip_address_flag": "cast(k % 10 = 0 AS int)",
    "previous_fraudulent_activity": "cast(event_id % 10 = 0 AS int)",
    "daily_transaction_count": "cast(k % 14 + 1 AS int)",
    "avg_transaction_amount_7d": "cast(value * 2 AS decimal(10,2))",
    "failed_transaction_count_7d": "cast(k % 5 AS int)",
    "card_type": _pick(CARDS, "c_custkey % 4"),
    "card_age": "cast(user_id % 240 AS int)",
    "transaction_distance": "cast(k * 10.25 AS decimal(10,2))",
    "authentication_method": _pick(AUTHS, "event_id % 4"),
    "risk_score": "cast(k / 100 AS decimal(5,4))",
    "is_weekend": "cast(dayofweek(at) IN (1, 7) AS int)",
    "fraud_label": "cast(k >= 70 OR event_type = 'error' AS int)",
}

# Planted text defects by event id; other columns become text as they are.
TEXT_SQL = {
    "user_id": "CASE WHEN event_id % 41 = 6 THEN concat('GUEST_', user_id) "
    "WHEN event_id % 43 = 9 THEN concat('USER_', user_id) ELSE user_id END",
    "transaction_amount": "CASE WHEN event_id % 37 <> 11 THEN cast(transaction_amount AS string) END",
    # One constant format per branch: a format that is computed is looked up anew for every row.
    "timestamp": "CASE WHEN event_id % 29 = 4 THEN date_format(timestamp, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") "
    "ELSE date_format(timestamp, 'yyyy-MM-dd HH:mm:ss') END",
    "device_type": "CASE WHEN event_id % 53 = 2 THEN 'Smart-TV' ELSE device_type END",
    "location": "CASE WHEN event_id % 31 = 5 THEN NULL "
    "WHEN event_id % 31 = 6 AND location = 'New York' THEN 'New - York' ELSE location END",
}


def txn(spark: SparkSession, sf_dir: str, with_event_id: bool = False) -> DataFrame:
    """One transaction per event, with the account data of its customer.

    The join carries no broadcast hint: Spark broadcasts ``customer`` only below its
    size threshold, and beyond it sort-merges with skew splitting of hot users.
    """
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "cast(get_json_object(props, '$.k') AS int) AS k",
        "date_trunc('second', cast(ts AS timestamp)) AS at",
    )
    joined = events.join(table(spark, sf_dir, "customer"), F.expr("user_id = c_custkey"))
    extra = ["event_id"] if with_event_id else []
    return joined.selectExpr(*extra, *[f"{sql} AS {name(c)}" for c, sql in TXN_SQL.items()])


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``txn`` as text with planted defects: see FIXTURES.md.

    Some rows come twice (kind ``c``), some are followed by a header line (kind ``h``).
    """
    kinds = (
        "explode(concat(array('r'), CASE WHEN event_id % 20 = 3 THEN array('c') ELSE array() END, "
        "CASE WHEN event_id % 500 = 7 THEN array('h') ELSE array() END)) AS kind"
    )
    rows = txn(spark, sf_dir, with_event_id=True).selectExpr("*", kinds)
    return rows.selectExpr(
        *[
            f"CASE WHEN kind = 'h' THEN {literal(f.wire)} "
            f"ELSE {TEXT_SQL.get(f.name, f'cast({name(f.name)} AS string)')} END AS {name(f.name)}"
            for f in RAW_FIELDS
        ]
    )
