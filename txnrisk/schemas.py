"""Table layouts, feature lists and the default category vocabulary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str  # column name in our tables
    wire: str  # field name in delimited files and in messages
    stored: str  # type in the transaction table
    message: str  # type in a message


# The transaction record, in file order.
RAW_FIELDS = (
    Field("transaction_id", "Transaction_ID", "string", "string"),
    Field("user_id", "User_ID", "string", "string"),
    Field("transaction_amount", "Transaction_Amount", "decimal(10,2)", "double"),
    Field("transaction_type", "Transaction_Type", "string", "string"),
    Field("timestamp", "Timestamp", "timestamp", "string"),
    Field("account_balance", "Account_Balance", "decimal(10,2)", "double"),
    Field("device_type", "Device_Type", "string", "string"),
    Field("location", "Location", "string", "string"),
    Field("merchant_category", "Merchant_Category", "string", "string"),
    Field("ip_address_flag", "IP_Address_Flag", "int", "string"),
    Field("previous_fraudulent_activity", "Previous_Fraudulent_Activity", "int", "string"),
    Field("daily_transaction_count", "Daily_Transaction_Count", "int", "int"),
    Field("avg_transaction_amount_7d", "Avg_Transaction_Amount_7d", "decimal(10,2)", "double"),
    Field("failed_transaction_count_7d", "Failed_Transaction_Count_7d", "int", "int"),
    Field("card_type", "Card_Type", "string", "string"),
    Field("card_age", "Card_Age", "int", "int"),
    Field("transaction_distance", "Transaction_Distance", "decimal(10,2)", "double"),
    Field("authentication_method", "Authentication_Method", "string", "string"),
    Field("risk_score", "Risk_Score", "decimal(5,4)", "double"),
    Field("is_weekend", "Is_Weekend", "int", "string"),
    Field("fraud_label", "Fraud_Label", "int", "int"),
)

# The lowest label, the id text in an embedded header line, formats.
EPOCH = "1970-01-01 00:00:00"
HEADER_ID = "Transaction_ID"
HEADER_TYPE = "transaction_type"
USER_PREFIX = "USER_"
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Categories to encode and their known values after normalisation.
VOCABULARY = {
    "transaction_type": ["pos", "bank_transfer", "online", "atm_withdrawal"],
    "device_type": ["mobile", "tablet", "laptop"],
    "location": ["tokyo", "mumbai", "london", "sydney", "new_york"],
    "merchant_category": ["restaurants", "clothing", "travel", "groceries", "electronics"],
    "card_type": ["mastercard", "amex", "discover", "visa"],
    "authentication_method": ["pin", "password", "biometric", "otp"],
}
CATEGORICALS = tuple(VOCABULARY)

# Feature order of the array route. ``risk_score`` counts twice.
V36_SCALARS = (
    "transaction_amount",
    "account_balance",
    "card_age",
    "ip_address_flag",
    "avg_transaction_amount_7d",
    "risk_score",
    "is_weekend",
    "risk_score",
    "previous_fraudulent_activity",
    "daily_transaction_count",
    "transaction_distance",
)
V36_BLOCKS = (
    "device_type",
    "merchant_category",
    "card_type",
    "location",
    "authentication_method",
    "transaction_type",
)

LABEL = "fraud_label"
RAW_COLUMNS = tuple(f.name for f in RAW_FIELDS)
WIRE_DDL = ", ".join(f"`{f.wire}` {f.stored}" for f in RAW_FIELDS)
CALENDAR = ("hour", "dayofweek", "dayofmonth")


_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "decimal(10,2)": T.DecimalType(10, 2),
    "decimal(5,4)": T.DecimalType(5, 4),
}


def raw_schema() -> T.StructType:
    return T.StructType([T.StructField(f.name, _TYPES[f.stored]) for f in RAW_FIELDS])


def text_schema() -> T.StructType:
    """The raw layout with every column still text, as a landing table shows it."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_FIELDS])


def message_schema(with_label: bool = False) -> T.StructType:
    """Message payload. Field names are the wire names: JSON matching is case-sensitive."""
    fields = [f for f in RAW_FIELDS if with_label or f.name != LABEL]
    return T.StructType([T.StructField(f.wire, _TYPES[f.message]) for f in fields])


def numeric_columns() -> list[str]:
    """Raw columns that enter the flattened feature vector as they are."""
    return [f.name for f in RAW_FIELDS if f.stored not in ("string", "timestamp") and f.name != LABEL]
