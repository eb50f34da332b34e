from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from txnrisk.operators import messages
from txnrisk.schemas import message_schema

# An invented record: an evening transfer from a laptop.
MESSAGE = {
    "Transaction_ID": "A-77",
    "User_ID": "USER_5210",
    "Transaction_Amount": 58.2,
    "Transaction_Type": "Bank Transfer",
    "Timestamp": "2023-11-04 21:37:55",
    "Account_Balance": 7310.0,
    "Device_Type": "Laptop",
    "Location": "Sydney",
    "Merchant_Category": "Travel",
    "IP_Address_Flag": "1",
    "Previous_Fraudulent_Activity": "0",
    "Daily_Transaction_Count": 9,
    "Avg_Transaction_Amount_7d": 41.75,
    "Failed_Transaction_Count_7d": 3,
    "Card_Type": "Discover",
    "Card_Age": 88,
    "Transaction_Distance": 640.25,
    "Authentication_Method": "Biometric",
    "Risk_Score": 0.8125,
    "Is_Weekend": "1",
}


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_one_message_decodes_and_can_be_stamped(spark):
    rows = messages.accepted(messages.decode(values(spark, json.dumps(MESSAGE))))
    row = rows.withColumn("time_details", F.current_timestamp()).first()
    assert rows.count() == 1 and len(rows.columns) == 20
    assert (row["transaction_id"], row["transaction_amount"]) == ("A-77", 58.2)
    assert row["time_details"] is not None


def test_binary_values_decode_too(spark):
    raw = values(spark, json.dumps(MESSAGE)).select(F.encode("value", "utf-8").alias("value"))
    assert messages.accepted(messages.decode(raw)).first()["card_age"] == 88


def test_array_of_one_object(spark):
    text = json.dumps([{**MESSAGE, "Transaction_ID": "B-9", "IP_Address_Flag": False, "Fraud_Label": 0}])
    rows = messages.explode_array(values(spark, text, "[]"))
    assert rows.where("transaction_id = 'B-9'").count() == rows.count() == 1
    assert rows.first()["ip_address_flag"] == "false" and rows.first()["fraud_label"] == 0


@pytest.mark.parametrize(
    ("text", "bad", "field", "want"),
    [
        ("not json", True, "transaction_id", None),
        (json.dumps({**MESSAGE, "Card_Age": "old"}), True, "card_age", None),
        (json.dumps({**MESSAGE, "Card_Age": "old"}), True, "transaction_id", "A-77"),
        (json.dumps({**MESSAGE, "User_ID": 7}), False, "user_id", "7"),
        (json.dumps({k: v for k, v in MESSAGE.items() if k != "Card_Age"}), False, "card_age", None),
    ],
)
def test_odd_messages(spark, text, bad, field, want):
    row = messages.decode(values(spark, text)).first()
    assert (row[messages.CORRUPT] is not None) == bad
    assert row[field] == want


def test_rejects_and_accepted_are_whole(spark):
    decoded = messages.decode(values(spark, "not json", json.dumps(MESSAGE), "[]"))
    assert messages.accepted(decoded).count() + messages.rejected(decoded).count() == 3
    assert "not json" in [r["value"] for r in messages.rejected(decoded).collect()]


def test_arrays_are_whole(spark):
    good = json.dumps(MESSAGE)
    texts = [f"[{good}, {good}]", f'[{good}, "x", 5]', "[", "", json.dumps([{**MESSAGE, "Card_Age": "old"}]), good]
    df = values(spark, *texts)
    assert messages.explode_array(df).count() == 4
    assert {r["value"] for r in messages.array_rejects(df).collect()} >= {"x", "5", "["}
    assert messages.array_rejects(df).count() + 4 == messages.array_items(df).count()


def test_encode_decode_keeps_every_row(spark, txn):
    back = messages.decode(messages.encode(txn), message_schema(with_label=True))
    typed = messages.type_message(messages.accepted(back))
    same = txn.select(*typed.columns)
    assert typed.exceptAll(same).isEmpty() and same.exceptAll(typed).isEmpty()


def test_nulls_are_left_out_of_messages(spark):
    df = spark.createDataFrame([("a", None)], "transaction_id string, card_age int")
    assert messages.encode(df).first()["value"] == '{"Transaction_ID":"a"}'


def test_flag_words(spark):
    df = spark.createDataFrame([("yes",), ("No",), ("1",), ("0",), ("maybe",), ("true",)], "is_weekend string")
    assert [r[0] for r in messages.type_message(df).collect()] == [1, 0, 1, 0, None, 1]
