"""The registered queries as plain SQL over the same tables, written apart from the Spark code."""

from __future__ import annotations

from txnrisk.schemas import RAW_FIELDS, VOCABULARY

LAST = "TIMESTAMP '2024-01-20 12:00:00'"

# Values of the record layout, as the schema lists them.
COLUMNS = [f.name for f in RAW_FIELDS]
CATS = ["transaction_type", "device_type", "location", "merchant_category", "card_type", "authentication_method"]
MONEY = ["transaction_amount", "account_balance", "avg_transaction_amount_7d", "transaction_distance"]
FLAGS = ["ip_address_flag", "previous_fraudulent_activity", "is_weekend"]
COUNTS = ["daily_transaction_count", "failed_transaction_count_7d", "card_age"]
ALL = ", ".join(COLUMNS)

WIRE = {f.name: f.wire for f in RAW_FIELDS}

FIXED = {c: list(labels) for c, labels in VOCABULARY.items()}
SEEN = {
    "transaction_type": ["ATM Withdrawal", "Bank Transfer", "Direct Debit", "Online", "POS"],
    "device_type": ["Laptop", "Mobile", "Tablet"],
    "location": ["Cape Town", "London", "Mumbai", "New York", "Sydney", "Tokyo"],
    "merchant_category": ["Clothing", "Electronics", "Groceries", "Restaurants", "Travel"],
    "card_type": ["Amex", "Discover", "Mastercard", "Visa"],
    "authentication_method": ["Biometric", "OTP", "PIN", "Password"],
}


def _clean(label: str) -> str:
    return label.lower().replace(" ", "_").replace("-", "_")


def _norm(c: str) -> str:
    return rf"regexp_replace(lower({c}), '[\s-]+', '_', 'g')"


def _bucket(c: str, n: int = 100) -> str:
    return f"CAST(CAST('0x' || substr(md5({c}), 1, 8) AS BIGINT) % {n} AS INTEGER)"


TXN = """
src AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, date_trunc('second', ts) AS at
  FROM events
),
base AS (
  SELECT s.event_id,
    'TXN_' || s.event_id AS transaction_id,
    'USER_' || s.user_id AS user_id,
    CAST(s.value AS DECIMAL(10,2)) AS transaction_amount,
    CASE s.event_type WHEN 'click' THEN 'Online' WHEN 'error' THEN 'ATM Withdrawal' WHEN 'purchase' THEN 'POS'
      WHEN 'signup' THEN 'Bank Transfer' WHEN 'view' THEN 'Direct Debit' END AS transaction_type,
    s.at AS "timestamp",
    CAST(c.c_acctbal AS DECIMAL(10,2)) AS account_balance,
    CASE s.k % 3 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'Tablet' ELSE 'Laptop' END AS device_type,
    CASE c.c_nationkey % 6 WHEN 0 THEN 'Tokyo' WHEN 1 THEN 'Mumbai' WHEN 2 THEN 'London' WHEN 3 THEN 'Sydney'
      WHEN 4 THEN 'New York' ELSE 'Cape Town' END AS location,
    CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'Travel' WHEN 'BUILDING' THEN 'Electronics'
      WHEN 'FURNITURE' THEN 'Clothing' WHEN 'HOUSEHOLD' THEN 'Groceries'
      WHEN 'MACHINERY' THEN 'Restaurants' END AS merchant_category,
    CAST(s.k % 10 = 0 AS INTEGER) AS ip_address_flag,
    CAST(s.event_id % 10 = 0 AS INTEGER) AS previous_fraudulent_activity,
    CAST(s.k % 14 + 1 AS INTEGER) AS daily_transaction_count,
    CAST(s.value * 2 AS DECIMAL(10,2)) AS avg_transaction_amount_7d,
    CAST(s.k % 5 AS INTEGER) AS failed_transaction_count_7d,
    CASE c.c_custkey % 4 WHEN 0 THEN 'Visa' WHEN 1 THEN 'Mastercard' WHEN 2 THEN 'Amex' ELSE 'Discover' END
      AS card_type,
    CAST(s.user_id % 240 AS INTEGER) AS card_age,
    CAST(s.k * 10.25 AS DECIMAL(10,2)) AS transaction_distance,
    CASE s.event_id % 4 WHEN 0 THEN 'Biometric' WHEN 1 THEN 'Password' WHEN 2 THEN 'OTP' ELSE 'PIN' END
      AS authentication_method,
    CAST(s.k / 100.0 AS DECIMAL(5,4)) AS risk_score,
    CAST(dayofweek(s.at) IN (0, 6) AS INTEGER) AS is_weekend,
    CAST(s.k >= 70 OR s.event_type = 'error' AS INTEGER) AS fraud_label
  FROM src s JOIN customer c ON s.user_id = c.c_custkey
),
txn AS (SELECT * EXCLUDE (event_id) FROM base)"""


def _landing() -> str:
    text = {c: f"CAST({c} AS VARCHAR)" for c in COLUMNS}
    text["timestamp"] = (
        "CASE WHEN event_id % 29 = 4 THEN strftime(\"timestamp\", '%Y-%m-%dT%H:%M:%SZ') "
        "ELSE strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S') END"
    )
    text["user_id"] = (
        "CASE WHEN event_id % 41 = 6 THEN 'GUEST_' || user_id WHEN event_id % 43 = 9 THEN 'USER_' || user_id "
        "ELSE user_id END"
    )
    text["transaction_amount"] = "CASE WHEN event_id % 37 <> 11 THEN CAST(transaction_amount AS VARCHAR) END"
    text["location"] = (
        "CASE WHEN event_id % 31 = 5 THEN NULL WHEN event_id % 31 = 6 AND location = 'New York' THEN 'New - York' "
        "ELSE location END"
    )
    text["device_type"] = "CASE WHEN event_id % 53 = 2 THEN 'Smart-TV' ELSE device_type END"
    rows = ", ".join(f'{sql} AS "{c}"' for c, sql in text.items())
    header = ", ".join(f"'{WIRE[c]}'" for c in COLUMNS)
    return f"""{TXN},
dirty AS (SELECT event_id, {rows} FROM base),
landing AS (
  SELECT {ALL} FROM dirty
  UNION ALL SELECT {ALL} FROM dirty WHERE event_id % 20 = 3
  UNION ALL SELECT {header} FROM dirty WHERE event_id % 500 = 7
)"""


LANDING = _landing()


def _typed_column(c: str) -> str:
    if c == "timestamp":
        return "try_strptime(\"timestamp\", '%Y-%m-%d %H:%M:%S') AS \"timestamp\""
    if c in MONEY:
        return f"TRY_CAST({c} AS DECIMAL(10,2)) AS {c}"
    if c == "risk_score":
        return f"TRY_CAST({c} AS DECIMAL(5,4)) AS {c}"
    if c in FLAGS or c in COUNTS or c == "fraud_label":
        return f"TRY_CAST({c} AS INTEGER) AS {c}"
    return c


TYPED = f"{LANDING},\ntyped AS (SELECT {', '.join(_typed_column(c) for c in COLUMNS)} FROM landing)"
NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in COLUMNS)
CLEAN = f"{TYPED},\nclean AS (SELECT DISTINCT {ALL} FROM typed WHERE transaction_id <> 'Transaction_ID' AND {NOT_NULL})"
UNPREFIXED = "TRY_CAST(regexp_replace(user_id, '^USER_', '') AS INTEGER)"


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


def _onehots(labels: dict[str, list[str]], normalised: bool) -> list[str]:
    out = []
    for c, values in labels.items():
        source = _norm(c) if normalised else c
        for v in values:
            out.append(f"CASE WHEN {source} = '{v}' THEN 1 ELSE 0 END AS {c}_{_clean(v)}")
    return out


def _scored(source: str) -> str:
    margin = (
        "-3.0 + 0.002 * CAST(transaction_amount AS DOUBLE) + (-0.00003) * CAST(account_balance AS DOUBLE)"
        " + 4.0 * CAST(risk_score AS DOUBLE) + 0.6 * previous_fraudulent_activity"
        " + 0.1 * failed_transaction_count_7d + 0.01 * hour(\"timestamp\")"
        f" + 1.5 * CASE WHEN {_norm('transaction_type')} = 'atm_withdrawal' THEN 1 ELSE 0 END"
        f" + (-0.25) * CASE WHEN {_norm('location')} = 'new_york' THEN 1 ELSE 0 END"
    )
    return f"""scored AS (
  SELECT *, round(1.0 / (1.0 + exp(-margin)), 6) AS probability,
    CASE WHEN 1.0 / (1.0 + exp(-margin)) > 0.5 THEN 1.0 WHEN margin IS NULL THEN NULL ELSE 0.0 END AS raw_prediction
  FROM (SELECT *, CAST({margin} AS DOUBLE) AS margin FROM {source})
)"""


PREDICTION = "CAST(raw_prediction AS DOUBLE) AS prediction"
SCORED = f"{TXN},\n{_scored('txn')}"

_AUC = """
  SELECT sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM (
    SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY probability ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS below
    FROM (
      SELECT probability, CAST(count(*) FILTER (fraud_label = 1) AS DOUBLE) AS pos,
        CAST(count(*) FILTER (fraud_label = 0) AS DOUBLE) AS neg
      FROM scored GROUP BY probability
    )
  )"""
_PR = """
  SELECT sum(actual * CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END) / sum(actual) AS weighted_precision,
    sum(hits) / sum(actual) AS weighted_recall
  FROM (
    SELECT cls, CAST(count(*) FILTER (fraud_label = cls) AS DOUBLE) AS actual,
      CAST(count(*) FILTER (raw_prediction = cls) AS DOUBLE) AS predicted,
      CAST(count(*) FILTER (fraud_label = cls AND raw_prediction = cls) AS DOUBLE) AS hits
    FROM scored, (VALUES (0), (1)) AS classes(cls) GROUP BY cls
  )"""


def _v36() -> list[str]:
    out = [
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
    ]
    for c in [
        "device_type",
        "merchant_category",
        "card_type",
        "location",
        "authentication_method",
        "transaction_type",
    ]:
        out += [f"CASE WHEN {_norm(c)} = '{v}' THEN 1 ELSE 0 END" for v in FIXED[c]]
    return [f"CAST({e} AS DOUBLE) AS f_{i}" for i, e in enumerate(out)]


def _v40() -> list[str]:
    out = [
        "user_number",
        "transaction_amount",
        "account_balance",
        "ip_address_flag",
        "previous_fraudulent_activity",
        "daily_transaction_count",
        "avg_transaction_amount_7d",
        "failed_transaction_count_7d",
        "card_age",
        "transaction_distance",
        "risk_score",
        "is_weekend",
    ]
    for c, values in FIXED.items():
        out += [f"CASE WHEN {_norm(c)} = '{v}' THEN 1 ELSE 0 END" for v in values]
    out += ['hour("timestamp")', 'dayofweek("timestamp") + 1', 'dayofmonth("timestamp")']
    return [f"CAST({e} AS DOUBLE) AS f_{i}" for i, e in enumerate(out)]


def _label_counts(source: str, where: str = "TRUE", columns: list[str] = CATS) -> str:
    parts = [
        f"SELECT '{c}' AS column_name, {c} AS label, count(*) AS n_rows FROM {source} "
        f"WHERE {c} IS NOT NULL AND {where} GROUP BY {c}"
        for c in columns
    ]
    return " UNION ALL ".join(parts)


def _vocab(source: str, where: str = "TRUE", columns: list[str] = CATS) -> str:
    return f"""vocab AS (
  SELECT column_name, label, {_norm('label')} AS clean_label, n_rows,
    CAST(row_number() OVER (PARTITION BY column_name ORDER BY n_rows DESC, label) - 1 AS INTEGER) AS idx
  FROM ({_label_counts(source, where, columns)})
)"""


KNOWN = f"device_type <> 'Smart-TV' AND {_bucket('transaction_id')} < 70"
DATA = f"{LANDING},\ndata AS (SELECT * FROM landing WHERE transaction_id <> 'Transaction_ID')"


def _slots(cast: str, labels: dict[str, list[str]] = SEEN) -> str:
    """One-hot slots in vocabulary order: slot i of a column is 1 when its label has index i."""
    out = []
    for c, values in labels.items():
        for i in range(len(values)):
            label = f"(SELECT label FROM vocab WHERE column_name = '{c}' AND idx = {i})"
            out.append(f"CAST(CASE WHEN {c} = {label} THEN 1 ELSE 0 END AS {cast}) AS {c}_arr_{i}")
    return ", ".join(out)


def _indexes() -> str:
    out = []
    for c in CATS:
        known = f"(SELECT idx FROM vocab v WHERE v.column_name = '{c}' AND v.label = d.{c})"
        size = f"(SELECT count(*) FROM vocab v WHERE v.column_name = '{c}')"
        out.append(f"CAST(coalesce({known}, {size}) AS DOUBLE) AS {c}_idx")
    return ", ".join(out)


def _json_text() -> str:
    parts = []
    for c in COLUMNS:
        if c == "timestamp":
            value = "'\"' || strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S') || '\"'"
        elif c in CATS or c in ("transaction_id", "user_id"):
            value = f"'\"' || {c} || '\"'"
        else:
            value = f"CAST({c} AS VARCHAR)"
        parts.append(f"'\"{WIRE[c]}\":' || {value}")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


def _message_columns(label: bool = False) -> list[str]:
    out = []
    for c in COLUMNS:
        if c == "fraud_label" and not label:
            continue
        if c in MONEY or c == "risk_score":
            out.append(f"CAST({c} AS DOUBLE) AS {c}")
        elif c in FLAGS:
            out.append(f"CAST({c} AS VARCHAR) AS {c}")
        elif c == "timestamp":
            out.append("strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S') AS \"timestamp\"")
        else:
            out.append(c)
    return out


PART50 = _bucket("transaction_id", 50)
PART100 = _bucket("transaction_id", 100)
MESSAGES = f"{TXN},\nmsg AS (SELECT *, {PART50} AS part FROM txn)"
GOOD_MESSAGES = _with(MESSAGES, f"SELECT {', '.join(_message_columns())} FROM msg WHERE part NOT IN (7, 8)")
BAD_VALUE = (
    "CASE WHEN part = 7 THEN 'broken ' || transaction_id ELSE "
    "replace(json, '\"Card_Age\":' || card_age, '\"Card_Age\":\"old\"') END"
)
REJECTS = _with(
    f"{TXN},\nmsg AS (SELECT transaction_id, card_age, {_json_text()} AS json, {PART50} AS part FROM txn)",
    f"SELECT {BAD_VALUE} AS value, 'malformed message' AS reason FROM msg WHERE part IN (7, 8)",
)


def _decoded() -> str:
    out = []
    for column in _message_columns():
        expr, _, name = column.partition(" AS ")
        if column.startswith("CAST") or column.startswith("strftime"):
            expr, _, name = column.rpartition(" AS ")
        name = name or expr
        gone = "part IN (7, 8)" if name == "card_age" else "part = 7"
        out.append(f"CASE WHEN {gone} THEN NULL ELSE {expr} END AS {name}")
    return ", ".join(out)


_TYPED_INDEXED = f"""{TYPED},
ranked AS (
  SELECT *, row_number() OVER (ORDER BY "timestamp" NULLS LAST, transaction_id) - 1 AS i FROM typed
)"""
_INDEXED = f'{TXN},\nranked AS (SELECT *, row_number() OVER (ORDER BY "timestamp", transaction_id) - 1 AS i FROM txn)'
_FRESH = f'SELECT * FROM txn WHERE "timestamp" > {LAST}'
_SCORES = "transaction_id, probability, " + PREDICTION
_CURATED_LABELS = {
    **{c: [_clean(v) for v in values] for c, values in SEEN.items()},
    "device_type": ["laptop", "mobile", "tablet", "smart_tv"],
}
_CURATED_CLEAN = (
    f"{CLEAN},\ncurated AS (SELECT * REPLACE ({UNPREFIXED} AS user_id, "
    + ", ".join(f"{_norm(c)} AS {c}" for c in CATS)
    + ") FROM clean)"
)
_RAW_LABELS = {
    **SEEN,
    "device_type": [*SEEN["device_type"], "Smart-TV"],
    "location": [*SEEN["location"], "New - York"],
}
CURATED = _with(
    _CURATED_CLEAN,
    f"SELECT {ALL}, {', '.join(_onehots(_CURATED_LABELS, False))}, "
    'CAST(hour("timestamp") AS INTEGER) AS hour, CAST(dayofweek("timestamp") + 1 AS INTEGER) AS dayofweek, '
    'CAST(dayofmonth("timestamp") AS INTEGER) AS dayofmonth FROM curated',
)

ORACLES: dict[str, str] = {
    "filter_header": _with(DATA, "SELECT * FROM data"),
    "filter_header_curated": _with(DATA, "SELECT * FROM data"),
    "project_drop": _with(TXN, f"SELECT * EXCLUDE ({', '.join(CATS)}, \"timestamp\") FROM txn"),
    "project_select": _with(TXN, "SELECT transaction_id, transaction_amount AS amount, fraud_label FROM txn"),
    "clean_rows": _with(DATA, f"SELECT DISTINCT {ALL} FROM data WHERE {NOT_NULL}"),
    "fill_nulls": _with(
        TYPED,
        "SELECT * EXCLUDE (\"timestamp\") REPLACE (coalesce(transaction_amount, 0) AS transaction_amount, "
        "coalesce(card_age, 0) AS card_age, coalesce(location, 'Unknown') AS location) "
        "FROM typed WHERE transaction_id <> 'Transaction_ID'",
    ),
    "null_profile": _with(TYPED, "SELECT " + ", ".join(f"count(*) - count({c}) AS {c}" for c in COLUMNS) + " FROM typed"),
    "dup_profile": _with(
        LANDING,
        "SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM landing)) AS distinct_rows, "
        "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM landing)) AS duplicate_rows FROM landing",
    ),
    "type_rejects": _with(
        DATA,
        "SELECT transaction_id, \"timestamp\", 'bad timestamp' AS reason FROM data "
        "WHERE try_strptime(\"timestamp\", '%Y-%m-%d %H:%M:%S') IS NULL",
    ),
    "payload_validate": _with(
        TXN,
        f"SELECT transaction_id, CAST(CASE {_bucket('transaction_id', 20)} WHEN 3 THEN 11 WHEN 4 THEN 0 ELSE 17 END "
        f"AS INTEGER) AS n_features, {_bucket('transaction_id', 20)} NOT BETWEEN 3 AND 8 AS valid FROM txn",
    ),
    "payload_vector": _with(
        TXN,
        f"SELECT transaction_id, {', '.join(_v36())} FROM txn WHERE {_bucket('transaction_id', 20)} NOT BETWEEN 3 AND 8",
    ),
    "payload_score": _with(
        TXN,
        f"SELECT count(*) AS n_payloads, count(*) FILTER ({_bucket('transaction_id', 20)} BETWEEN 3 AND 8) AS n_rejected, "
        f"count(*) FILTER ({_bucket('transaction_id', 20)} NOT BETWEEN 3 AND 8) AS n_equal FROM txn",
    ),
    "clean_user": _with(
        LANDING,
        "SELECT transaction_id, regexp_replace(user_id, '^USER_', '') AS stripped, "
        "regexp_replace(user_id, 'USER_', '', 'g') AS stripped_all, "
        f"{UNPREFIXED} AS user_number, "
        "TRY_CAST(regexp_replace(user_id, 'USER_', '', 'g') AS INTEGER) AS user_number_all FROM landing",
    ),
    "normalize_categories": _with(
        LANDING,
        "SELECT transaction_id, "
        + ", ".join(f"{_norm(c)} AS {c}, translate(lower({c}), ' -', '__') AS {c}_plain" for c in CATS)
        + " FROM landing",
    ),
    "ts_parse": _with(
        DATA, "SELECT transaction_id, try_strptime(\"timestamp\", '%Y-%m-%d %H:%M:%S') AS ts FROM data"
    ),
    "calendar": _with(
        DATA,
        "SELECT transaction_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS dayofweek, "
        "CAST(dayofmonth(ts) AS INTEGER) AS dayofmonth FROM "
        "(SELECT transaction_id, try_strptime(\"timestamp\", '%Y-%m-%d %H:%M:%S') AS ts FROM data)",
    ),
    "round_probability": _with(
        TXN,
        "SELECT transaction_id, round(1 - CAST(risk_score AS DOUBLE) * CAST(0.731 AS DOUBLE), 2) AS p_0, "
        "round(CAST(risk_score AS DOUBLE) * CAST(0.731 AS DOUBLE), 2) AS p_1 FROM txn",
    ),
    "label_vocab": _with(f"{DATA},\n{_vocab('data')}", "SELECT * FROM vocab"),
    "label_index": _with(
        f"{DATA},\n{_vocab('data', KNOWN)}",
        f"SELECT transaction_id, {_indexes()} FROM data d",
    ),
    "index_by_join": _with(
        f"{DATA},\n{_vocab('data', f'{PART100} < 70', ['user_id'])}",
        "SELECT d.transaction_id, CAST(coalesce(v.idx, (SELECT count(*) FROM vocab)) AS DOUBLE) AS user_id_idx "
        "FROM data d LEFT JOIN vocab v ON v.label = d.user_id",
    ),
    "onehot_fixed": _with(
        DATA,
        f"SELECT transaction_id, {', '.join(f'{_norm(c)} AS {c}' for c in CATS)}, "
        f"{', '.join(_onehots(FIXED, True))} FROM data",
    ),
    "onehot_named": _with(TXN, f"SELECT transaction_id, {', '.join(_onehots(SEEN, False))} FROM txn"),
    "onehot_array": _with(f"{TXN},\n{_vocab('txn')}", f"SELECT transaction_id, {_slots('DOUBLE')} FROM txn"),
    "onehot_vector": _with(f"{TXN},\n{_vocab('txn')}", f"SELECT transaction_id, {_slots('DOUBLE')} FROM txn"),
    "flatten_array": _with(
        TXN,
        "SELECT transaction_id, daily_transaction_count AS counts_0, failed_transaction_count_7d AS counts_1, "
        "CASE WHEN ip_address_flag = 1 THEN NULL ELSE card_age END AS counts_2 FROM txn",
    ),
    "array_vector_roundtrip": _with(
        TXN,
        "SELECT transaction_id, CAST(transaction_amount AS DOUBLE) AS money_arr_0, "
        "CAST(account_balance AS DOUBLE) AS money_arr_1, CAST(risk_score AS DOUBLE) AS money_arr_2 FROM txn",
    ),
    "assemble_v36": _with(TXN, f"SELECT transaction_id, {', '.join(_v36())} FROM txn"),
    "assemble_v40": _with(
        f"{CLEAN},\nnumbered AS (SELECT *, {UNPREFIXED} AS user_number FROM clean)",
        f"SELECT transaction_id, {', '.join(_v40())} FROM numbered WHERE user_number IS NOT NULL",
    ),
    "unseen_labels": _with(
        f"{DATA},\nnormal AS (SELECT {', '.join(f'{_norm(c)} AS {c}' for c in CATS)} FROM data)",
        f"SELECT * FROM ({_label_counts('normal')}) WHERE NOT ("
        + " OR ".join(
            f"(column_name = '{c}' AND label IN ({', '.join(repr(v) for v in values)}))" for c, values in FIXED.items()
        )
        + ")",
    ),
    "watermark_max": _with(
        TYPED,
        "SELECT 'all' AS part, coalesce(max(\"timestamp\"), TIMESTAMP '1970-01-01') AS last_ts FROM typed UNION ALL "
        "SELECT 'none', coalesce(max(\"timestamp\"), TIMESTAMP '1970-01-01') FROM typed "
        "WHERE \"timestamp\" < TIMESTAMP '1990-01-01'",
    ),
    "incr_newer_than": _with(TXN, _FRESH),
    "incr_topn": _with(TXN, f'{_FRESH} ORDER BY "timestamp", transaction_id LIMIT 1000'),
    "incr_topn_ties": _with(
        f"{TXN},\nhourly AS (SELECT * REPLACE (date_trunc('hour', \"timestamp\") AS \"timestamp\") FROM txn)",
        "SELECT * EXCLUDE (r) FROM (SELECT *, rank() OVER (ORDER BY \"timestamp\") AS r FROM hourly "
        f'WHERE "timestamp" > {LAST}) WHERE r <= 1000',
    ),
    "incr_left_anti": _with(TXN, f"SELECT * FROM txn WHERE {PART100} >= 60"),
    "ordered_index": _with(_INDEXED, 'SELECT transaction_id, "timestamp", i AS row_index FROM ranked'),
    "incr_by_row_index": _with(
        _INDEXED, f"SELECT {ALL} FROM ranked WHERE i >= (SELECT count(*) FROM txn WHERE {PART100} < 60)"
    ),
    "page_offset": _with(TXN, 'SELECT * FROM txn ORDER BY "timestamp", transaction_id LIMIT 100 OFFSET 500'),
    "page_keyset": _with(TXN, 'SELECT * FROM txn ORDER BY "timestamp", transaction_id LIMIT 100 OFFSET 100'),
    "time_split": _with(
        f"{_INDEXED},\nn AS (SELECT CAST(floor(count(*) * 0.60) AS BIGINT) AS a, "
        "CAST(floor(count(*) * 0.20) AS BIGINT) AS b FROM txn)",
        "SELECT transaction_id, \"timestamp\", CASE WHEN i < (SELECT a FROM n) THEN 'full' "
        "WHEN i < (SELECT a + b FROM n) THEN 'incremental' ELSE 'stream' END AS split FROM ranked",
    ),
    "page_offset_far": _with(
        TYPED,
        'SELECT transaction_id, "timestamp" FROM typed ORDER BY "timestamp" NULLS LAST, transaction_id '
        'LIMIT 100 OFFSET (SELECT count("timestamp") - 40 FROM typed)',
    ),
    "rows_from_index_nulls": _with(
        _TYPED_INDEXED, 'SELECT transaction_id, "timestamp" FROM ranked WHERE i >= (SELECT count(*) * 3 // 4 FROM typed)'
    ),
    "time_split_nulls": _with(
        f"{_TYPED_INDEXED},\nn AS (SELECT CAST(floor(count(*) * 0.60) AS BIGINT) AS a, "
        "CAST(floor(count(*) * 0.20) AS BIGINT) AS b FROM typed)",
        "SELECT transaction_id, \"timestamp\", CASE WHEN i < (SELECT a FROM n) THEN 'full' "
        "WHEN i < (SELECT a + b FROM n) THEN 'incremental' ELSE 'stream' END AS split FROM ranked",
    ),
    "rf_train_score": _with(
        CLEAN,
        f"SELECT transaction_id, fraud_label, CAST(fraud_label AS DOUBLE) AS prediction FROM clean "
        f"WHERE {PART100} >= 70 AND {UNPREFIXED} IS NOT NULL",
    ),
    "lr_train_score": _with(
        f"{TYPED},\nrows AS (SELECT DISTINCT * FROM typed WHERE transaction_id <> 'Transaction_ID')",
        "SELECT transaction_id, fraud_label, CAST(fraud_label AS DOUBLE) AS prediction FROM rows "
        f"WHERE {PART100} >= 70 AND transaction_amount IS NOT NULL",
    ),
    "score_saved_forest": _with(
        CLEAN,
        "SELECT transaction_id, user_id, fraud_label, CAST(fraud_label AS DOUBLE) AS prediction FROM clean "
        f"WHERE {UNPREFIXED} IS NOT NULL",
    ),
    "evaluate_forest": "SELECT unnest(['AUC', 'Precision', 'Recall']) AS metric, 1.0 AS value",
    "curate_rejects": _with(
        f"{TYPED},\nrows AS (SELECT DISTINCT * FROM typed WHERE transaction_id <> 'Transaction_ID')",
        "SELECT transaction_id, \"timestamp\", concat_ws('; ', "
        + ", ".join(f"CASE WHEN {c} IS NULL THEN 'no {c}' END" for c in COLUMNS)
        + f") AS reason FROM rows WHERE NOT ({NOT_NULL})",
    ),
    "json_array_rejects": _with(
        MESSAGES,
        "SELECT CASE WHEN part = 6 THEN 'no JSON ' || transaction_id ELSE transaction_id END AS value, "
        "'malformed message' AS reason FROM msg WHERE part IN (6, 7)",
    ),
    "onehot_wide": _with(
        f"{TXN},\nvocab AS (SELECT transaction_id, row_number() OVER (ORDER BY count(*) DESC, transaction_id) - 1 AS i "
        f"FROM txn WHERE {PART100} < 70 GROUP BY transaction_id)",
        "SELECT t.transaction_id, coalesce(v.i, -1) AS place, CAST((SELECT count(*) FROM vocab) AS INTEGER) AS n_places "
        "FROM txn t LEFT JOIN vocab v USING (transaction_id)",
    ),
    "metric_auc_null_label": _with(
        f"{SCORED},\nm AS (SELECT s.probability AS p, s.fraud_label AS y FROM scored s JOIN txn t USING (transaction_id) "
        "WHERE t.card_age % 7 <> 0 AND t.card_age % 11 <> 0)",
        "SELECT round((SELECT sum(CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0.0 END) / count(*) "
        "FROM m a, m b WHERE a.y = 1 AND b.y = 0), 6) AS auc, "
        "(SELECT count(*) FROM txn WHERE card_age % 7 = 0 OR card_age % 11 = 0) AS n_unscored",
    ),
    "hash_split": _with(TXN, f"SELECT transaction_id, CAST({PART100} < 70 AS INTEGER) AS is_train FROM txn"),
    "json_encode": _with(TXN, f"SELECT transaction_id AS key, {_json_text()} AS value FROM txn"),
    "json_decode": _with(MESSAGES, f"SELECT {_decoded()}, CAST(part IN (7, 8) AS INTEGER) AS bad FROM msg"),
    "json_reject": REJECTS,
    "json_array_explode": _with(
        f"{MESSAGES},\nmany AS (SELECT * FROM msg WHERE part NOT IN (4, 6) UNION ALL SELECT * FROM msg WHERE part = 5)",
        f"SELECT {', '.join(_message_columns(label=True))} FROM many",
    ),
    "message_types": _with(MESSAGES, f"SELECT {', '.join(COLUMNS[:-1])} FROM msg WHERE part NOT IN (7, 8)"),
    "score_pinned": _with(SCORED, f"SELECT fraud_label, {_SCORES} FROM scored"),
    "score_landing": _with(
        f"{CLEAN},\nnumbered AS (SELECT * REPLACE ({UNPREFIXED} AS user_id) FROM clean),\n{_scored('numbered')}",
        f"SELECT {ALL}, probability, {PREDICTION} FROM scored",
    ),
    "score_join_back": _with(
        f"{TYPED},\ndata AS (SELECT * FROM typed WHERE transaction_id <> 'Transaction_ID'),\n{_scored('data')}",
        f"SELECT {ALL}, {PREDICTION} FROM scored",
    ),
    "score_new": _with(SCORED, f"SELECT {_SCORES} FROM scored"),
    "metric_auc": _with(SCORED, f"SELECT round(auc, 6) AS auc FROM ({_AUC})"),
    "metric_confusion": _with(
        SCORED,
        "SELECT CAST(fraud_label AS DOUBLE) AS label, CAST(raw_prediction AS DOUBLE) AS prediction, "
        "count(*) AS n_rows FROM scored GROUP BY ALL",
    ),
    "metric_weighted_pr": _with(
        SCORED,
        "SELECT round(weighted_precision, 6) AS weighted_precision, round(weighted_recall, 6) AS weighted_recall "
        f"FROM ({_PR})",
    ),
    "metrics_report": _with(
        SCORED,
        f"SELECT 'AUC' AS metric, round(auc, 4) AS value FROM ({_AUC}) UNION ALL "
        f"SELECT 'Precision', round(weighted_precision, 4) FROM ({_PR}) UNION ALL "
        f"SELECT 'Recall', round(weighted_recall, 4) FROM ({_PR})",
    ),
    "src_csv_roundtrip": _with(TXN, "SELECT * FROM txn"),
    "src_parquet_roundtrip": _with(TXN, "SELECT * FROM txn"),
    "src_external_table": _with(TXN, "SELECT * FROM txn"),
    "src_catalog_scan": _with(
        TXN, "SELECT transaction_id, user_id, transaction_amount FROM txn WHERE fraud_label = 1"
    ),
    "sink_insert_by_name": _with(TXN, "SELECT transaction_id, user_id, card_type, device_type FROM txn"),
    "load_full": _with(
        _INDEXED,
        f"SELECT {ALL}, 1 AS load FROM ranked UNION ALL SELECT {ALL}, 2 AS load FROM ranked WHERE i >= (SELECT CAST(floor(count(*) * 0.60) AS BIGINT) "
        "+ CAST(floor(count(*) * 0.20) AS BIGINT) FROM txn)",
    ),
    "load_incremental": _with(
        f"{TXN},\nfirst AS (SELECT *, rank() OVER (ORDER BY \"timestamp\") AS r FROM txn WHERE \"timestamp\" > {LAST}),\n"
        "second AS (SELECT *, rank() OVER (ORDER BY \"timestamp\") AS r2 FROM first WHERE r > 1000)",
        f'SELECT transaction_id, "timestamp" FROM txn WHERE "timestamp" <= {LAST} UNION ALL '
        'SELECT transaction_id, "timestamp" FROM first WHERE r <= 1000 UNION ALL '
        'SELECT transaction_id, "timestamp" FROM second WHERE r2 <= 1000',
    ),
    "import_new": _with(TXN, "SELECT * FROM txn"),
    "split_files": _with(
        f"{_INDEXED},\nn AS (SELECT CAST(floor(count(*) * 0.60) AS BIGINT) AS a, "
        "CAST(floor(count(*) * 0.20) AS BIGINT) AS b FROM txn)",
        f"SELECT {ALL}, CASE WHEN i < (SELECT a FROM n) THEN 'full' WHEN i < (SELECT a + b FROM n) THEN 'incremental' "
        "ELSE 'stream' END AS split FROM ranked",
    ),
    "append_csv": _with(TXN, "SELECT * FROM txn"),
    "stream_ingest_csv": _with(
        MESSAGES,
        "SELECT transaction_id, user_id, CAST(card_age AS VARCHAR) AS card_age, location FROM msg WHERE part NOT IN (7, 8)",
    ),
    "curate_full": CURATED,
    "curate_incremental": CURATED,
    "curate_arrays": _with(
        f"{TYPED},\ndistincts AS (SELECT DISTINCT {ALL} FROM typed WHERE transaction_id <> 'Transaction_ID'),\n"
        f"{_vocab('distincts')}",
        "SELECT "
        + ", ".join(c for c in COLUMNS if c not in CATS and c != "user_id")
        + ", TRY_CAST(regexp_replace(user_id, 'USER_', '', 'g') AS INTEGER) AS user_id, "
        + _slots("DOUBLE", _RAW_LABELS)
        + " FROM distincts",
    ),
    "stream_ingest": GOOD_MESSAGES,
    "stream_rejects": REJECTS,
    "stream_restart": GOOD_MESSAGES,
    "stream_publish": _with(TXN, f"SELECT transaction_id AS key, {_json_text()} AS value FROM txn"),
    "stream_score": _with(SCORED, f"SELECT {_SCORES} FROM scored"),
    "model_roundtrip": _with(
        TXN,
        f"SELECT count(*) AS n_scored, CAST(0 AS BIGINT) AS n_changed, CAST(0 AS BIGINT) AS n_not_one, "
        f"CAST(0 AS BIGINT) AS n_not_argmax FROM txn WHERE {PART100} >= 70",
    ),
}


# Messages and payloads with nulls and numbers that are none.
ORACLES["json_nulls"] = _with(
    f"{TXN},\nmsg AS (SELECT transaction_id, card_age, {_json_text()} AS json, {PART50} AS part FROM txn),\n"
    f"bad AS (SELECT {BAD_VALUE} AS value FROM msg WHERE part IN (7, 8) UNION ALL SELECT '' FROM msg WHERE part = 9)",
    "SELECT (SELECT count(*) FROM msg WHERE part NOT IN (7, 8, 9)) AS accepted, value, 'malformed message' AS reason, "
    "count(*) AS count, 'values' AS form FROM bad GROUP BY value UNION ALL "
    "SELECT count(*), '', 'malformed message', count(*), 'arrays' FROM msg WHERE part = 9 HAVING count(*) > 0",
)
ORACLES["payload_nonfinite"] = _with(
    TXN, f"SELECT transaction_id, {_bucket('transaction_id', 20)} NOT BETWEEN 3 AND 11 AS valid FROM txn"
)
_LOOSE = f"""{TXN},
loose AS (SELECT transaction_id, CAST(card_age AS VARCHAR) AS card_age, CAST(risk_score AS DOUBLE) AS risk_score, location,
  {PART50} AS part FROM txn),
items AS (
  SELECT *, 0 AS item FROM loose WHERE part NOT IN (6, 8, 9)
  UNION ALL SELECT *, 1 FROM loose WHERE part = 7
)"""
ORACLES["json_infer"] = _with(
    _LOOSE,
    "SELECT transaction_id, CASE part WHEN 3 THEN NULL WHEN 5 THEN 'old' ELSE card_age END AS card_age, risk_score, location, "
    "CASE WHEN part = 4 THEN 'by hand' END AS \"Free note\", NULL AS bad FROM items "
    "UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, 'broken ' || transaction_id FROM loose WHERE part = 6 "
    "UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, unnest(['5', '']) FROM loose WHERE part = 7 "
    "UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, '' FROM loose WHERE part = 9",
)
ORACLES["json_infer_schema"] = (
    "SELECT unnest(['Card_Age', 'Free note', 'Location', 'Risk_Score', 'Transaction_ID']) AS field, "
    "unnest(['string', 'string', 'string', 'double', 'string']) AS type"
)

# Tables that grow and are replaced.
ORACLES["load_swap"] = CURATED
ORACLES["watermark_footer"] = _with(
    TXN,
    f'SELECT max("timestamp") AS last_ts, CAST(1 AS INTEGER) AS load FROM txn WHERE "timestamp" <= {LAST} '
    'UNION ALL SELECT max("timestamp"), 2 FROM txn',
)
ORACLES["catalog_partitions"] = _with(
    f'{TXN},\ndays AS (SELECT transaction_id, CAST("timestamp" AS DATE) AS event_date FROM txn)',
    "SELECT transaction_id, event_date, CAST(1 AS INTEGER) AS step FROM days WHERE event_date IN ('2024-01-10', '2024-01-12') "
    "UNION ALL SELECT transaction_id, event_date, 2 FROM days WHERE event_date BETWEEN '2024-01-10' AND '2024-01-14'",
)
ORACLES["score_bucketed"] = ORACLES["score_new"]
_STEPS = [
    "\"timestamp\" < '2024-01-02'",
    "\"timestamp\" >= '2024-01-02' AND \"timestamp\" < '2024-01-04'",
    "\"timestamp\" >= '2024-01-04'",
]
_STEP_COUNTS = " UNION ALL ".join(
    f"SELECT {i} AS step, * FROM ({_label_counts('typed', where, [*CATS, 'user_id'])})" for i, where in enumerate(_STEPS)
)
ORACLES["vocab_merge"] = _with(
    f"{TYPED},\ncounts AS ({_STEP_COUNTS}),\n"
    "first AS (SELECT column_name, label, min(step) AS step, min_by(n_rows, step) AS n_first, sum(n_rows) AS n_rows "
    "FROM counts GROUP BY column_name, label)",
    f"SELECT column_name, label, {_norm('label')} AS clean_label, CAST(n_rows AS BIGINT) AS n_rows, "
    "CAST(row_number() OVER (PARTITION BY column_name ORDER BY step, n_first DESC, label) - 1 AS INTEGER) AS idx FROM first",
)
ORACLES["score_rejects"] = _with(
    f"{TYPED},\nrows AS (SELECT DISTINCT * FROM typed WHERE transaction_id <> 'Transaction_ID')",
    "SELECT transaction_id, \"timestamp\", concat_ws('; ', "
    + ", ".join(f"CASE WHEN {c} IS NULL THEN 'no {c}' END" for c in COLUMNS)
    + f", CASE WHEN {UNPREFIXED} IS NULL AND user_id IS NOT NULL THEN 'user_id is no number' END) AS reason, "
    f"CAST(0 AS BIGINT) AS n_missing FROM rows WHERE NOT ({NOT_NULL}) OR {UNPREFIXED} IS NULL",
)

# Streams with state or a position.
ORACLES["stream_score_dedup"] = ORACLES["stream_score"]
ORACLES["stream_score_forest"] = ORACLES["score_saved_forest"]
ORACLES["stream_metrics"] = ORACLES["metrics_report"]
ORACLES["stream_from_keyset"] = _with(
    f'{TXN},\nlater AS (SELECT * FROM txn WHERE "timestamp" > {LAST})',
    f"SELECT transaction_id AS key, {_json_text()} AS value FROM later WHERE (\"timestamp\", transaction_id) > "
    '(SELECT ("timestamp", transaction_id) FROM later ORDER BY "timestamp", transaction_id LIMIT 1)',
)
ORACLES["stream_from_latest"] = _with(
    TXN, f"SELECT transaction_id AS key, {_json_text()} AS value FROM txn WHERE \"timestamp\" >= '2024-01-22'"
)
