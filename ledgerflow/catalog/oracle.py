"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

from ledgerflow.catalog.feed import API_MISSING, API_NULLS, COUNTRIES
from ledgerflow.schema import ALLOWED_VALUES, CONTRACT_PATTERNS, CURRENCIES, FIELDS, MERCHANT_CATEGORIES, NATURAL_KEY


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(value) for value in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(_text(value) for value in values) + ")"


BUSINESS = ", ".join(FIELDS)
AUDIT_1 = "'csv' AS source, 'batch-1' AS batch_id, TIMESTAMP '2024-01-25 00:00:00' AS ingestion_timestamp"

EVENTS = """e AS (
  SELECT event_id AS e, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso
  FROM events)"""

_COLUMNS = f"""
  CASE WHEN e % 211 = 1 THEN 'ACCT' || user_id ELSE 'ACC-' || lpad(CAST(user_id AS VARCHAR), 4, '0') END AS account_id,
  CASE WHEN e % 223 = 2 THEN iso WHEN e % 227 = 3 THEN '2024-02-31T10:30:00Z'
       WHEN e % 3 = 0 THEN iso || '+00:00' ELSE iso || 'Z' END AS transaction_date,
  CASE WHEN e % 229 = 4 THEN '0' WHEN e % 233 = 5 THEN '12.345' WHEN e % 239 = 6 THEN 'abc'
       WHEN e % 241 = 7 THEN '' ELSE CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR) END AS amount,
  CASE WHEN e % 251 = 8 THEN 'eur' ELSE {_list(CURRENCIES)}[k % 7 + 1] END AS currency,
  CASE WHEN e % 4 = 0 THEN 'credit' ELSE 'debit' END AS transaction_type,
  CASE WHEN e % 257 = 9 THEN '   ' ELSE 'Merchant ' || k END AS merchant_name,
  {_list(MERCHANT_CATEGORIES)}[k % 12 + 1] AS merchant_category,
  CASE event_type WHEN 'signup' THEN 'pending' WHEN 'error' THEN 'failed' ELSE 'completed' END AS status,
  CASE WHEN e % 263 = 10 THEN 'XX' ELSE {_list(COUNTRIES)}[k % 7 + 1] END AS country_code"""

FEED = f"""{EVENTS},
ids AS (
  SELECT 'TXN-' || e AS transaction_id, * FROM e
  UNION ALL
  SELECT 'TXN-R' || e AS transaction_id, * FROM e WHERE e % 50 = 0),
feed AS (SELECT transaction_id, ts, k, {_COLUMNS} FROM ids)"""

# The rules the feed can break, in reporting order. Countries of the feed are a short list.
_DATE_OK = r"regexp_full_match(transaction_date, '\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(Z|\+00:00)')"


def _typed(source: str, name: str = "typed") -> str:
    return f"""{name} AS (
  SELECT *, CASE WHEN {_DATE_OK} THEN TRY_CAST(replace(left(transaction_date, 19), 'T', ' ') AS TIMESTAMP) END AS event_time,
         TRY_CAST(amount AS DECIMAL(18, 6)) AS exact_amount
  FROM {source})"""


def _enum_message(field: str) -> str:
    return _text(f"{field} must be one of {sorted(ALLOWED_VALUES[field])}")


_RULES = f"""
    CASE WHEN amount = '' THEN 'amount is required' END,
    CASE WHEN merchant_name = '' THEN 'merchant_name is required' END,
    CASE WHEN NOT regexp_full_match(account_id, 'ACC-[0-9]{{4}}') THEN 'account_id must match format ACC-NNNN' END,
    CASE WHEN event_time IS NULL
         THEN 'transaction_date must be a valid ISO 8601 UTC timestamp ending with Z or +00:00' END,
    CASE WHEN amount = '' THEN NULL
         WHEN exact_amount IS NULL THEN 'amount must be decimal'
         WHEN exact_amount <= 0 THEN 'amount must be greater than zero'
         WHEN exact_amount * 100 <> floor(exact_amount * 100) THEN 'amount must be a multiple of 0.01' END,
    CASE WHEN currency NOT IN {_in(CURRENCIES)} THEN {_enum_message('currency')} END,
    CASE WHEN merchant_name <> '' AND trim(merchant_name) = ''
         THEN 'merchant_name must contain at least one non-whitespace character' END,
    CASE WHEN country_code NOT IN {_in(COUNTRIES)}
         THEN 'country_code must be an assigned ISO 3166-1 alpha-2 code' END"""


def _pattern_message(field: str) -> str:
    ending = _text(f"' does not match {CONTRACT_PATTERNS[field]!r}")
    return f"'{field} violates schema: ''' || {field} || {ending}"


_CONTRACT = f"""
    CASE WHEN amount = '' THEN 'amount is required by schema' END,
    CASE WHEN merchant_name = '' THEN 'merchant_name is required by schema' END,
    CASE WHEN event_time IS NULL THEN 'transaction_date is required by schema' END,
    CASE WHEN NOT regexp_full_match(account_id, 'ACC-[0-9]{{4}}') THEN {_pattern_message('account_id')} END,
    CASE WHEN amount = '' THEN NULL
         WHEN exact_amount IS NULL THEN 'amount violates schema: ''' || amount || ''' is not of type ''number'''
         WHEN exact_amount <= 0
         THEN 'amount violates schema: Decimal(''' || amount || ''') is less than or equal to the minimum of 0'
         WHEN exact_amount * 100 <> floor(exact_amount * 100)
         THEN 'amount violates schema: Decimal(''' || amount || ''') is not a multiple of Decimal(''0.01'')' END,
    CASE WHEN currency NOT IN {_in(CURRENCIES)}
         THEN 'currency violates schema: ''' || currency || ''' is not one of ' || {_text(repr(list(CURRENCIES)))} END,
    CASE WHEN merchant_name <> '' AND trim(merchant_name) = '' THEN {_pattern_message('merchant_name')} END"""


def _checked(source: str = "feed", contract: bool = False, name: str = "checked") -> str:
    messages = _RULES + ("," + _CONTRACT if contract else "")
    return f"""{_typed(source, f"typed_{name}")},
{name} AS (SELECT *, [m FOR m IN [{messages}] IF m IS NOT NULL] AS errors FROM typed_{name})"""


def _valid(checked: str = "checked", name: str = "valid") -> str:
    typed = {"transaction_date": "event_time AS transaction_date", "amount": "CAST(amount AS DECIMAL(18, 2)) AS amount"}
    columns = ", ".join(typed.get(field, field) for field in FIELDS)
    return f"{name} AS (SELECT {columns} FROM {checked} WHERE len(errors) = 0)"


def _keyed(valid: str = "valid", name: str = "keyed") -> str:
    parts = {
        "transaction_date": "strftime(transaction_date, '%Y-%m-%dT%H:%M:%SZ')",
        "amount": "CAST(amount AS VARCHAR)",
    }
    key = ", ".join(parts.get(field, field) for field in NATURAL_KEY)
    return f"{name} AS (SELECT *, sha256(concat_ws(chr(31), {key})) AS natural_key_hash FROM {valid})"


def _ranked(keyed: str = "keyed", name: str = "bronze") -> str:
    return f"""{name} AS (
  SELECT *, natural_key_hash AS duplicate_group_id,
         row_number() OVER (PARTITION BY natural_key_hash ORDER BY transaction_date, transaction_id) AS duplicate_rank,
         row_number() OVER (PARTITION BY natural_key_hash ORDER BY transaction_date, transaction_id) > 1 AS is_duplicate
  FROM {keyed})"""


CHECKED = f"WITH {FEED}, {_checked()}"
VALID = f"{CHECKED}, {_valid()}"
KEYED = f"{VALID}, {_keyed()}"
BRONZE = f"{KEYED}, {_ranked()}"


def _gold(bronze: str = "bronze") -> str:
    """One row per account, day, category, currency and merchant first; days are folded from those."""
    return f"""cells AS (
  SELECT account_id AS a, CAST(transaction_date AS DATE) AS d, merchant_category AS c, currency AS x, merchant_name AS m,
         count(*) AS n, sum(amount) FILTER (transaction_type = 'debit') AS spent,
         sum(amount) FILTER (transaction_type = 'credit') AS earned
  FROM {bronze} WHERE NOT is_duplicate AND status = 'completed' GROUP BY ALL),
ranking AS (
  SELECT a AS account_id, d AS transaction_date, c AS merchant_category, CAST(sum(spent) AS DECIMAL(18, 2)) AS category_amount,
         row_number() OVER (PARTITION BY a, d ORDER BY sum(spent) DESC, c) AS category_rank
  FROM cells WHERE spent IS NOT NULL GROUP BY a, d, c),
gold AS (
  SELECT a AS account_id, d AS transaction_date,
         CAST(coalesce(sum(spent), 0) AS DECIMAL(18, 2)) AS total_debit_amount,
         CAST(coalesce(sum(earned), 0) AS DECIMAL(18, 2)) AS total_credit_amount,
         CAST(coalesce(sum(earned), 0) - coalesce(sum(spent), 0) AS DECIMAL(18, 2)) AS net_amount,
         CAST(sum(n) AS BIGINT) AS transaction_count, len(list_distinct(list(m))) AS distinct_merchants,
         (SELECT merchant_category FROM ranking r WHERE r.account_id = a AND r.transaction_date = d AND category_rank = 1)
           AS top_category,
         array_to_string(list_sort(list_distinct(list(x))), ',') AS currencies
  FROM cells GROUP BY a, d)"""


GOLD = f"{BRONZE}, {_gold()}"
_PAYLOAD = " || ',' || ".join(f"'\"{name}\":\"' || {name} || '\"'" for name in sorted(FIELDS))
QUARANTINE = f"""WITH {FEED}, {_checked(contract=True)},
quarantine AS (
  SELECT DISTINCT sha256(concat_ws(chr(31), payload, array_to_string(errors, chr(31)))) AS quarantine_id, transaction_id,
         payload AS raw_payload, array_to_string(errors, '; ') AS error_reason, len(errors) AS error_count, errors,
         TIMESTAMP '2024-01-25 00:00:00' AS ingestion_timestamp, 'batch-1' AS batch_id, 'csv' AS source
  FROM (SELECT *, '{{' || {_PAYLOAD} || '}}' AS payload FROM checked WHERE len(errors) > 0))"""

# Two batches: what had arrived before a day, then everything from the watermark minus two days on.
_ARRIVED = "feed_1 AS (SELECT * FROM feed WHERE ts + to_days(CAST(k // 20 AS INTEGER)) < TIMESTAMP '2024-01-25')"
_LOWER = """bound AS (SELECT max(event_time) AS watermark FROM checked_1 WHERE len(errors) = 0),
feed_2 AS (SELECT * FROM typed_checked WHERE event_time IS NULL
           OR event_time >= (SELECT watermark - INTERVAL 2 DAY FROM bound))"""
BATCHES = f"""WITH {FEED}, {_checked()}, {_ARRIVED}, {_checked("feed_1", name="checked_1")}, {_LOWER},
checked_2 AS (SELECT checked.* FROM checked SEMI JOIN feed_2 USING (transaction_id)),
{_valid("checked_1", "valid_1")}, {_valid("checked_2", "valid_2")},
merged AS (
  SELECT *, 'batch-2' AS batch_id FROM valid_2
  UNION ALL
  SELECT *, 'batch-1' AS batch_id FROM valid_1 ANTI JOIN valid_2 USING (transaction_id))"""
MERGED_BRONZE = f"{BATCHES}, {_keyed('merged')}, {_ranked()}"

# What a CSV source does to the feed: values are trimmed.
_CSV_FEED = FEED.replace("feed AS (", "untrimmed AS (", 1) + (
    ", feed AS (SELECT * REPLACE (trim(merchant_name) AS merchant_name) FROM untrimmed)"
)
CSV_BATCHES = BATCHES.replace(FEED, _CSV_FEED, 1)

_COUNT_TYPES = "CAST({} AS BIGINT) AS {}"
_TAMPER = "CASE WHEN transaction_date = DATE '2024-01-01' THEN net_amount + 1 ELSE net_amount END"


def _tampered(name: str) -> str:
    return f"{name} AS (SELECT * REPLACE (CAST({_TAMPER} AS DECIMAL(18, 2)) AS net_amount) FROM gold)"


def _assertions(gold: str) -> str:
    checks = {
        "gold_account_id_not_null": f"SELECT count(*) FROM {gold} WHERE account_id IS NULL",
        "gold_transaction_date_not_null": f"SELECT count(*) FROM {gold} WHERE transaction_date IS NULL",
        "gold_account_date_unique": f"""SELECT count(*) FROM (
            SELECT 1 FROM {gold} GROUP BY account_id, transaction_date HAVING count(*) > 1)""",
        "gold_transaction_count_positive": f"SELECT count(*) FROM {gold} WHERE transaction_count < 1",
        "gold_net_amount_matches_credit_minus_debit": f"""SELECT count(*) FROM {gold}
            WHERE net_amount <> CAST(total_credit_amount - total_debit_amount AS DECIMAL(18, 2))""",
        "gold_matches_completed_non_duplicate_bronze": f"""SELECT count(*) FROM (
            (SELECT * FROM {gold} EXCEPT ALL SELECT * FROM gold)
            UNION ALL (SELECT * FROM gold EXCEPT ALL SELECT * FROM {gold}))""",
    }
    return _check_rows(checks)


def _check_rows(checks: dict[str, str]) -> str:
    rows = " UNION ALL ".join(f"SELECT {_text(name)} AS name, ({sql}) AS failed_rows" for name, sql in checks.items())
    return f"SELECT name, failed_rows, failed_rows = 0 AS passed FROM ({rows})"


def _not_null(table: str, column: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {column} IS NULL"


def _staging_checks() -> str:
    required = ["transaction_id", "account_id", "transaction_date", "currency", "transaction_type", "status"]
    checks = {f"stg_{name}_not_null": _not_null("bronze", name) for name in [*required, "is_duplicate"]}
    for name in ("currency", "transaction_type", "status"):
        checks[f"stg_{name}_accepted_values"] = (
            f"SELECT count(*) FROM bronze WHERE {name} NOT IN {_in(ALLOWED_VALUES[name])}"
        )
    checks["stg_is_duplicate_accepted_values"] = "SELECT count(*) FROM bronze WHERE is_duplicate NOT IN (true, false)"
    checks["stg_transaction_id_unique"] = (
        "SELECT count(*) FROM (SELECT 1 FROM bronze GROUP BY transaction_id HAVING count(*) > 1)"
    )
    return _check_rows(checks)


def _gold_model_checks() -> str:
    required = ["account_id", "transaction_date", "total_debit_amount", "total_credit_amount", "net_amount"]
    required += ["transaction_count", "distinct_merchants", "currencies"]
    checks = {f"model_{name}_not_null": _not_null("gold", name) for name in required}
    checks["model_transaction_count_at_least_one"] = "SELECT count(*) FROM gold WHERE NOT (transaction_count >= 1)"
    checks["model_account_date_unique"] = (
        "SELECT count(*) FROM (SELECT 1 FROM gold GROUP BY account_id, transaction_date HAVING count(*) > 1)"
    )
    return _check_rows(checks)


_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"
_MULTI = """SELECT a AS account_id, d AS transaction_date, count(DISTINCT x) AS currency_count FROM cells
GROUP BY a, d HAVING count(DISTINCT x) > 1"""


def _profile() -> str:
    def scalar(section: str, key: str, sql: str) -> str:
        return f"SELECT '{section}' AS section, '{key}' AS key, CAST(({sql}) AS VARCHAR) AS value"

    parts = [
        scalar("row_counts", "valid_records", "SELECT count(*) FROM bronze"),
        scalar("row_counts", "canonical_valid_records", "SELECT count(*) FROM bronze WHERE NOT is_duplicate"),
        scalar("row_counts", "duplicate_records", "SELECT count(*) FROM bronze WHERE is_duplicate"),
        scalar("row_counts", "quarantined_records", "SELECT count(*) FROM quarantine"),
        scalar("row_counts", "gold_daily_summary_rows", "SELECT count(*) FROM gold"),
        scalar("date_range", "min_transaction_date", f"SELECT {_ISO.format('min(transaction_date)')} FROM bronze"),
        scalar("date_range", "max_transaction_date", f"SELECT {_ISO.format('max(transaction_date)')} FROM bronze"),
        scalar("scalars", "account_count", "SELECT count(DISTINCT account_id) FROM bronze"),
        scalar(
            "scalars",
            "duplicate_group_count",
            "SELECT count(DISTINCT duplicate_group_id) FROM bronze WHERE is_duplicate",
        ),
        scalar("scalars", "multi_currency_account_dates", f"SELECT count(*) FROM ({_MULTI})"),
        "SELECT 'invalid_count_by_rule', rule, CAST(count(*) AS VARCHAR) "
        "FROM (SELECT unnest(errors) AS rule FROM quarantine) GROUP BY rule",
    ]
    parts += [
        f"SELECT '{name}_distribution', {name}, CAST(count(*) AS VARCHAR) FROM bronze GROUP BY {name}"
        for name in ("status", "currency", "transaction_type")
    ]
    with_quarantine = f"{GOLD}, {_checked(contract=True, name='contracted')}, quarantine AS (" + (
        "SELECT errors FROM contracted WHERE len(errors) > 0)"
    )
    return f"{with_quarantine} " + " UNION ALL ".join(parts)


def _api_errors() -> str:
    """Messages of the JSON records: rules see an explicit null as the word None."""
    null_k = {field: k for k, field in API_NULLS.items()}
    missing_k = {field: k for k, field in API_MISSING.items()}

    def is_null(field: str) -> str:
        return f"k = {null_k[field]}" if field in null_k else "false"

    def is_missing(field: str) -> str:
        return f"k = {missing_k[field]}" if field in missing_k else "false"

    # A JSON number keeps no second zero after the point.
    sent = {"amount": "CASE WHEN amount = '0.00' THEN '0.0' ELSE amount END"}
    values = ", ".join(
        f"CASE WHEN {is_missing(field)} THEN NULL WHEN {is_null(field)} THEN 'None' ELSE {sent.get(field, field)} END AS {field}"
        for field in FIELDS
    )
    raw = f"api AS (SELECT e, k, {values} FROM (SELECT 'TXN-' || e AS transaction_id, e, k, {_COLUMNS} FROM e))"
    required = ",\n".join(
        f"CASE WHEN {is_null(field)} OR {is_missing(field)} OR {field} = '' THEN '{field} is required' END"
        for field in FIELDS
    )
    by_schema = ",\n".join(
        f"CASE WHEN {condition} THEN '{field} is required by schema' END"
        for field, condition in (
            ("amount", f"amount IS NULL OR amount IN ('', 'None') OR {is_null('amount')}"),
            ("merchant_name", "merchant_name IS NULL OR merchant_name = ''"),
            ("transaction_date", "event_time IS NULL"),
        )
    )

    def violates(field: str, condition: str, ending: str) -> str:
        return f"CASE WHEN {condition} THEN '{field} violates schema: ''' || {field} || {_text(ending)} END"

    def no_match(field: str) -> str:
        return f"' does not match {CONTRACT_PATTERNS[field]!r}"

    decimal = "'amount violates schema: Decimal(''' || amount ||"
    amount_given = "amount NOT IN ('', 'None')"
    messages = f"""
    CASE WHEN e % 271 = 11 THEN 'unexpected fields: [''reviewer_note'']' END,
    {required},
    CASE WHEN transaction_id = 'None' THEN 'transaction_id must match pattern TXN-[A-Z0-9]+' END,
    CASE WHEN NOT regexp_full_match(account_id, 'ACC-[0-9]{{4}}') THEN 'account_id must match format ACC-NNNN' END,
    CASE WHEN event_time IS NULL
         THEN 'transaction_date must be a valid ISO 8601 UTC timestamp ending with Z or +00:00' END,
    CASE WHEN {amount_given} AND exact_amount IS NULL THEN 'amount must be decimal'
         WHEN exact_amount <= 0 THEN 'amount must be greater than zero'
         WHEN exact_amount * 100 <> floor(exact_amount * 100) THEN 'amount must be a multiple of 0.01' END,
    CASE WHEN currency NOT IN {_in(CURRENCIES)} THEN {_enum_message('currency')} END,
    CASE WHEN status = 'None' THEN {_enum_message('status')} END,
    CASE WHEN merchant_name <> '' AND trim(merchant_name) = ''
         THEN 'merchant_name must contain at least one non-whitespace character' END,
    CASE WHEN country_code NOT IN {_in(COUNTRIES)}
         THEN 'country_code must be an assigned ISO 3166-1 alpha-2 code' END,
    {by_schema},
    CASE WHEN e % 271 = 11 THEN 'record violates schema: Additional properties are not allowed '
         || '(''reviewer_note'' was unexpected)' END,
    {violates("account_id", "NOT regexp_full_match(account_id, 'ACC-[0-9]{4}')", no_match("account_id"))},
    CASE WHEN {amount_given} AND exact_amount IS NULL
         THEN 'amount violates schema: ''' || amount || ''' is not of type ''number'''
         WHEN exact_amount <= 0 THEN {decimal} ''') is less than or equal to the minimum of 0'
         WHEN exact_amount * 100 <> floor(exact_amount * 100)
         THEN {decimal} ''') is not a multiple of Decimal(''0.01'')' END,
    {violates("country_code", "country_code = 'None'", no_match("country_code"))},
    {violates("country_code", "country_code = 'None'", "' is too long")},
    {violates("currency", f"currency NOT IN {_in(CURRENCIES)}", f"' is not one of {list(CURRENCIES)!r}")},
    {violates("merchant_name", "merchant_name <> '' AND trim(merchant_name) = ''", no_match("merchant_name"))},
    {violates("status", "status = 'None'", f"' is not one of {list(ALLOWED_VALUES['status'])!r}")},
    {violates("transaction_id", "transaction_id = 'None'", no_match("transaction_id"))}"""
    return f"""WITH {EVENTS}, {raw}, {_typed("api")},
checked AS (SELECT *, [m FOR m IN [{messages}] IF m IS NOT NULL] AS errors FROM typed)
SELECT e AS id, nullif(transaction_id, 'None') AS transaction_id, array_to_string(errors, '; ') AS error_reason,
       len(errors) AS error_count
FROM checked WHERE len(errors) > 0"""


def _errors_of(where: str = "") -> str:
    return f"""SELECT transaction_id, array_to_string(errors, '; ') AS error_reason, len(errors) AS error_count
FROM checked {where}"""


def _control_columns(checked: str) -> str:
    return f"""SELECT max(CASE WHEN len(errors) = 0 THEN event_time END) AS last_successful_watermark,
       count(*) AS records_read, count(*) FILTER (len(errors) = 0) AS records_valid,
       count(*) FILTER (len(errors) > 0) AS records_quarantined FROM {checked}"""


def _age(watermark: str) -> str:
    seconds = f"date_diff('second', {watermark}, TIMESTAMP '2024-02-01 00:00:00')"
    return f"round(CAST({seconds} AS DOUBLE) / 3600, 2)"


def _rate(numerator: str, denominator: str) -> str:
    return f"coalesce(round(CAST({numerator} AS DOUBLE) / nullif({denominator}, 0), 4), 0.0)"


_WARN_RATES = """CASE WHEN records_read >= 50 AND quarantine_rate > 0.05 THEN 'quarantine_rate_above_5_percent' END,
       CASE WHEN valid_records >= 50 AND duplicate_rate > 0.05 THEN 'duplicate_rate_above_5_percent' END"""

_ID_COLLISIONS = f"""{VALID},
shared AS (SELECT * REPLACE ('TXN-' || account_id[5:8] AS transaction_id) FROM valid),
{_keyed("shared", "shared_keyed")}
SELECT transaction_id, transaction_date, amount, natural_key_hash FROM shared_keyed
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_date DESC, natural_key_hash DESC) = 1"""

_CORRECTION = f"""{VALID},
corrected AS (
  SELECT * REPLACE (CASE WHEN status = 'failed' THEN transaction_date + INTERVAL 1 DAY ELSE transaction_date END
                    AS transaction_date) FROM valid),
{_keyed("corrected")}, {_ranked()}
SELECT transaction_id, transaction_date, duplicate_rank FROM bronze"""

_QUARANTINE_REPLACE = f"""{BATCHES},
invalid AS (
  SELECT *, 'batch-1' AS batch_id FROM checked_1 WHERE len(errors) > 0
  UNION ALL SELECT *, 'batch-2' FROM checked_2 WHERE len(errors) > 0),
identified AS (
  SELECT sha256(concat_ws(chr(31), '{{' || {_PAYLOAD} || '}}', array_to_string(errors, chr(31)))) AS quarantine_id, *
  FROM invalid)
SELECT quarantine_id, transaction_id, array_to_string(errors, '; ') AS error_reason, batch_id FROM identified
QUALIFY row_number() OVER (PARTITION BY quarantine_id ORDER BY batch_id DESC) = 1"""

_STORED_CONTROL = f"""{CSV_BATCHES}, {_keyed("merged")}, {_ranked()},
state AS ({_control_columns("checked_2")})
SELECT 'transactions_ingestion' AS pipeline_name, 'csv' AS source, last_successful_watermark, 2::BIGINT AS lookback_days,
       'batch-2' AS last_run_batch_id, 'success' AS last_run_status, records_read, records_valid, records_quarantined,
       (SELECT count(*) FROM bronze WHERE is_duplicate) AS records_duplicated,
       TIMESTAMP '2024-02-01 00:00:00' AS updated_at
FROM state"""

_STORED_QUARANTINE = f"""{CSV_BATCHES}, {_checked(contract=True, name="contracted")},
seen AS (
  SELECT *, 'batch-2' AS batch_id FROM contracted SEMI JOIN checked_2 USING (transaction_id)
  UNION ALL SELECT *, 'batch-1' FROM contracted SEMI JOIN checked_1 USING (transaction_id)),
identified AS (
  SELECT *, '{{' || {_PAYLOAD} || '}}' AS raw_payload FROM seen WHERE len(errors) > 0)
SELECT sha256(concat_ws(chr(31), raw_payload, array_to_string(errors, chr(31)))) AS quarantine_id, transaction_id,
       raw_payload, array_to_string(errors, '; ') AS error_reason, len(errors) AS error_count, batch_id,
       'csv' AS source, CAST(event_time AS DATE) AS event_date
FROM identified QUALIFY row_number() OVER (PARTITION BY raw_payload ORDER BY batch_id DESC) = 1"""

_WHOLE_RUN = f"""WITH {_CSV_FEED}, {_checked()}, {_valid()}, {_keyed()}, {_ranked()}, {_gold()},
again AS (
  SELECT * FROM checked
  WHERE event_time IS NULL OR event_time >= (SELECT max(transaction_date) - INTERVAL 2 DAY FROM valid)),
common AS (
  SELECT count(*) FILTER (is_duplicate) AS duplicate_records,
         count(*) FILTER (NOT is_duplicate) AS canonical_valid_records,
         {_ISO.format("max(transaction_date)")} AS watermark, (SELECT count(*) FROM gold) AS daily_summary_rows
  FROM bronze)
SELECT 'full_ingestion' AS step, (SELECT count(*) FROM checked) AS records_read,
       (SELECT count(*) FROM valid) AS valid_records, (SELECT count(*) FROM valid) AS inserted_valid_records,
       (SELECT count(*) FROM checked WHERE len(errors) > 0) AS quarantined_records, common.* FROM common
UNION ALL
SELECT 'incremental_simulation', (SELECT count(*) FROM again), (SELECT count(*) FROM again WHERE len(errors) = 0), 0,
       (SELECT count(*) FROM again WHERE len(errors) > 0), common.* FROM common"""

_RUN_METRICS = f"""{GOLD},
counts AS (
  SELECT (SELECT count(*) FROM checked) AS records_read, (SELECT count(*) FROM valid) AS valid_records,
         (SELECT count(*) FROM checked WHERE len(errors) > 0) AS quarantined_records,
         (SELECT count(*) FROM bronze WHERE is_duplicate) AS duplicate_records,
         (SELECT count(*) FROM bronze WHERE NOT is_duplicate) AS canonical_valid_records,
         (SELECT count(*) FROM gold) AS daily_summary_rows,
         (SELECT max(transaction_date) FROM valid) AS latest),
rates AS (
  SELECT *, {_rate("quarantined_records", "records_read")} AS quarantine_rate,
         {_rate("duplicate_records", "valid_records")} AS duplicate_rate FROM counts)
SELECT records_read, valid_records, quarantined_records, duplicate_records, canonical_valid_records, daily_summary_rows,
       quarantine_rate, duplicate_rate, {_ISO.format("latest")} AS watermark, {_age("latest")} AS watermark_age_hours,
       concat_ws(',', {_WARN_RATES}) AS warnings
FROM rates"""

_METRIC_WARNINGS = f"""WITH counts AS (
  SELECT l_returnflag, l_linestatus, count(*) AS records_read, count(*) FILTER (l_quantity > 5) AS valid_records,
         count(*) FILTER (l_quantity <= 5) AS quarantined_records, count(*) FILTER (l_discount > 0.08) AS duplicate_records
  FROM lineitem GROUP BY ALL),
rates AS (
  SELECT *, {_rate("quarantined_records", "records_read")} AS quarantine_rate,
         {_rate("duplicate_records", "valid_records")} AS duplicate_rate FROM counts)
SELECT l_returnflag, l_linestatus, quarantine_rate, duplicate_rate,
       {_age("TIMESTAMP '2024-01-30 12:00:00'")} AS watermark_age_hours,
       concat_ws(',', {_WARN_RATES}, CASE WHEN l_returnflag = 'R' THEN 'dbt_tests_failed' END,
                 CASE WHEN l_linestatus = 'O' THEN 'data_quality_assertions_failed' END) AS warnings
FROM rates"""

_QUARANTINE_LOG = _STORED_QUARANTINE.split("SELECT sha256(")[0] + """SELECT sha256(concat_ws(chr(31), raw_payload,
       array_to_string(errors, chr(31)))) AS quarantine_id, count(*) AS attempts, max(batch_id) AS latest_batch
FROM identified GROUP BY ALL"""

_SEEN = "CASE batch_id WHEN 'batch-1' THEN TIMESTAMP '2024-01-25' ELSE TIMESTAMP '2024-02-01' END"
_GROUP_HISTORY = f"""{CSV_BATCHES}, {_keyed("valid_1", "keyed_1")}, {_keyed("merged", "keyed_2")},
known AS (
  SELECT natural_key_hash, CAST(transaction_date AS DATE) AS event_date, count(*) AS n FROM keyed_1
  GROUP BY ALL HAVING count(*) > 1),
again AS (
  SELECT natural_key_hash, CAST(transaction_date AS DATE) AS event_date, count(*) AS n, min({_SEEN}) AS f, max({_SEEN}) AS l
  FROM keyed_2 WHERE CAST(transaction_date AS DATE) IN (SELECT CAST(transaction_date AS DATE) FROM valid_2)
  GROUP BY 1, 2 HAVING count(*) > 1)
SELECT natural_key_hash, event_date, coalesce(again.n, known.n) AS group_rows,
       CASE WHEN known.n IS NULL THEN f ELSE TIMESTAMP '2024-01-25' END AS first_seen,
       coalesce(l, TIMESTAMP '2024-01-25') AS last_seen
FROM known FULL JOIN again USING (natural_key_hash, event_date)"""

_RUN_AUDIT = f"""{CSV_BATCHES},
runs AS (
  SELECT 'batch-1' AS batch_id, 'full' AS mode, TIMESTAMP '2024-01-25' AS ingested_at, event_time, len(errors) = 0 AS ok,
         true AS is_new FROM checked_1
  UNION ALL
  SELECT 'batch-2', 'incremental', TIMESTAMP '2024-02-01', event_time, len(errors) = 0,
         transaction_id NOT IN (SELECT transaction_id FROM valid_1) FROM checked_2)
SELECT batch_id, 'csv' AS source, mode, ingested_at, count(*) AS records_read, count(*) FILTER (ok) AS records_valid,
       count(*) FILTER (NOT ok) AS records_quarantined, count(*) FILTER (ok AND is_new) AS records_inserted,
       min(event_time) FILTER (ok) AS first_event, max(event_time) FILTER (ok) AS last_event
FROM runs GROUP BY ALL"""

_STREAM_REPLAY = _api_errors().split("SELECT e AS id")[0] + """, half AS (SELECT * FROM checked WHERE e % 2 = 0)
SELECT 0::BIGINT AS delivery, 0::BIGINT AS epoch, count(*) AS records_read,
       count(*) FILTER (len(errors) = 0) AS inserted_valid_records FROM half
UNION ALL SELECT 1, 0, 0, 0
UNION ALL SELECT 2, 1, count(*), count(*) FILTER (len(errors) = 0 AND e % 2 = 1) FROM checked"""

_VOLUME_GATE = f"""WITH {EVENTS},
daily AS (
  SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS records FROM e
  WHERE NOT (CAST(ts AS DATE) = DATE '2024-01-20' AND k >= 20) GROUP BY ALL),
framed AS (
  SELECT *, median(records) OVER w AS expected, mad(records) OVER w AS spread, count(*) OVER w AS n FROM daily
  WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
judged AS (SELECT *, greatest(spread * 1.4826, expected * 0.05) AS deviation FROM framed)
SELECT event_type, day, records, CAST(expected AS DOUBLE) AS expected,
       CASE WHEN n < 3 THEN 'no_baseline' WHEN expected - records > deviation * 6 THEN 'block'
            WHEN expected - records > deviation * 3 THEN 'warn' ELSE 'pass' END AS verdict
FROM judged"""

_CORRECTED = "status = 'failed' AND transaction_id NOT LIKE 'TXN-R%'"
_STORED_FEED = f"WITH {_CSV_FEED}, {_checked()}, {_valid()}, {_keyed()}, {_ranked()}"
_SILVER_CHANGES = f"""{_STORED_FEED},
corrected AS (
  SELECT * REPLACE (CASE WHEN {_CORRECTED} THEN transaction_date + INTERVAL 1 DAY ELSE transaction_date END AS transaction_date,
                    CASE WHEN {_CORRECTED} THEN 'completed' ELSE status END AS status) FROM valid),
{_keyed("corrected", "keyed_2")}, {_ranked("keyed_2", "bronze_2")},
before AS (SELECT {BUSINESS} FROM bronze WHERE NOT is_duplicate),
after AS (SELECT {BUSINESS} FROM bronze_2 WHERE NOT is_duplicate)
SELECT 'removed' AS change, * FROM before ANTI JOIN after USING (transaction_id)
UNION ALL SELECT 'inserted', * FROM after ANTI JOIN before USING (transaction_id)
UNION ALL SELECT 'changed', * FROM (SELECT * FROM after EXCEPT SELECT * FROM before) SEMI JOIN before USING (transaction_id)"""

_LINES_REPEATED = "FROM lineitem GROUP BY l_orderkey, l_linenumber"
_MERGED_COLUMNS = "transaction_id, transaction_date, batch_id, duplicate_rank, is_duplicate"

ORACLE: dict[str, str] = {
    "normalize_raw": "WITH "
    + FEED
    + " SELECT "
    + ", ".join(f"trim({name}) AS {name}" for name in FIELDS)
    + " FROM feed",
    "validate_errors": f"""{CHECKED} SELECT transaction_id, len(errors) = 0 AS is_valid,
       array_to_string(errors, '; ') AS error_reason, len(errors) AS error_count FROM checked""",
    "contract_errors": f"WITH {FEED}, {_checked(contract=True)} {_errors_of('WHERE len(errors) > 0')}",
    "contract_from_file": f"""WITH {FEED}, {_checked(contract=True)}
SELECT transaction_id, array_to_string(errors, '; ') AS error_reason FROM checked WHERE len(errors) > 0""",
    "api_record_errors": _api_errors(),
    "valid_rows": f"{VALID} SELECT {BUSINESS} FROM valid",
    "quarantine_rows": f"""{QUARANTINE} SELECT * EXCLUDE (errors) FROM quarantine""",
    "invalid_by_rule": f"""{QUARANTINE}
SELECT rule, count(*) AS failures FROM (SELECT unnest(errors) AS rule FROM quarantine) GROUP BY rule""",
    "invalid_by_kind": f"""{QUARANTINE},
rules AS (SELECT unnest(errors) AS rule FROM quarantine),
kinds AS (
  SELECT CASE WHEN rule LIKE '% violates schema: %'
              THEN regexp_replace(rule, '^([a-z_]+ violates schema:) .*?(is not |is less |does not )', '\\1 \\2')
              ELSE rule END AS rule FROM rules)
SELECT rule, count(*) AS failures FROM kinds GROUP BY rule""",
    "rows_with_audit": f"{VALID} SELECT transaction_id, {AUDIT_1} FROM valid",
    "paged_source": """SELECT event_id AS id, 'TXN-' || event_id AS transaction_id,
       'ACC-' || lpad(CAST(user_id AS VARCHAR), 4, '0') AS account_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS transaction_date, CAST(value AS DECIMAL(18, 2)) AS amount FROM events""",
    "paged_since": """SELECT 'TXN-' || event_id AS transaction_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS transaction_date FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00'""",
    "source_sample_check": """SELECT count(*) AS records_read, count(*) AS valid_records, 0::BIGINT AS quarantined_records,
       string_agg(id, ',' ORDER BY id) AS sample_transaction_ids
FROM (SELECT 'TXN-' || event_id AS id FROM events ORDER BY event_id LIMIT 5)""",
    "csv_scan": "WITH "
    + FEED
    + " SELECT "
    + ", ".join(f"trim({name}) AS {name}" for name in FIELDS)
    + " FROM feed",
    "source_fallback": f"""WITH {_CSV_FEED}, {_checked()}
SELECT status, 'csv_fallback' AS resolved_source, count(*) AS records_read FROM checked
WHERE event_time IS NULL OR event_time >= TIMESTAMP '2024-01-20' GROUP BY status""",
    "landing_append": f"""{VALID} SELECT transaction_type, count(*) AS records,
       (SELECT count(*) FROM valid) AS appended FROM valid GROUP BY transaction_type""",
    "landing_pruned_scan": f"""{CHECKED} SELECT transaction_id, transaction_date FROM checked
WHERE event_time IS NULL OR event_time >= TIMESTAMP '2024-01-20 12:00:00'""",
    "quarantine_log": _QUARANTINE_LOG,
    "run_audit": _RUN_AUDIT,
    "stream_replay": _STREAM_REPLAY,
    "volume_gate": _VOLUME_GATE,
    "paged_pushdown": """SELECT 'TXN-' || event_id AS transaction_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS transaction_date FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00'""",
    "keyset_source": """SELECT 'TXN-' || event_id AS transaction_id, CAST(value AS DECIMAL(18, 2)) AS amount,
       strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS transaction_date FROM events""",
    "dup_group_history": _GROUP_HISTORY,
    "moved_ids_by_index": f"""{_STORED_FEED} SELECT transaction_id, CAST(transaction_date AS DATE) AS stored_date,
       CAST(transaction_date + INTERVAL 1 DAY AS DATE) AS event_date FROM valid WHERE {_CORRECTED}""",
    "silver_changes": _SILVER_CHANGES,
    "watermark_scan": f"""{CHECKED} SELECT transaction_id, transaction_date FROM checked
WHERE event_time IS NULL OR event_time >= TIMESTAMP '2024-01-20 12:00:00'""",
    "effective_watermark": f"""{BATCHES} SELECT {_ISO.format("watermark")} AS watermark,
       {_ISO.format("watermark - INTERVAL 2 DAY")} AS effective_lower_bound FROM bound""",
    "next_watermark": f"""{BATCHES}, first AS ({_control_columns("checked_1")}), second AS ({_control_columns("checked_2")})
SELECT 'transactions_ingestion' AS pipeline_name, 'csv' AS source,
       greatest((SELECT last_successful_watermark FROM second), last_successful_watermark) AS last_successful_watermark,
       'batch-2' AS last_run_batch_id, records_read, records_valid FROM first""",
    "natural_key_hash": f"{KEYED} SELECT transaction_id, natural_key_hash FROM keyed",
    "dup_ranked": f"{BRONZE} SELECT transaction_id, duplicate_group_id, duplicate_rank, is_duplicate FROM bronze",
    "dup_ranked_by_position": f"""{VALID} SELECT transaction_id,
       row_number() OVER (PARTITION BY status ORDER BY transaction_id) AS duplicate_rank,
       row_number() OVER (PARTITION BY status ORDER BY transaction_id) > 1 AS is_duplicate FROM valid""",
    "dup_rows": f"""{BRONZE} SELECT {BUSINESS}, {AUDIT_1}, natural_key_hash, duplicate_group_id, duplicate_rank
FROM bronze WHERE is_duplicate""",
    "dup_groups": f"""{KEYED} SELECT natural_key_hash AS duplicate_group_id, count(*) AS group_rows,
       min(transaction_id) AS canonical_transaction_id FROM keyed GROUP BY ALL HAVING count(*) > 1""",
    "upsert_bronze": f"{BATCHES} SELECT transaction_id, transaction_date, amount, batch_id FROM merged",
    "inserted_ids": f"""{BATCHES} SELECT transaction_id, transaction_date
FROM valid_2 ANTI JOIN valid_1 USING (transaction_id)""",
    "id_collisions": _ID_COLLISIONS,
    "quarantine_replace": _QUARANTINE_REPLACE,
    "incremental_two_batches": f"{MERGED_BRONZE} SELECT {_MERGED_COLUMNS} FROM bronze",
    "correction_moves_date": _CORRECTION,
    "stg_view": f"{BRONZE} SELECT {BUSINESS}, is_duplicate FROM bronze",
    "gold_daily": f"{GOLD} SELECT * FROM gold",
    "gold_from_ranked": f"{GOLD} SELECT * FROM gold",
    "gold_daily_joined": f"{GOLD} SELECT * FROM gold",
    "category_totals": f"{GOLD} SELECT * FROM ranking",
    "gold_top_category": f"""{GOLD} SELECT top_category, count(*) AS account_days,
       CAST(sum(total_debit_amount) AS DECIMAL(18, 2)) AS debit_amount FROM gold GROUP BY top_category""",
    "gold_currencies": f"""{GOLD} SELECT currencies, count(*) AS account_days,
       CAST(sum(distinct_merchants) AS BIGINT) AS merchants FROM gold GROUP BY currencies""",
    "dq_staging": f"{BRONZE} {_staging_checks()}",
    "dq_gold_model": f"{GOLD} {_gold_model_checks()}",
    "dq_gold": f"{GOLD} {_assertions('gold')}",
    "dq_gold_tampered": f"{GOLD}, {_tampered('tampered')} {_assertions('tampered')}",
    "dq_unique_keys": f"SELECT l_orderkey, l_linenumber, count(*) AS row_count {_LINES_REPEATED} HAVING count(*) > 1",
    "dq_row_rules": """SELECT 'o_orderkey_not_null' AS name, count(*) FILTER (o_orderkey IS NULL) AS failed_rows FROM orders
UNION ALL SELECT 'o_orderstatus_accepted_values', count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) FROM orders
UNION ALL SELECT 'o_totalprice_at_least_1000', count(*) FILTER (NOT (o_totalprice >= 1000)) FROM orders""",
    "gold_reconcile": f"""{GOLD}, {_tampered("tampered")}
SELECT *, 1::BIGINT AS surplus FROM (SELECT * FROM tampered EXCEPT ALL SELECT * FROM gold)
UNION ALL SELECT *, -1::BIGINT FROM (SELECT * FROM gold EXCEPT ALL SELECT * FROM tampered)""",
    "gold_control_totals": f"""{GOLD} SELECT account_id, transaction_date, 1::BIGINT AS gold_rows, 1::BIGINT AS bronze_rows,
       'net_cents' AS differing FROM gold WHERE transaction_date = DATE '2024-01-01'""",
    "multiset_check": f"""SELECT 'lines_are_distinct' AS name, CAST(sum(n - 1) AS BIGINT) AS failed_rows
FROM (SELECT count(*) AS n {_LINES_REPEATED})""",
    "layer_counts": f"""{GOLD} SELECT count(*) AS valid_records,
       count(*) FILTER (NOT is_duplicate) AS canonical_valid_records, count(*) FILTER (is_duplicate) AS duplicate_records,
       count(DISTINCT duplicate_group_id) FILTER (is_duplicate) AS duplicate_group_count,
       (SELECT count(*) FROM checked WHERE len(errors) > 0) AS quarantined_records,
       (SELECT count(*) FROM gold) AS gold_daily_summary_rows FROM bronze""",
    "profile_date_range": f"""{BRONZE} SELECT {_ISO.format("min(transaction_date)")} AS min_transaction_date,
       {_ISO.format("max(transaction_date)")} AS max_transaction_date FROM bronze""",
    "profile_distributions": f"{BRONZE} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, {name} AS value, count(*) AS row_count FROM bronze GROUP BY {name}"
        for name in ("status", "currency", "transaction_type")
    ),
    "profile_counts": f"""{GOLD} SELECT count(DISTINCT account_id) AS account_count,
       count(DISTINCT duplicate_group_id) FILTER (is_duplicate) AS duplicate_group_count,
       (SELECT count(*) FROM ({_MULTI})) AS multi_currency_account_dates FROM bronze""",
    "multi_currency_days": f"{GOLD} {_MULTI}",
    "data_profile": _profile(),
    "profile_from_state": _profile(),
    "report_read_back": f"""{GOLD} SELECT count(*) AS valid_records,
       count(*) FILTER (NOT is_duplicate) AS canonical_valid_records, count(*) FILTER (is_duplicate) AS duplicate_records,
       (SELECT count(*) FROM checked WHERE len(errors) > 0) AS quarantined_records,
       (SELECT count(*) FROM gold) AS gold_daily_summary_rows FROM bronze""",
    "batch_max_event_time": f"{VALID} SELECT {_ISO.format('max(transaction_date)')} AS watermark FROM valid",
    "run_metrics": _RUN_METRICS,
    "metric_warnings": _METRIC_WARNINGS,
    "stored_bronze": f"{CSV_BATCHES}, {_keyed('merged')}, {_ranked()} SELECT {_MERGED_COLUMNS} FROM bronze",
    "stored_gold": f"{CSV_BATCHES}, {_keyed('merged')}, {_ranked()}, {_gold()} SELECT * FROM gold",
    "stored_profile": f"""{CSV_BATCHES}, {_keyed('merged')}, {_ranked()},
days AS (
  SELECT CAST(transaction_date AS DATE) AS event_date, account_id, count(*) AS n, count_if(is_duplicate) AS copies,
         count_if(duplicate_rank = 2) AS groups,
         count(DISTINCT currency) FILTER (status = 'completed' AND NOT is_duplicate) AS currencies
  FROM bronze GROUP BY ALL)
SELECT event_date, CAST(sum(n) AS BIGINT) AS valid_records, CAST(sum(n - copies) AS BIGINT) AS canonical_valid_records,
       CAST(sum(copies) AS BIGINT) AS duplicate_records, CAST(sum(groups) AS BIGINT) AS duplicate_group_count,
       CAST(count_if(currencies > 1) AS BIGINT) AS multi_currency_account_dates
FROM days GROUP BY event_date""",
    "stored_quarantine": _STORED_QUARANTINE,
    "stored_control": _STORED_CONTROL,
    "incremental_proof": f"""{BATCHES} SELECT count(*) AS expected_inserted_valid_records,
       count(*) AS actual_inserted_valid_records, count(*) AS persisted_new_records,
       (SELECT {_ISO.format("max(transaction_date)")} FROM valid_2) AS actual_watermark, true AS passed
FROM valid_2 ANTI JOIN valid_1 USING (transaction_id)""",
    "step_durations": f"""{BATCHES} SELECT unnest(['source_load', 'validation', 'duplicate_detection', 'storage']) AS step,
       true AS was_timed, (SELECT count(*) FROM checked_1) AS records_read""",
    "whole_run": _WHOLE_RUN,
    "csv_roundtrip_export": f"{BRONZE} SELECT {BUSINESS}, is_duplicate, duplicate_rank FROM bronze",
}
