import pytest

from ledgerflow.operators.contract import Contract
from ledgerflow.operators.validate import quarantine_rows, valid_rows, validate
from ledgerflow.schema import default_contract

DATE = "transaction_date must be a valid ISO 8601 UTC timestamp ending with Z or +00:00"
CURRENCY = "currency must be one of ['AUD', 'CAD', 'CHF', 'EUR', 'GBP', 'JPY', 'USD']"


def errors(raw, contract=None):
    return [row["errors"] for row in validate(raw, contract).collect()]


def test_valid_record_is_typed(make_raw):
    row = valid_rows(validate(make_raw({"transaction_date": "2024-03-30T22:35:29+00:00"}))).first()
    assert str(row["transaction_date"]) == "2024-03-30 22:35:29"
    assert str(row["amount"]) == "12.34"


@pytest.mark.parametrize(
    "change, expected",
    [
        ({"transaction_id": "TX-1"}, ["transaction_id must match pattern TXN-[A-Z0-9]+"]),
        ({"transaction_id": "TXN-a"}, ["transaction_id must match pattern TXN-[A-Z0-9]+"]),
        ({"transaction_id": "TXN-1\n"}, ["transaction_id must match pattern TXN-[A-Z0-9]+"]),
        ({"account_id": "ACC-12345"}, ["account_id must match format ACC-NNNN"]),
        ({"transaction_date": "2024-03-30T10:00:00+01:00"}, [DATE]),
        ({"transaction_date": "2024-03-30T10:00:00"}, [DATE]),
        ({"transaction_date": "2024-02-31T10:00:00Z"}, [DATE]),
        ({"transaction_date": "2024-03-30T24:00:00Z"}, [DATE]),
        ({"transaction_date": "2024-03-30T10:00:60Z"}, [DATE]),
        ({"transaction_date": "0000-03-30T10:00:00Z"}, [DATE]),
        ({"transaction_date": "2024-03-30 10:00:00Z"}, [DATE]),
        ({"currency": "eur"}, [CURRENCY]),
        ({"transaction_type": "Debit"}, ["transaction_type must be one of ['credit', 'debit']"]),
        ({"status": "done"}, ["status must be one of ['completed', 'failed', 'pending', 'reversed']"]),
        ({"merchant_name": "   "}, ["merchant_name must contain at least one non-whitespace character"]),
        ({"merchant_name": "　\t"}, ["merchant_name must contain at least one non-whitespace character"]),
        ({"country_code": "ZZ"}, ["country_code must be an assigned ISO 3166-1 alpha-2 code"]),
        ({"country_code": "se"}, ["country_code must be an assigned ISO 3166-1 alpha-2 code"]),
        ({"merchant_name": ""}, ["merchant_name is required"]),
        ({"account_id": ...}, ["account_id is required"]),
        ({"note": "x", "extra": 1}, ["unexpected fields: ['extra', 'note']"]),
        ({"id": 17}, []),
        ({"status": "reversed"}, []),
        ({"merchant_name": "Café Ørsted 寿司"}, []),
    ],
)
def test_single_rules(make_raw, change, expected):
    assert errors(make_raw(change)) == [expected]


@pytest.mark.parametrize(
    "text, message",
    [
        ("abc", "amount must be decimal"),
        ("NaN", "amount must be decimal"),
        ("Infinity", "amount must be decimal"),
        ("1_000", "amount must be decimal"),
        ("  ", "amount must be decimal"),
        ("0", "amount must be greater than zero"),
        ("0.00", "amount must be greater than zero"),
        ("-1.00", "amount must be greater than zero"),
        ("-0.001", "amount must be greater than zero"),
        ("12.345", "amount must be a multiple of 0.01"),
        ("1e-3", "amount must be a multiple of 0.01"),
        ("1e-30", "amount must be a multiple of 0.01"),
        ("12.3400000000000000000001", "amount must be a multiple of 0.01"),
        ("1.0000000000000000000001e1", "amount must be a multiple of 0.01"),
        ("1.00000000000000000001E0", "amount must be a multiple of 0.01"),
        ("10000000000000000", "amount out of range"),
        ("99999999999999999", "amount out of range"),
        ("1e40", "amount out of range"),
    ],
)
def test_amount_rules(make_raw, text, message):
    assert errors(make_raw({"amount": text})) == [[message]]


@pytest.mark.parametrize(
    "text, stored",
    [("12.34", "12.34"), ("12.340", "12.34"), ("12.5", "12.50"), ("5.", "5.00"), (".5", "0.50"), ("+7", "7.00"),
     (" 3.10 ", "3.10"), ("1e2", "100.00"), ("9999999999999999.99", "9999999999999999.99")],
)
def test_amounts_are_exact(make_raw, text, stored):
    assert str(valid_rows(validate(make_raw({"amount": text}))).first()["amount"]) == stored


def test_json_number_amount(make_raw):
    assert str(valid_rows(validate(make_raw({"amount": 84.25}))).first()["amount"]) == "84.25"


def test_all_rules_report(make_raw):
    bad = {"amount": "0", "merchant_name": " ", "status": "COMPLETED", "country_code": "ZZ"}
    assert errors(make_raw(bad)) == [
        [
            "amount must be greater than zero",
            "status must be one of ['completed', 'failed', 'pending', 'reversed']",
            "merchant_name must contain at least one non-whitespace character",
            "country_code must be an assigned ISO 3166-1 alpha-2 code",
        ]
    ]


NULLS = {
    "transaction_id": (
        ["transaction_id must match pattern TXN-[A-Z0-9]+"],
        ["transaction_id violates schema: 'None' does not match '^TXN-[A-Z0-9]+$'"],
    ),
    "account_id": (
        ["account_id must match format ACC-NNNN"],
        ["account_id violates schema: 'None' does not match '^ACC-\\\\d{4}$'"],
    ),
    "transaction_date": ([DATE], ["transaction_date is required by schema"]),
    "amount": ([], ["amount is required by schema"]),
    "currency": (
        [CURRENCY],
        ["currency violates schema: 'None' is not one of ['USD', 'EUR', 'GBP', 'CHF', 'JPY', 'AUD', 'CAD']"],
    ),
    "merchant_name": ([], []),
    "country_code": (
        ["country_code must be an assigned ISO 3166-1 alpha-2 code"],
        [
            "country_code violates schema: 'None' does not match '^[A-Z]{2}$'",
            "country_code violates schema: 'None' is too long",
        ],
    ),
}


@pytest.mark.parametrize("field", NULLS)
def test_explicit_null(make_raw, field):
    rules, contract = NULLS[field]
    found = errors(make_raw({field: None}), Contract(default_contract()))
    assert found == [[f"{field} is required", *rules, *contract]]


def test_missing_field_with_contract(make_raw):
    found = errors(make_raw({"currency": ...}), Contract(default_contract()))
    assert found == [["currency is required", "currency is required by schema"]]


def test_unexpected_field_with_contract(make_raw):
    found = errors(make_raw({"reviewer_note": "x"}), Contract(default_contract()))
    assert found == [
        [
            "unexpected fields: ['reviewer_note']",
            "record violates schema: Additional properties are not allowed ('reviewer_note' was unexpected)",
        ]
    ]


def test_offset_date_satisfies_zulu_pattern(make_raw):
    raw = make_raw({"transaction_date": "2024-03-30T10:00:00+00:00"})
    assert errors(raw, Contract(default_contract())) == [[]]


def test_contract_errors_are_ordered_by_field(make_raw):
    raw = make_raw({"transaction_type": "x", "amount": "abc", "currency": "x"})
    found = [e for e in errors(raw, Contract(default_contract()))[0] if "schema" in e]
    assert [e.split()[0] for e in found] == ["amount", "currency", "transaction_type"]
    assert found[0] == "amount violates schema: 'abc' is not of type 'number'"


def test_quarantine_rows_collapse_copies(make_raw):
    raw = make_raw({"status": "x"}, {"status": "x"}, {"status": "y"}, {})
    audit = {"source": "csv", "batch_id": "b", "ingestion_timestamp": "2024-01-01T00:00:00Z"}
    rows = quarantine_rows(validate(raw), **audit).collect()
    assert len(rows) == 2
    assert {row["error_count"] for row in rows} == {1}
    assert len({row["quarantine_id"] for row in rows}) == 2
    assert str(rows[0]["event_date"]) == "2024-03-30"


def test_is_valid_agrees_with_errors(make_raw):
    checked = validate(make_raw({}, {"amount": None}, {"status": ...}, {"x": 1}), Contract(default_contract()))
    assert all(row["is_valid"] == (row["errors"] == []) for row in checked.collect())
