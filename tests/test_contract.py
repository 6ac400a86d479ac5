from decimal import Decimal

import pytest

from ledgerflow.operators.contract import Contract, load_contract
from ledgerflow.operators.validate import validate
from ledgerflow.schema import default_contract


def contract_with(field, **rules):
    document = default_contract()
    document["properties"][field].update(rules)
    return Contract(document)


def test_file_round_trip(spark, contract_file):
    contract = load_contract(spark, contract_file)
    assert contract.properties["amount"]["multipleOf"] == Decimal("0.01")


@pytest.mark.parametrize(
    "document",
    [
        [],
        {"type": "array"},
        {"if": {}},
        {"required": "amount"},
        {"properties": {"amount": {"format": "x", "not": {}}}},
        {"properties": {"amount": {"multipleOf": 0}}},
        {"properties": {"status": {"pattern": "["}}},
        {"properties": {"status": {"type": "text"}}},
        {"properties": {"colour": {"type": "string"}}},
    ],
)
def test_bad_documents_are_refused(document):
    with pytest.raises(ValueError):
        Contract(document)


def test_text_that_is_not_json(spark, tmp_path):
    path = tmp_path / "contract.json"
    path.write_text("{")
    with pytest.raises(ValueError):
        load_contract(spark, str(path))


@pytest.mark.parametrize(
    "contract, change, expected",
    [
        (contract_with("amount", maximum=10), {}, "amount violates schema: Decimal('12.34') is greater than the maximum of 10"),
        (contract_with("amount", minimum=20), {}, "amount violates schema: Decimal('12.34') is less than the minimum of 20"),
        (contract_with("amount", exclusiveMaximum=12), {}, "amount violates schema: Decimal('12.34') is greater than or equal to the maximum of 12"),
        (contract_with("amount", type="integer"), {}, "amount violates schema: Decimal('12.34') is not of type 'integer'"),
        (contract_with("merchant_name", maxLength=3), {}, "merchant_name violates schema: 'Corner Shop' is too long"),
        (contract_with("currency", enum=["USD"]), {}, "currency violates schema: 'EUR' is not one of ['USD']"),
        (contract_with("status", type="number"), {}, "status violates schema: 'completed' is not of type 'number'"),
        (contract_with("account_id", pattern="^ACC-2"), {}, "account_id violates schema: 'ACC-1001' does not match '^ACC-2'"),
    ],
)
def test_keywords_beyond_the_rules(make_raw, contract, change, expected):
    row = validate(make_raw(change), contract).first()
    assert row["errors"] == [expected]
    assert not row["is_valid"]


def test_open_contract_and_optional_field(make_raw):
    document = default_contract()
    document["additionalProperties"] = True
    document["required"].remove("status")
    found = validate(make_raw({"status": ..., "x": 1}), Contract(document)).first()["errors"]
    assert found == ["unexpected fields: ['x']", "status is required"]


def test_field_the_contract_does_not_declare(make_raw):
    document = default_contract()
    del document["properties"]["status"]
    row = validate(make_raw({}), Contract(document)).first()
    assert row["errors"] == [
        "record violates schema: Additional properties are not allowed ('status' was unexpected)"
    ]
    assert not row["is_valid"]
