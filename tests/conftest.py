import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerflow.schema import FIELDS, default_contract  # noqa: E402
from ledgerflow.session import get_spark  # noqa: E402
from ledgerflow.sources.json_records import json_records  # noqa: E402

BASE = dict(
    zip(
        FIELDS,
        (
            "TXN-1",
            "ACC-1001",
            "2024-03-30T10:00:00Z",
            "12.34",
            "EUR",
            "debit",
            "Corner Shop",
            "groceries",
            "completed",
            "SE",
        ),
    )
)


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def make_raw(spark):
    """Raw records from dicts; a field set to ``...`` is left out."""

    def make(*changes):
        rows = []
        for change in changes:
            record = {**BASE, **change}
            rows.append((json.dumps({k: v for k, v in record.items() if v is not ...}, sort_keys=True),))
        return json_records(spark.createDataFrame(rows, "raw_payload string"))

    return make


@pytest.fixture
def write_csv(tmp_path):
    def write(*changes, name="transactions.csv", header=FIELDS):
        lines = [",".join(header)]
        for change in changes:
            record = {**BASE, **change}
            lines.append(",".join(str(record[field.strip().lower()]) for field in header))
        path = tmp_path / name
        path.write_text("\n".join(lines) + "\n", encoding="utf-8")
        return str(path)

    return write


@pytest.fixture
def contract_file(tmp_path):
    path = tmp_path / "contract.json"
    path.write_text(json.dumps(default_contract(), default=float), encoding="utf-8")
    return str(path)
