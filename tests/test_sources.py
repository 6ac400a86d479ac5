import json

import pytest
from pyspark.errors import PySparkException

from ledgerflow.operators.contract import Contract
from ledgerflow.operators.validate import valid_rows, validate
from ledgerflow.plans.settings import Settings
from ledgerflow.schema import FIELDS, default_contract
from ledgerflow.sources.csv_files import load_csv_transactions, normalized_names, read_csv
from ledgerflow.sources.landing import RejectedBatch, append_records
from ledgerflow.sources.paged import AuthError, HttpPages, RequestError, TransientError, page_params, read_paged
from ledgerflow.sources.sample import check_source_sample
from ledgerflow.sources.select import load_transactions
from tests.conftest import BASE


def ids(rows):
    return sorted(row["transaction_id"] for row in rows.select("transaction_id").collect())


# --- csv --------------------------------------------------------------------------------------


def test_header_and_values_are_normalised(spark, write_csv):
    path = write_csv({"merchant_name": "  Shop\t", "country_code": " SE"}, header=[f" {f.upper()} " for f in FIELDS])
    row = read_csv(spark, path).first()
    assert (row["merchant_name"], row["country_code"]) == ("Shop", "SE")
    assert set(row["field_names"]) == set(FIELDS)


def test_colliding_headers():
    with pytest.raises(ValueError, match="amount"):
        normalized_names(["Amount", " amount "])


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path / "none.csv"))


def test_watermark_keeps_boundary_and_unreadable_dates(spark, write_csv):
    path = write_csv(
        {"transaction_id": "TXN-1", "transaction_date": "2024-03-30T22:35:28Z"},
        {"transaction_id": "TXN-2", "transaction_date": "2024-03-30T22:35:29+00:00"},
        {"transaction_id": "TXN-3", "transaction_date": "not-a-date"},
        {"transaction_id": "TXN-4", "transaction_date": ""},
    )
    assert ids(load_csv_transactions(spark, path, "2024-03-30T22:35:29Z")) == ["TXN-2", "TXN-3", "TXN-4"]
    with pytest.raises(ValueError):
        load_csv_transactions(spark, path, "yesterday")


def test_lines_that_do_not_fit_the_header(spark, tmp_path):
    line = ",".join(BASE.values())
    lines = [
        ",".join(FIELDS),
        line,
        line + ",surplus",
        ",".join(list(BASE.values())[:8]),
        line.replace("Corner Shop", '"Corner, ""the"" Shop"'),
        line.replace("Corner Shop", ""),
        ",".join([*list(BASE.values())[:6], "", ""]),
    ]
    path = tmp_path / "odd.csv"
    path.write_text("\n".join(lines) + "\n")
    found = [row["errors"] for row in validate(read_csv(spark, str(path))).collect()]
    assert found[0] == [] and found[3] == []
    assert found[1] == ["unexpected fields: ['extra_cells']"]
    assert found[2][:2] == ["status is required", "country_code is required"]
    assert "status must be one of" in found[2][2]  # a missing cell is an explicit null
    assert found[4] == ["merchant_name is required"]
    assert found[5][:4] == [
        "merchant_name is required", "merchant_category is required", "status is required", "country_code is required"
    ]
    payloads = [row["raw_payload"] for row in validate(read_csv(spark, str(path))).collect()]
    assert "surplus" in payloads[1]
    last_columns = [row["country_code"] for row in read_csv(spark, str(path)).select("country_code").collect()]
    assert last_columns == ["SE", "SE", None, "SE", "SE", None]


def test_multi_line_values(spark, tmp_path):
    path = tmp_path / "breaks.csv"
    path.write_text(",".join(FIELDS) + "\n" + ",".join({**BASE, "merchant_name": '"Corner\nShop"'}.values()) + "\n")
    assert read_csv(spark, str(path)).first()["merchant_name"] == "Corner\nShop"
    split = validate(read_csv(spark, str(path), multi_line=False))
    assert split.filter("is_valid").count() == 0 and split.count() == 2  # quarantined, not lost


def test_only_files_with_line_breaks_are_not_split(spark, tmp_path):
    folder = tmp_path / "a folder é"
    folder.mkdir()
    record = {**BASE, "transaction_id": "TXN-B", "merchant_name": '"Corner\nShop"'}
    (folder / "b%20 é.csv").write_text(",".join(FIELDS) + "\n" + ",".join(record.values()) + "\n")
    many = [",".join({**BASE, "transaction_id": f"TXN-{n}"}.values()) for n in range(2000)]
    (folder / "clean.csv").write_text("\n".join([",".join(FIELDS), *many]) + "\n")
    path = str(folder)
    before = {key: spark.conf.get(key) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        rows = read_csv(spark, path)
        assert rows.rdd.getNumPartitions() > 5
        found = {row["transaction_id"]: row["merchant_name"] for row in rows.collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(found) == 2001 and found["TXN-B"] == "Corner\nShop" and found["TXN-7"] == BASE["merchant_name"]
    assert rows.count() == 2001


# --- paged ------------------------------------------------------------------------------------


def numbered(count):
    return [{**BASE, "id": n, "transaction_id": f"TXN-{n:03d}", "amount": 1.5} for n in range(count)]


class Pages:
    def __init__(self, count, fail_at=None, error=None):
        self.records, self.fail_at, self.error = numbered(count), fail_at, error

    def __call__(self, params):
        if self.fail_at is not None and params["offset"] >= self.fail_at:
            raise self.error
        return self.records[params["offset"] : params["offset"] + params["limit"]]


@pytest.mark.parametrize("count", [0, 1, 9, 10, 11, 30, 47])
@pytest.mark.parametrize("parallelism", [1, 3])
def test_every_record_is_read_once(spark, count, parallelism):
    rows = read_paged(spark, Pages(count), page_size=10, parallelism=parallelism)
    assert ids(rows) == [f"TXN-{n:03d}" for n in range(count)]


def test_request_parameters():
    assert page_params(3, 100, "2024-01-01T00:00:00Z") == {
        "limit": 100,
        "offset": 300,
        "order": "transaction_date.asc,transaction_id.asc",
        "transaction_date": "gte.2024-01-01T00:00:00Z",
    }
    assert "transaction_date" not in page_params(0, 100, None)


class Watermarked(Pages):
    """Applies the filter parameter as a server would."""

    def __call__(self, params):
        bound = params["transaction_date"].removeprefix("gte.")
        rows = [record for record in self.records if record["transaction_date"] >= bound]
        return rows[params["offset"] : params["offset"] + params["limit"]]


def test_watermark_is_sent_to_the_source(spark):
    pages = Watermarked(6)
    for day, record in enumerate(pages.records, start=1):
        record["transaction_date"] = f"2024-03-0{day}T00:00:00Z"
    rows = read_paged(spark, pages, watermark="2024-03-04T00:00:00Z", page_size=2, parallelism=2)
    assert ids(rows) == ["TXN-003", "TXN-004", "TXN-005"]


def test_api_and_csv_give_the_same_row(spark, write_csv):
    api = {**BASE, "id": 1, "amount": 12.34, "transaction_date": "2024-03-30T10:00:00+00:00"}

    def one_page(params, record=api):
        return [record] if params["offset"] == 0 else []

    from_api = valid_rows(validate(read_paged(spark, one_page, page_size=5))).collect()
    assert from_api == valid_rows(validate(read_csv(spark, write_csv({})))).collect()


class Server:
    """Answers with the given (status, body) pairs, one per request."""

    def __init__(self, *answers):
        self.answers, self.requests, self.waits = list(answers), [], []

    def pages(self, **options):
        return HttpPages("http://host/", send=self.send, sleep=self.waits.append, **options)

    def send(self, url, headers, timeout):
        self.requests.append((url, headers, timeout))
        answer = self.answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer


def test_http_retries_then_succeeds():
    server = Server((503, ""), TimeoutError(), (429, ""), (200, "[]"))
    assert server.pages()({"limit": 1}) == []
    assert server.waits == [1, 2, 4]


def test_http_gives_up():
    server = Server(*[(500, "")] * 4)
    with pytest.raises(TransientError, match="HTTP 500 after 3 retries"):
        server.pages()({})
    with pytest.raises(TransientError, match="timed out"):
        Server(TimeoutError(), TimeoutError()).pages(max_retries=1)({})


@pytest.mark.parametrize("status, error", [(401, AuthError), (403, AuthError), (404, RequestError)])
def test_http_refusals_are_not_retried(status, error):
    server = Server((status, ""))
    with pytest.raises(error):
        server.pages()({})
    assert server.waits == []


def test_http_request_form():
    server = Server((200, json.dumps([{"id": 1}])), (200, "{}"))
    pages = server.pages(api_key="k")
    assert pages({"limit": 2, "offset": 4}) == [{"id": 1}]
    url, headers, _ = server.requests[0]
    assert url == "http://host/transactions?limit=2&offset=4"
    assert headers == {"apikey": "k", "Authorization": "Bearer k"}
    with pytest.raises(ValueError):
        pages({})
    assert HttpPages("http://host").headers == {}


# --- choice of source -------------------------------------------------------------------------


def settings(csv_path, **changes):
    return Settings(csv_path=csv_path, store_path="s", output_path="o", api_base_url="http://host", **changes)


def test_csv_is_read_when_configured(spark, write_csv):
    loaded = load_transactions(spark, settings(write_csv({}), source="csv"))
    assert (loaded.resolved_source, ids(loaded.rows)) == ("csv", ["TXN-1"])


def test_api_is_read_when_it_answers(spark, write_csv):
    loaded = load_transactions(spark, settings(write_csv({}), page_limit=2), fetch_page=Pages(3))
    assert (loaded.resolved_source, len(ids(loaded.rows))) == ("api", 3)


@pytest.mark.parametrize("error", [TransientError("down"), RequestError("gone")])
def test_failing_page_falls_back(spark, write_csv, error):
    config = settings(write_csv({}), page_limit=2)
    loaded = load_transactions(spark, config, fetch_page=Pages(9, fail_at=4, error=error))
    assert (loaded.resolved_source, ids(loaded.rows)) == ("csv_fallback", ["TXN-1"])


def test_no_fallback_when_forbidden(spark, write_csv):
    config = settings(write_csv({}), allow_csv_fallback=False)
    with pytest.raises(PySparkException, match="down"):
        load_transactions(spark, config, fetch_page=Pages(1, 0, TransientError("down")))


@pytest.mark.parametrize("error", [AuthError("denied"), KeyError("bug")])
def test_other_errors_never_fall_back(spark, write_csv, error):
    with pytest.raises(PySparkException):
        load_transactions(spark, settings(write_csv({})), fetch_page=Pages(1, 0, error))


# --- sample and landing -----------------------------------------------------------------------


def test_sample_check(spark):
    summary = check_source_sample(spark, Pages(20), Contract(default_contract()), limit=3)
    assert summary == {
        "passed": True,
        "records_read": 3,
        "valid_records": 3,
        "quarantined_records": 0,
        "sample_transaction_ids": ["TXN-000", "TXN-001", "TXN-002"],
    }


def test_sample_check_fails(spark):
    with pytest.raises(RuntimeError, match="no records"):
        check_source_sample(spark, Pages(0))
    bad = Pages(3)
    bad.records[1]["status"] = "odd"
    with pytest.raises(RuntimeError, match='"quarantined_records": 1'):
        check_source_sample(spark, bad)


def test_landing_append_is_all_or_nothing(spark, make_raw, write_csv, tmp_path):
    path = str(tmp_path / "landing")
    assert append_records(make_raw({"transaction_id": "TXN-A"}), path) == 1
    assert append_records(make_raw({"transaction_id": "TXN-B", "merchant_name": 'A "b", c'}), path) == 1
    with pytest.raises(RejectedBatch, match="1 of 2"):
        append_records(make_raw({"transaction_id": "TXN-C"}, {"amount": "x"}), path)
    landed = read_csv(spark, path)
    assert ids(landed) == ["TXN-A", "TXN-B"]
    assert sorted(row["merchant_name"] for row in landed.collect()) == ['A "b", c', "Corner Shop"]


def test_a_body_that_is_no_json_is_a_failed_request():
    pages = HttpPages("http://source", send=lambda url, headers, timeout: (200, '[{"id": 1'))
    with pytest.raises(RequestError):
        pages(page_params(0, 5, None))
