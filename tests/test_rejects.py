"""CSV files with bad records (read_checked)."""
import pytest

from rulebeam.sources.transactions import TRANSACTION_SCHEMA, read_checked, read_transactions

HEAD = ",trans_date_trans_time,cc_num,category,amt,gender,lat,long,dob,merch_lat,merch_long,is_fraud\n"
GOOD = ["0,2019-01-01 00:00:18,42,misc_net,4.97,F,36.08,-81.18,1988-03-09,36.01,-82.05,0",
        "1,2019-01-01 23:10:00,43,\"a, \"\"b\"\"\",950.5,M,48.89,-118.21,1962-01-19,49.16,-118.19,1",
        "2,,,,,,,,,,,"]
BAD = {"3,2019-01-01 23:10:00,43,x,9.5 USD,M,48.89,-118.21,1962-01-19,49.16,-118.19,1": [("amt", "9.5 USD", "Malformed double")],
       "4,2019-13-01 23:10:00,43,x,1,M,abc,-118.21,1962-02-30,49.16,-118.19,yes": [
           ("trans_date_trans_time", "2019-13-01 23:10:00", "Malformed timestamp"), ("dob", "1962-02-30", "Malformed date"),
           ("lat", "abc", "Malformed double"), ("is_fraud", "yes", "Malformed int")],
       "5,2019-01-01 23:10:00,43": [(None, None, "Wrong number of fields")],
       "6,2019-01-01 23:10:00,43,x,1,M,1,1,1962-01-19,1,1,1,extra": [(None, None, "Wrong number of fields")]}


def write(tmp_path, lines, name="t.csv"):
    path = tmp_path / name
    path.write_text(HEAD + "\n".join(lines) + "\n")
    return str(path)


def test_bad_records_go_apart(spark, tmp_path):
    got = read_checked(spark, write(tmp_path, [*GOOD, *BAD]))
    clean = read_transactions(spark, write(tmp_path, GOOD, "good.csv"), schema=TRANSACTION_SCHEMA)
    assert got.rows.schema == clean.schema
    assert sorted(map(str, got.rows.collect())) == sorted(map(str, clean.collect()))
    found = {}
    for r in got.rejects.collect():
        assert r.file.endswith("t.csv")
        found.setdefault(r.record, []).append((r.column, r.text, r.reason))
        assert r.row == r.record.split(",")[0]
    assert {k.split(",")[0]: sorted(v, key=str) for k, v in found.items()} == {
        k.split(",")[0]: sorted(v, key=str) for k, v in BAD.items()}
    assert tuple(got.counts.first()) == (7, 4)


def test_share_of_rejected_records(spark, tmp_path):
    got = read_checked(spark, write(tmp_path, [*GOOD, *BAD]))
    assert got.within(4 / 7 + 1e-9) is got
    with pytest.raises(ValueError, match="4 of 7 records"):
        got.within(0.5)
    none = read_checked(spark, write(tmp_path, [], "empty.csv"))
    assert none.within(0.0).rows.count() == 0 and none.rejects.count() == 0


def test_only_some_columns_read(spark, tmp_path):
    """Short records stay rejected, whatever columns a query asks for."""
    got = read_checked(spark, write(tmp_path, [*GOOD, *BAD]))
    assert got.rows.select("category").count() == 3 and got.rows.count() == 3


def test_taken_names_and_files_without_index(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("amt,note\n1.5,a\nx,b\n")
    got = read_checked(spark, str(path))
    assert [tuple(r) for r in got.rows.collect()] == [(1.5, "a")]
    assert [(r.row, r.column, r.record) for r in got.rejects.collect()] == [(None, "amt", "x,b")]
    path = tmp_path / "y.csv"
    path.write_text("amt,_faults\n1.5,a\n")
    with pytest.raises(ValueError, match="_faults"):
        read_checked(spark, str(path))


def test_run_from_files_leaves_bad_records_out(spark, tmp_path):
    from rulebeam.plans.mining import run_from_files
    train, test = write(tmp_path, [*GOOD * 5, *list(BAD)[:1]], "train.csv"), write(tmp_path, GOOD, "test.csv")
    rows = run_from_files(spark, train, test, max_rejected=0.1).rows
    assert rows.where("split = 'train'").count() == 15
    with pytest.raises(ValueError, match="1 of 16 records"):
        run_from_files(spark, train, test, max_rejected=0.01)
