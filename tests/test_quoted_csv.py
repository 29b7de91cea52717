"""Files with line breaks in quoted cells, in many splits, against a whole-file reader."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan
from txquality import schemas
from txquality.sources import files, quoted_csv, raw_load

CELLS = ["", "plain", 'a "quoted" word', "line\nbreak", '"', '""', "comma, and\nbreak", "\n\n", 'x"\n"y', "é\nü", "\r\nwindows", ",", 'ends with "']


@pytest.fixture
def small_splits(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "64"}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value else spark.conf.unset(key)


def put(path, rows, end="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(schemas.TRANSACTION_COLUMNS)
        writer.writerows(rows)


def record(i, text):
    row = dict.fromkeys(schemas.TRANSACTION_COLUMNS, "v") | {"transaction_id": f"t{i}", "amount": "1.5", "fee_amount": "", "description": text, "counterparty": f"c{i}"}
    return list(row.values())


def read(spark, folder):
    rows = files.read_csv_folder(spark, str(folder), schemas.TRANSACTIONS, multi_line=True)
    return sorted((r["transaction_id"], r["counterparty"], r["description"]) for r in rows.collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_many_splits_give_the_rows_of_a_whole_file(spark, tmp_path, small_splits, seed, end):
    draw = random.Random(seed)
    texts = ["".join(draw.choices(CELLS, k=draw.randrange(1, 4))) for _ in range(300)]
    # one cell is longer than several splits
    texts[draw.randrange(300)] = "long\n" * 400
    put(tmp_path / "in/a.csv", [record(i, t) for i, t in enumerate(texts)], end)
    put(tmp_path / "in/b.csv", [record("b", "second\nfile")], end)
    lines = quoted_csv._lines(spark, f"{tmp_path}/in/*.csv")
    assert lines.select("file", "start").distinct().count() > 20 and lines.rdd.getNumPartitions() > 20
    missing = set(schemas.FRAME_NULL_TOKENS)
    want = [(f"t{i}", f"c{i}", None if t in missing else t) for i, t in enumerate(texts)] + [("tb", "cb", "second\nfile")]
    assert read(spark, tmp_path / "in") == sorted(want, key=lambda r: r[0])


def test_same_rows_as_the_reader_of_whole_files(spark, tmp_path, small_splits):
    """Also where quotes stand inside cells that are not quoted."""
    lines = [",".join(schemas.TRANSACTION_COLUMNS)]
    odd = ['5" pipe', 'a"b"c', '"quoted"', '"two\nlines"', '"say ""hi""\nagain"', "plain", "", '"a,b"', '"',]
    for i in range(200):
        text = odd[i % 8]
        lines.append(f"t{i},c,PAYMENT,1.5,USD,DONE,x,{text},d,,{text},,,,,,")
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text("\n".join(lines) + "\n")
    whole = spark.read.options(header="true", multiLine="true", escape='"').schema(schemas.TRANSACTIONS).csv(f"{tmp_path}/in/a.csv")
    found = files.read_csv_folder(spark, f"{tmp_path}/in", schemas.TRANSACTIONS, multi_line=True)
    pick = ["transaction_id", "reference_number", "description", "amount"]
    assert sorted(map(tuple, found.select(*pick).collect()), key=str) == sorted(map(tuple, whole.select(*pick).collect()), key=str)


def test_the_plan_has_no_shuffle_of_rows(spark, tmp_path):
    put(tmp_path / "in/a.csv", [record(1, "one\ntwo")])
    found = plan(files.read_csv_folder(spark, f"{tmp_path}/in", schemas.TRANSACTIONS, multi_line=True))
    # exchanges: two of the splits' outcomes, two of the pieces that cross splits
    assert "BroadcastHashJoin" in found and "SortMergeJoin" not in found
    assert found.count("Exchange hashpartitioning(") <= 4


def test_headers_and_broken_rows(spark, tmp_path, small_splits):
    put(tmp_path / "in/a.csv", [record(i, "one\ntwo") for i in range(30)])
    (tmp_path / "in/b.csv").write_text("other,columns\n1,2\n")
    with pytest.raises(Exception, match="header"):
        read(spark, tmp_path / "in")
    (tmp_path / "in/b.csv").write_text("﻿" + ",".join(schemas.TRANSACTION_COLUMNS) + "\n" + ",".join(record("x", '"open\nnever closed')) + "\n")
    with pytest.raises(Exception, match="other cells"):
        read(spark, tmp_path / "in")
    (tmp_path / "in/b.csv").write_text(",".join(schemas.TRANSACTION_COLUMNS) + "\n\n\n" + ",".join(record("x", '"a\nb"')) + ",extra\n")
    with pytest.raises(Exception, match="other cells"):
        read(spark, tmp_path / "in")
    with pytest.raises(FileNotFoundError):
        files.read_csv_folder(spark, f"{tmp_path}/none", schemas.TRANSACTIONS, multi_line=True)


def test_a_load_of_split_files(spark, tmp_path, small_splits):
    rows = [record(i, "one\ntwo, three") for i in range(120)]
    rows[50][schemas.TRANSACTION_COLUMNS.index("amount")] = "no number"
    put(tmp_path / "in/a.csv", [*rows, ["too", "few"]])
    put(tmp_path / "in/none.csv", [])
    report = raw_load.load_table(spark, f"{tmp_path}/in", schemas.TRANSACTIONS, f"{tmp_path}/raw", "l1", multi_line=True)
    found = {r["file"].rsplit("/", 1)[-1]: (r["rows_parsed"], r["rows_loaded"], r["errors_seen"]) for r in report.collect()}
    assert found == {"a.csv": (121, 119, 2), "none.csv": (0, 0, 0)}
    texts = raw_load.raw_table(spark, f"{tmp_path}/raw", schemas.TRANSACTIONS).filter(F.col("description") == "one\ntwo, three")
    assert texts.count() == 119


@pytest.mark.parametrize(
    ("line", "outside", "inside"),
    [("a,b", False, True), ('"a', True, False), ('a"', False, False), ('"a",b', False, False), ('""', False, True), ('"""', True, False), ('x",y', False, False), ('x","y', True, True), ('",', True, False), ('5" z', False, False)],
)
def test_quotes_open_cells_only_where_they_begin(line, outside, inside):
    assert (quoted_csv.ends_inside(line, False), quoted_csv.ends_inside(line, True)) == (outside, inside)
