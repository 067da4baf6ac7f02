"""Line numbers over blocks and files, zipped texts, and logs as rows."""

from datetime import datetime

import pytest

from feedloom import jobs
from feedloom.plans import sync
from feedloom.sources import files, logs


@pytest.mark.parametrize("block", [16, 50, 1 << 20])
def test_numbers_are_dense_at_any_block_size(spark, tmp_path, block):
    texts = {"b.txt": [f"b{k}" * (k % 9) for k in range(100)], "a.txt": ["", "x"], "c.txt": [], "d.txt": ["last"]}
    for name, lines in texts.items():
        (tmp_path / name).write_text("".join(f"{line}\n" for line in lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = [(r["value"], r["file"].rsplit("/", 1)[1], r["file_line"], r["line_no"]) for r in files.numbered_lines(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    expected = [(line, name, k) for name in sorted(texts) for k, line in enumerate(texts[name], 1)]
    assert sorted(found, key=lambda r: r[3]) == [(*row, k) for k, row in enumerate(expected, 1)]


def test_texts_are_pasted_line_by_line(spark, tmp_path):
    (tmp_path / "left").write_text("a\n\nc\n")
    (tmp_path / "right").write_text("1\n2\n3\n4\n")
    left, right = (files.numbered_lines(spark, str(tmp_path / n), "\n") for n in ("left", "right"))
    zipped = files.zip_lines(left, right)
    assert [tuple(r) for r in zipped.orderBy("line_no").collect()] == [(1, "a\t1", True), (2, "\t2", True), (3, "c\t3", True), (4, "\t4", False)]
    assert tuple(files.zip_counts(zipped).first()) == (4, 1)
    assert files.zip_lines(left, left.where("false"), "|").orderBy("line_no").first()["value"] == "a|"


def test_logs_as_typed_rows(spark, rows_of):
    texts = ["read_data\t1\tsucc\td1\tok\tnull\te1 ", "read_data\tx\tsucc\td2\tok\tr\te", "read_data\t3\tsucc", "started", "other read\t1", "read_data\t4\terror\td4\tnull\tno_review\tnull", None]
    lines = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "line_no long, value string")
    form = logs.LogFormat("read_data", "flag string, n long, ret string, docid string, status string, reason string, editor string", null_text="null")
    read = logs.read_log(lines, form)
    assert rows_of(logs.log_rows(read), "line_no", "n", "ret", "docid", "status", "reason", "editor") == [
        (0, 1, "succ", "d1", "ok", None, "e1"), (5, 4, "error", "d4", None, "no_review", None),
    ]
    assert rows_of(logs.quarantined(read), "line_no", "problem") == [(1, "bad n"), (2, "not in the format")]
    assert logs.quarantined(read).where("line_no = 2").first()["value"] == texts[2]
    assert tuple(logs.log_counts(lines, form).first()) == (7, 4, 2)


def test_messages_of_a_log_are_those_of_the_outcome(spark, tmp_path, rows_of):
    outcome = spark.createDataFrame([("a", "new", sync.NOT_IN_INDEX), ("b", "", sync.NOT_IN_INDEX), ("c", "x", sync.UPDATED)], "docid string, timeliness string, msg string")
    docs = spark.createDataFrame([("a", "u")], "_id string, url string")
    sync.outcome_log(outcome, "2024-01-31 00:00:00").write.text(str(tmp_path / "in" / "index_sync_log"))
    with open(tmp_path / "in" / "index_sync_log" / "zz.txt", "w") as late:
        late.write("2024 : INFO : docid=c y msg=none\nfinished. total=3\ndocid=lost\n")
    docs.write.parquet(str(tmp_path / "in" / "doc_static"))
    run = jobs.Run(spark, str(tmp_path / "in"), str(tmp_path / "out"), datetime(2024, 1, 31))
    jobs.reindex_from_log(run)
    later = outcome.where("docid <> 'c'").unionByName(spark.createDataFrame([("c", "y", sync.NOT_IN_INDEX)], outcome.schema))
    assert rows_of(spark.read.parquet(run.path("reindex_messages"))) == rows_of(sync.reindex_messages(later, docs))
    assert rows_of(spark.read.parquet(run.path("index_sync_log_quarantine")), "problem", "value") == [("not in the format", "docid=lost")]
