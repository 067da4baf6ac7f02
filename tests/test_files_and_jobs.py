import json
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from feedloom import commits, jobs, kvstore, sinks
from feedloom.catalog import QUERIES
from feedloom.ledger import RunLedger, once_per_key
from feedloom.plans import sync
from feedloom.sources import files, schemas
from feedloom.sources.testdata import load
from feedloom.staging import stage, staging_root


def test_delimited_round_trip(spark, tmp_path, rows_of):
    schema = "a string, b bigint, c double"
    df = spark.createDataFrame([('x "quoted"', 1, 0.5), (None, None, None), ("y,z", 2, 1.0)], schema)
    path = str(tmp_path / "tsv")
    sinks.write_delimited(df, path)
    lines = sorted(r["value"] for r in spark.read.text(path).collect())
    assert lines == ["\\N\t\\N\t\\N", 'x "quoted"\t1\t0.5', "y,z\t2\t1.0"]
    assert rows_of(files.delimited_text(spark, path, schema)) == rows_of(df)


def test_parts_read_by_name_keep_the_order(spark, tmp_path):
    df = stage(spark.range(0, 1000, 1, 7), "thousand")
    sinks.write_delimited(df, str(tmp_path / "rows"), order=[F.desc("id")])
    parts = sorted(p for p in (tmp_path / "rows").iterdir() if p.name.startswith("part-"))
    assert [int(line) for p in parts for line in p.read_text().split()] == list(range(999, -1, -1))


def test_ragged_and_control_separated_text(spark, tmp_path, rows_of):
    (tmp_path / "rows").write_text("a\tb\tc\n\tx\ty\t\nlone\n\n")
    ragged = files.ragged_text(spark, str(tmp_path / "rows"))
    assert [r["width"] for r in ragged.orderBy("line_no").collect()] == [3, 2, 1, 1]
    (tmp_path / "sep").write_text("d1\x01current\nd2\x01\n")
    df = files.delimited_text(spark, str(tmp_path / "sep"), "docid string, timeliness string", sep="\x01")
    assert [r["docid"] for r in df.orderBy("docid").collect()] == ["d1", "d2"]


def test_json_lines(spark, tmp_path, rows_of):
    (tmp_path / "docs").write_text('{"_id": "1", "title": "t"}\n{"_id": "2", "image_urls": ["a"], "extra": 1}\n')
    df = files.json_lines(spark, str(tmp_path / "docs"), schemas.DISPLAY_DOC)
    assert rows_of(df, "_id", "title", "image_urls") == [("1", "t", None), ("2", None, ["a"])]


def test_partitions_prune_and_absent_days_read_as_empty(spark, tmp_path):
    days = [date(2024, 1, d) for d in (1, 2, 4)]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "pdate date, n int")
    df.write.partitionBy("pdate").parquet(str(tmp_path / "t"))
    table = files.partitioned_table(spark, str(tmp_path / "t"), date(2024, 1, 2), date(2024, 1, 3))
    assert [r["n"] for r in table.collect()] == [1]
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pdate" in plan


def test_boolean_flags_become_integers(spark, rows_of):
    df = spark.createDataFrame([(True, 1), (False, 0), (None, None), (True, 2)], "joined boolean, checked int")
    out = files.with_int_flags(df)
    assert [t for _, t in out.dtypes] == ["int", "int"]
    assert rows_of(out) == [(0, 0), (1, 1), (1, 2), (None, None)]


def test_ledger_appends_and_writer_closes(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = spark.createDataFrame([("a", "s")], schemas.WRITTEN_LEDGER)
    sinks.append_ledger(rows, path)
    sinks.append_ledger(rows, path)
    assert spark.read.parquet(path).count() == 2
    folder = str(tmp_path)

    class FileWriter:
        def __init__(self):
            import uuid

            self.name = f"{folder}/{uuid.uuid4().hex}.out"
            self.lines = []

        def write(self, row):
            self.lines.append(row["docid"])

        def close(self):
            if self.lines:
                with open(self.name, "w") as f:
                    f.write("\n".join(self.lines))

    sinks.write_keyed(spark.read.parquet(path), FileWriter)
    assert sum(len(p.read_text().split()) for p in tmp_path.glob("*.out")) == 2


class _Session:
    """Just what staging asks of a session."""

    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: folder)})


def test_staging_uses_the_configured_folder(spark):
    assert staging_root(_Session("yarn", "s3://shared/ckpt/")) == "s3://shared/ckpt"
    assert staging_root(_Session("local[2]")) == staging_root(_Session("local[4]"))
    with pytest.raises(RuntimeError):
        staging_root(_Session("yarn"))
    staged = stage(spark.range(5), "five")
    assert staged.count() == 5
    assert all(spark.sparkContext.applicationId in f and "five-" in f for f in staged.inputFiles())


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    """The test tables written as a warehouse the jobs can read."""
    root = tmp_path_factory.mktemp("tables")
    t = load(spark, TESTDATA)
    names = (
        "interactions zip_geo doc_dim doc_static doc_static_daily doc_profile reviews crawl_rows "
        "written_ledger timeliness_updates search_index feed_dump doc_meta_json"
    ).split()
    for name in names:
        df = getattr(t, name)
        if name == "interactions":
            df = df.withColumns({f: F.col(f) == 1 for f in ("joined", "checked")})
        writer = df.write.partitionBy("pdate") if "pdate" in df.columns else df.write
        writer.parquet(str(root / name))
    return str(root)


@pytest.fixture
def run(spark, warehouse, tmp_path):
    return jobs.Run(spark, warehouse, str(tmp_path), datetime(2024, 1, 31))


def _read(run, name):
    return run.spark.read.parquet(run.path(name))


def test_geo_jobs(run, tmp_path):
    jobs.geo_top_docs(run, min_check=1, min_rows=1)
    merged = _read(run, "geo_top_docs/kv")
    assert merged.count() == merged.select("key").distinct().count() > 0
    assert merged.where("key like 'local_geo_top@%'").count() == merged.count()
    channel = {r["key"]: r["value"] for r in _read(run, "geo_top_docs_channel/kv").collect()}
    everything = {r["key"]: r["value"] for r in merged.collect()}
    assert channel.items() <= everything.items()
    jobs.geo_top_docs(run, min_check=1, min_rows=1)  # again: the store has every key once
    now = int(run.as_of.replace(tzinfo=timezone.utc).timestamp())
    assert {r["key"]: r["value"] for r in kvstore.read(run.spark, jobs.store_of(run), now).collect()} == everything
    assert kvstore.read(run.spark, jobs.store_of(run), now + 86400).count() == 0
    landed = [r["value"] for r in run.spark.read.text(run.path("geo_top_docs_channel/rows")).collect()]
    assert landed and {len(line.split("\t")) for line in landed} == {9}
    jobs.geo_new_docs(run, min_rows=1)
    assert _read(run, "geo_new_docs/kv").count() > 0
    jobs.cross_geo(run, min_users=1, min_check=1, min_rows=1)
    landed = [r["value"] for r in run.spark.read.text(run.path("cross_geo_channel/rows")).collect()]
    assert landed and {len(line.split("\t")) for line in landed} == {13}


def test_a_short_result_is_not_published(run, tmp_path):
    jobs.geo_top_docs(run, min_check=1, min_rows=10_000)
    assert (tmp_path / "geo_top_docs_channel" / "rows").exists()
    assert not (tmp_path / "geo_top_docs_channel" / "kv").exists()
    assert not (tmp_path / "geo_top_docs").exists()


def test_engagement_and_tab_jobs(run):
    jobs.engagement(run)
    row = _read(run, "engagement").where("key = 'localTopCmts'").first()
    assert row["field"].endswith("#0/1") and json.loads(row["value"])[0]["docId"]
    jobs.hot_tab_docs(run)
    assert _read(run, "hot_tab_docs").count() > 0
    stored = kvstore.read(run.spark, jobs.store_of(run), 0)
    assert stored.count() == _read(run, "hot_tab_docs").count() + _read(run, "engagement").count()
    jobs.hot_tab_docs(jobs.Run(run.spark, run.tables, run.out + "/fresh", run.as_of), fresh_only=True)


def test_tab_metric_job_reports_the_day_before(run):
    published = QUERIES["tab_metric_points"](run.spark, TESTDATA)
    ts = published.agg(F.max("ts")).first()[0]
    next_day = datetime(1970, 1, 1) + timedelta(seconds=ts + 86400)
    jobs.tab_metrics(jobs.Run(run.spark, run.tables, run.out, next_day), host="h")
    points = _read(run, "tab_metrics")
    assert {r["ts"] for r in points.collect()} == {ts}
    assert points.count() == published.where(F.col("ts") == ts).count()


def test_review_jobs(run, spark, warehouse, tmp_path):
    day = jobs.Run(spark, warehouse, str(tmp_path), datetime(2024, 1, 30))
    jobs.review_enqueue(day)
    queued = _read(day, "review_messages").count()
    assert queued == jobs.written_ledger(day).entries().count() > 0
    jobs.review_analysis(run)
    days = [r["day"] for r in _read(run, "review_summary_7d").select("day").distinct().collect()]
    assert days and min(days) >= date(2024, 1, 24) and max(days) <= date(2024, 1, 30)
    assert _read(run, "review_editors").count() > 0
    assert _read(run, "review_points_1d").where("metric like '%_count_total'").count() > 0


def test_history_and_sync_jobs(run):
    jobs.user_history(run, partitions=2)
    lines = [r["value"] for r in run.spark.read.text(run.path("user_history")).collect()]
    assert lines and all("," in line and "|" in line for line in lines)
    jobs.index_sync(run)
    counts = _read(run, "index_sync_counts").first()
    assert counts["total"] - counts["in_es"] == _read(run, "reindex_messages").count()
    expected = sync.index_sync_snapshot(run.table("timeliness_updates"), run.table("search_index"))
    assert sorted(jobs.search_index(run).read().collect()) == sorted(expected.collect())
    jobs.index_sync(run)  # again, from where it is kept
    assert sorted(jobs.search_index(run).read().collect()) == sorted(expected.collect())


def test_an_index_is_never_written_over_itself(spark, warehouse):
    with pytest.raises(ValueError, match="search_index"):
        jobs.index_sync(jobs.Run(spark, warehouse, warehouse + "/", datetime(2024, 1, 31)))
    assert spark.read.parquet(f"{warehouse}/search_index").count() > 0


def _messages(run):
    return sorted(r["key"] for r in _read(run, f"review_messages/day={run.day}").collect())


def test_days_on_one_ledger_queue_nothing_twice(spark, warehouse, tmp_path):
    queued = []
    for day in (29, 30):
        run = jobs.Run(spark, warehouse, str(tmp_path), datetime(2024, 1, day))
        jobs.review_enqueue(run)
        queued.append(_messages(run))
    ledger = jobs.written_ledger(run).entries()
    assert queued[0] and queued[1] and not set(queued[0]) & set(queued[1])
    assert sorted(queued[0] + queued[1]) == sorted(r["docid"] for r in ledger.collect())
    assert once_per_key(ledger).count() == 0


def test_a_day_run_again_queues_the_same(spark, warehouse, tmp_path):
    days = [jobs.Run(spark, warehouse, str(tmp_path), datetime(2024, 1, d)) for d in (29, 30)]
    for run in days:
        jobs.review_enqueue(run)
    first = [_messages(run) for run in days]
    counts = [r.asDict() for r in _read(days[0], "review_enqueue_counts").orderBy("day").collect()]
    for run in (*days, days[0]):  # again, also the earlier day after the later one
        jobs.review_enqueue(run)
    assert first[0] and [_messages(run) for run in days] == first
    assert [r.asDict() for r in _read(days[0], "review_enqueue_counts").orderBy("day").collect()] == counts
    ledger = jobs.written_ledger(run)
    assert sorted(r["docid"] for r in ledger.entries().collect()) == sorted(first[0] + first[1])
    ledger.vacuum()
    assert sorted(r["docid"] for r in ledger.entries().collect()) == sorted(first[0] + first[1])
    assert {p.name for p in (tmp_path / "written_ledger").iterdir()} == {"run=2024-01-29", "run=2024-01-30"}


@pytest.mark.parametrize("step", ["review_messages", "review_enqueue_counts", "ledger_rows"])
def test_a_day_that_failed_loses_and_repeats_nothing(spark, warehouse, tmp_path, monkeypatch, step):
    plain = [jobs.Run(spark, warehouse, str(tmp_path / "plain"), datetime(2024, 1, d)) for d in (29, 30)]
    for run in plain:
        jobs.review_enqueue(run)
    days = [jobs.Run(spark, warehouse, str(tmp_path / "out"), datetime(2024, 1, d)) for d in (29, 30)]
    jobs.review_enqueue(days[0])

    def broken(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs.review, step, broken)
        with pytest.raises(OSError):
            jobs.review_enqueue(days[1])
    assert jobs.written_ledger(days[1]).runs() == ["2024-01-29"]
    jobs.review_enqueue(days[1])
    assert [_messages(run) for run in days] == [_messages(run) for run in plain]


def test_attempts_are_whole_and_alone(spark, tmp_path):
    ledger = RunLedger(spark, str(tmp_path / "ledger"), "k long")
    assert ledger.runs() == [] and ledger.entries().count() == 0
    ledger.commit("a", spark.range(3).toDF("k"))
    # What was written but not renamed, and a run without any attempt, do not exist.
    commits.attempt(spark.range(9).toDF("k"), str(tmp_path / "ledger" / "run=a"))
    commits.attempt(spark.range(9).toDF("k"), str(tmp_path / "ledger" / "run=b"))
    assert ledger.runs() == ["a"] and ledger.entries().count() == 3 and ledger.entries("a").count() == 0
    ledger.commit("a", spark.range(2).toDF("k"))
    assert sorted(map(tuple, ledger.entries().collect())) == [(0, "a"), (1, "a")]
    with pytest.raises(commits.PlaceTaken):
        commits.land(spark.range(1).toDF("k"), str(tmp_path / "ledger" / "run=a"), "attempt=2")
    assert ledger.entries().count() == 2
    left = commits.names(spark, str(tmp_path / "ledger" / "run=a"))
    assert sum(n.startswith("_attempt-") for n in left) == 1
    ledger.vacuum()
    assert commits.names(spark, str(tmp_path / "ledger" / "run=a")) == ["attempt=2"]


def test_sampled_and_crawled_rows_are_enqueued(spark, warehouse, tmp_path):
    run = jobs.Run(spark, warehouse, str(tmp_path), datetime(2024, 1, 30))
    jobs.sample(run, users=5, labels="a,b", buckets="x,y")
    assert _read(run, "sample_grid").count() == 3 * len(spark.read.text(run.path("sample")).collect()) > 0
    jobs.crawl_rows(run)
    rows = _read(run, "crawl_rows")
    assert {"day", "arm", "line_no", "width"} <= set(rows.columns)
    jobs.review_enqueue(run)
    crawled = {r["docid"] for r in rows.where("width >= 2").select("docid").collect()}
    messages = [r["key"] for r in _read(run, "review_messages").collect()]
    assert messages and set(messages) <= crawled and len(messages) == len(set(messages))


def test_text_and_json_inputs(spark, warehouse, tmp_path):
    given = tmp_path / "tables"
    for name in ("search_index", "doc_static", "reviews"):
        spark.read.parquet(f"{warehouse}/{name}").write.parquet(str(given / name))
    (given / "timeliness_updates").mkdir()
    lines = ["1\x01old", " 1\x01 new ", "1", "1\x01a\x01b", "nowhere\x01x"]
    (given / "timeliness_updates" / "updates.txt").write_text("\n".join(lines) + "\n")
    run = jobs.Run(spark, str(given), str(tmp_path / "out"), datetime(2024, 1, 30), {
        "timeliness_updates": "text", "crawl_rows": "text", "feed_dump": "json", "doc_meta_json": "json",
    })
    jobs.index_sync(run)
    assert tuple(_read(run, "index_sync_lines").first()) == (5, 2)
    assert jobs.search_index(run).read().where("docid = '1'").first()["timeliness_type"] == "new"
    assert [r["key"] for r in _read(run, "reindex_messages").collect()] == ["nowhere"]

    folder = given / "crawl_rows" / "day=2024-01-30" / "arm=online"
    folder.mkdir(parents=True)
    (folder / "a.txt").write_text("u\tq1\t0\nshort\nu\tq2\t1\nu\tq1\t2\n")
    jobs.review_enqueue(run)
    counts = _read(run, "review_enqueue_counts").first().asDict()
    assert [counts[c] for c in ("succ_num", "exist_num", "dup_num", "skip_num")] == [2, 0, 1, 1]

    dump = {"line_no": 1, "day": "2024-01-30", "uid": "u", "arm": "online",
            "body": json.dumps({"documents": [{"docid": "d", "pos": 1.0, "contextMeta": {}}]})}
    for name, row in (("feed_dump", dump), ("doc_meta_json", {"docid": "d", "body": "{"})):
        (given / name).mkdir()
        (given / name / "x.json").write_text(json.dumps(row) + "\n")
    jobs.crawl_rows(run)
    row = _read(run, "crawl_rows").first()
    assert (row["docid"], row["pos"], row["width"], row["line_no"]) == ("d", "1.0", 5, 1)


def test_command_line_settings():
    assert jobs._pairs(["a=1", "b=x=y"]) == {"a": "1", "b": "x=y"}
    assert [jobs._value(v) for v in ("7", "0.5", "true", "a,b")] == [7, 0.5, True, "a,b"]


def test_staged_tables_can_be_cleared(spark):
    kept = stage(spark.range(3), "cleared")
    (path,) = {f.rsplit("/", 2)[0] for f in kept.inputFiles()}
    from feedloom.staging import clear

    clear(spark)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def test_every_job_has_a_name():
    assert set(jobs.JOBS) >= {"cross_geo", "geo_top_docs", "review_analysis", "index_sync"}
