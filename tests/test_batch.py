from __future__ import annotations

import gzip
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from checks.views import view
from creditweave.jobs import batch
from creditweave.operators import MARTS, clean_applications
from creditweave.operators.rules import RULE_NAMES, count_violations, decision_rules
from creditweave.operators.watch import RuleViolation
from creditweave.plans import CLEAN_TABLE, batch_record, publish_batch, read_output, remove_old_runs, run_batch
from creditweave.plans import batch as plan
from creditweave.schemas import APPLICATION_COLUMNS, CLEAN_APPLICATIONS
from creditweave.session import scratch_dir
from creditweave.sinks import write_mart, write_snapshot, write_table
from creditweave.sources import read_source
from tests.plans import optimized, physical


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files(path):
    return sorted(Path(path).glob("part-*.parquet"))


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return view(spark, sf_dir, "f_applications_raw")


@pytest.fixture(scope="module")
def csv_dir(raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("csv") / "applications")
    raw.repartition(3).write.options(header=True, escape='"').csv(path)
    return path


@pytest.mark.parametrize("keep_in_memory", [False, True])
def test_five_outputs(spark, raw, csv_dir, tmp_path, keep_in_memory):
    paths = run_batch(spark, csv_dir, f"{tmp_path}/out/", keep_in_memory=keep_in_memory)
    assert {Path(p).name for p in paths.values()} == {CLEAN_TABLE, *MARTS} == {p.name for p in (tmp_path / "out").iterdir()}
    clean = clean_applications(raw)
    assert rows(spark.read.parquet(paths[CLEAN_TABLE])) == rows(clean)
    assert spark.read.parquet(paths[CLEAN_TABLE]).schema == CLEAN_APPLICATIONS
    for name, build in MARTS.items():
        stored = [tuple(r) for r in spark.read.parquet(paths[name]).collect()]
        assert stored == [tuple(r) for r in build(clean).collect()], name
        assert len(files(paths[name])) == 1, name
    assert len(files(paths[CLEAN_TABLE])) > 1


def test_second_run_replaces_the_first(spark, csv_dir, tmp_path):
    first = run_batch(spark, csv_dir, str(tmp_path))
    before = {name: rows(spark.read.parquet(p)) for name, p in first.items()}
    second = run_batch(spark, csv_dir, str(tmp_path), max_records_per_file=100)
    assert {name: rows(spark.read.parquet(p)) for name, p in second.items()} == before
    assert max(pq.read_metadata(f).num_rows for f in files(second[CLEAN_TABLE])) <= 100


def test_large_mart_stays_split(spark, tmp_path):
    mart = spark.range(0, 2_000_000, 1, 8).selectExpr("cast(id AS string) AS key", "uuid() AS text").orderBy("key")
    write_mart(mart, str(tmp_path / "mart"))
    assert len(files(tmp_path / "mart")) > 1


def test_csv_columns_come_from_the_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'channel,application_id,note\nweb,"a ""quoted"", id",x\n,b\n" office ","",y,too,many\n', encoding="utf-8"
    )
    frame = read_source(spark, str(tmp_path))
    assert {f.dataType.simpleString() for f in frame.schema} == {"string"}
    assert [tuple(r) for r in frame.select("application_id", "channel", "note").collect()] == [
        ('a "quoted", id', "web", "x"), ("b", None, None), (None, " office ", "y"),
    ]


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="unknown format 'xml'"):
        read_source(spark, "/nowhere", "xml")


def test_marts_scan_only_their_columns(spark, csv_dir, tmp_path):
    paths = run_batch(spark, csv_dir, str(tmp_path))
    stored = spark.read.parquet(paths[CLEAN_TABLE])
    expected = {
        "applications_by_region_status": {"region_code", "decision_status", "customer_id", "requested_amount"},
        "risk_level_metrics": {"risk_level", "credit_score", "requested_amount", "approved_amount"},
        "manual_review_by_channel": {"channel", "employee_review_flag"},
        "daily_processing_metrics": {"event_time", "processing_time_sec", "credit_score"},
    }
    for name, build in MARTS.items():
        plan = physical(build(stored))
        scanned = plan.split("ReadSchema: struct<")[1].split(">")[0]
        assert {part.split(":")[0] for part in scanned.split(",")} == expected[name]
        assert "partial_count(1)" in plan and "Python" not in plan


def test_cleaning_is_one_narrow_stage_that_parses_once(spark, raw, tmp_path):
    write_table(raw, str(tmp_path / "raw"))
    clean = clean_applications(read_source(spark, str(tmp_path / "raw"), "parquet"))
    plan = physical(clean)
    assert "Exchange" not in plan and "Python" not in plan
    assert "IsNotNull(application_id)" in plan
    # one short test of the text per integer column and use
    assert optimized(clean).count("RLIKE(requested_amount") == 2
    narrow = physical(clean.groupBy("channel").count())
    assert "product_type" not in narrow and "term_months" not in narrow


def test_snapshot_is_snappy_in_large_row_groups(spark, tmp_path):
    write_snapshot(spark.range(0, 300_000, 1, 1), str(tmp_path / "snap"))
    meta = pq.read_metadata(files(tmp_path / "snap")[0])
    assert meta.num_row_groups == 1
    assert meta.row_group(0).column(0).compression == "SNAPPY"


def test_job_arguments():
    args = batch.parse_args(["--input", "in", "--output", "out"])
    assert (args.input, args.output, args.format, args.keep_in_memory) == ("in", "out", "csv", False)
    assert batch.parse_args(["--input", "i", "--output", "o", "--format", "parquet"]).format == "parquet"
    paths = ["--input", "i", "--output", "o"]
    assert batch.parse_args([*paths, "--versioned", "--max-violations", "decision_fits_score=7"]).limits == {"decision_fits_score": 7}
    assert RULE_NAMES == tuple(decision_rules())
    wrong = (["--versioned", "--run-id", "r"], ["--max-violations", "decision_fits_score=7"], ["--versioned", "--max-violations", "x=1"], ["--versioned", "--max-violations", "x"])
    for bad in (["--input", "in"], [*paths, "--format", "orc"], *([*paths, *w] for w in wrong)):
        with pytest.raises(SystemExit):
            batch.parse_args(bad)


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(shared) and first != second


class Unset:
    """A session whose settings are only those given."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, name, default=None):
        return self.settings.get(name, default)


def test_scratch_without_a_shared_folder():
    local = scratch_dir(Unset(**{"spark.master": "local[4]"}), "x")
    assert Path(local).parent.is_dir() and not Path(local).exists()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Unset(**{"spark.master": "yarn"}), "x")


def test_columns_of_the_contract():
    assert len(APPLICATION_COLUMNS) == 14


@pytest.fixture
def mixed(tmp_path):
    """Files in three column orders, one compressed, one with a mark and blank lines, one empty, one that is no data."""
    root = tmp_path / "in"
    root.mkdir()
    (root / "a.csv").write_text('region_code,channel\nR1,web\n"R,2",\n', encoding="utf-8")
    (root / "b.csv").write_text("\ufeff\n\nchannel,region_code\napp,R3\n", encoding="utf-8")
    with gzip.open(root / "c.csv.gz", "wt") as out:
        out.write('"no""te",Channel\nn1,shop\n')
    (root / "d.csv").write_text("")
    (root / "_e.csv").write_text("other\n1\n")
    return str(root)


def test_headers_that_differ(spark, mixed):
    table = read_source(spark, mixed, "csv")
    assert table.columns == ["region_code", "channel", 'no"te']
    want = [("R1", "web", None), ("R,2", None, None), ("R3", "app", None), (None, "shop", "n1")]
    assert rows(table) == sorted(want, key=repr)
    assert sorted(r[0] or "" for r in table.select("channel").collect()) == ["", "app", "shop", "web"]


def test_headers_that_differ_under_a_schema(spark, mixed):
    table = read_source(spark, mixed, "csv", "channel string, amount int, region_code string")
    assert table.schema.simpleString() == "struct<channel:string,amount:int,region_code:string>"
    assert rows(table) == sorted([("web", None, "R1"), (None, None, "R,2"), ("app", None, "R3"), ("shop", None, None)], key=repr)


def test_one_header_is_one_scan(spark, csv_dir, raw):
    assert physical(read_source(spark, csv_dir, "csv")).count("FileScan csv") == 1
    typed = read_source(spark, csv_dir, "csv", "credit_score int, application_id string")
    assert typed.columns == ["credit_score", "application_id"] and typed.filter("credit_score between 300 and 400").count() > 0


def test_headers_that_cannot_be_matched(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("x,X\n1,2\n")
    with pytest.raises(ValueError, match="b.csv has a column twice"):
        read_source(spark, str(tmp_path))
    (tmp_path / "b.csv").write_text("z" * (1 << 20) + "\n")
    with pytest.raises(ValueError, match="more than 1048576 bytes"):
        read_source(spark, str(tmp_path))


def test_headers_that_differ_are_refused_on_demand(spark, tmp_path):
    """Columns in another order in one file of a directory would end up under wrong names."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("region_code,channel\nR,web\n")
    (tmp_path / "in" / "b.csv").write_text("channel,region_code\nweb,R\n")
    table = read_source(spark, str(tmp_path / "in"), "csv", same_header=True)
    for frame in (table, table.select("channel")):
        with pytest.raises(Exception, match="(?i)header"):
            frame.collect()


def outputs(spark, root, version=None):
    return {name: rows(read_output(spark, root, name, version)) for name in (CLEAN_TABLE, *MARTS)}


def test_versions_of_the_outputs(spark, csv_dir, raw, tmp_path):
    root = str(tmp_path / "out")
    assert publish_batch(spark, csv_dir, root) == 1
    first = outputs(spark, root)
    half = str(tmp_path / "half")
    raw.filter("region_code < 'B'").write.options(header=True, escape='"').csv(half)
    assert publish_batch(spark, half, root, keep_in_memory=True) == 2
    second = outputs(spark, root)
    assert second != first and outputs(spark, root, 1) == first
    record = batch_record(spark, root)
    clean = clean_applications(read_source(spark, half))
    assert record["rows"] == clean.count() == len(second[CLEAN_TABLE])
    assert record["violations"] == {r.rule: r.violations for r in count_violations(clean).collect()}
    assert publish_batch(spark, csv_dir, root) == 3
    assert remove_old_runs(spark, root, keep=1) == [1, 2] and outputs(spark, root) == first
    assert len(list((tmp_path / "out" / "runs").iterdir())) == 1


@pytest.mark.parametrize("at", [CLEAN_TABLE, *MARTS])
def test_a_run_that_stops_midway_leaves_the_old_version(spark, csv_dir, tmp_path, monkeypatch, at):
    root = str(tmp_path / "out")
    publish_batch(spark, csv_dir, root)
    before = outputs(spark, root)

    def broken(write):
        def run(df, path, *rest):
            if path.endswith(at):
                raise OSError("disk full")
            write(df, path, *rest)

        return run

    monkeypatch.setattr(plan, "write_table", broken(write_table))
    monkeypatch.setattr(plan, "write_mart", broken(write_mart))
    with pytest.raises(OSError, match="disk full"):
        publish_batch(spark, csv_dir, root)
    assert outputs(spark, root) == before and len(list((tmp_path / "out" / "runs").iterdir())) == 1


def test_broken_rules_stop_the_run_before_the_marts(spark, csv_dir, tmp_path, monkeypatch):
    root, made = str(tmp_path / "out"), []
    monkeypatch.setattr(plan, "write_mart", lambda mart, path: made.append(path))
    with pytest.raises(RuleViolation, match="manual_is_flagged") as refused:
        publish_batch(spark, csv_dir, root, limits={"manual_is_flagged": 1})
    assert not made and refused.value.counts["manual_is_flagged"] > 1
    with pytest.raises(ValueError, match="no version yet"):
        batch_record(spark, root)


def test_rules_are_counted_on_the_way_to_the_files(spark, csv_dir):
    watched = plan._Watch(None).over(clean_applications(read_source(spark, csv_dir)))
    assert physical(watched).count("FileScan csv") == 1 and "CollectMetrics" in physical(watched) and "Exchange" not in physical(watched)


def test_main_of_the_job(spark, csv_dir, tmp_path, monkeypatch):
    class Kept:
        """The test's session, which the job must not stop for the other tests."""

        def __getattr__(self, name):
            return (lambda: None) if name == "stop" else getattr(spark, name)

    monkeypatch.setattr(batch, "build_session", lambda name: Kept())
    monkeypatch.setattr(batch, "run_batch", lambda session, *rest: run_batch(spark, *rest))
    batch.main(["--input", csv_dir, "--output", str(tmp_path / "out"), "--run-id", "r1"])
    assert {p.name for p in (tmp_path / "out" / "r1").iterdir()} == {CLEAN_TABLE, *MARTS}
    monkeypatch.setattr(batch, "publish_batch", lambda session, *rest: publish_batch(spark, *rest))
    batch.main(["--input", csv_dir, "--output", str(tmp_path / "v"), "--versioned", "--max-violations", "manual_is_flagged=100000"])
    assert batch_record(spark, str(tmp_path / "v"))["rows"] > 0


def test_marts_are_one_file_whatever_the_session_says(spark, csv_dir, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        paths = run_batch(spark, csv_dir, str(tmp_path))
        assert all(len(files(paths[name])) == 1 for name in MARTS)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
