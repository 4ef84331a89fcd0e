import pytest
from pyspark.sql import functions as F

from stayline import operators as op
from stayline.session import durable, shared_dir
from stayline.sources import (
    EVENT_SCHEMA,
    corrupt_lines,
    map_columns,
    preview,
    read_events,
    require_columns,
    schema_report,
    write_table,
)


def same(a, b):
    return a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def test_json_round_trip(spark, raw, tmp_path):
    path = str(tmp_path / "json")
    write_table(raw, path, "json")
    assert same(read_events(spark, path), raw)


def test_inferred_schema_reads_the_same_values(spark, raw, tmp_path):
    path = str(tmp_path / "json")
    write_table(raw, path, "json")
    inferred = read_events(spark, path, schema=None)
    assert same(inferred.select(*EVENT_SCHEMA.fieldNames()), raw)


def test_malformed_lines(spark, tmp_path):
    """A line cut off is lost, one with an ill-typed field keeps the rest; both are counted."""
    file = tmp_path / "log.json"
    whole = '{"userId": "1", "sessionId": 2, "page": "Home", "ts": 3}'
    file.write_text(f'{whole}\n{{"userId": \n{whole.replace("3", chr(34) + "abc" + chr(34))}\n')
    log = read_events(spark, str(file))
    assert log.count() == 3 and log.where("userId IS NULL").count() == 1
    kept = read_events(spark, str(file), keep_corrupt=True)
    assert kept.where("_corrupt_record IS NOT NULL").count() == 2
    audit = op.quality_audit(kept).first()
    assert (audit.n_rows, audit.n_corrupt, audit.n_kept) == (3, 2, 2)
    assert op.drop_invalid(kept).count() == 2
    assert op.drop_invalid(kept, drop_corrupt=True).select("ts").collect() == [(3,)]


def test_corrupt_lines_are_found(spark, tmp_path):
    """File and line of each, whatever blocks the files are cut into; blank lines count as lines."""
    want = set()
    for k in range(3):
        lines = []
        for i in range(1, 400):
            if i % (37 + k) == 0:
                lines.append(f'{{"userId": "{k}-{i}')
                want.add((f"log-{k}.json", i, lines[-1]))
            else:
                lines.append("" if i % 50 == 3 else f'{{"userId": "{i}", "sessionId": 1, "ts": {i}}}')
        (tmp_path / f"log-{k}.json").write_text("\n".join(lines) + "\n")
    (tmp_path / "log-empty.json").write_text("")
    for size in ("128m", "2k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            rows = corrupt_lines(spark, str(tmp_path)).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert len(rows) == len(want)
        assert {(r.file.rsplit("/", 1)[1], r.line, r.record) for r in rows} == want
    log = read_events(spark, str(tmp_path), keep_corrupt=True, keep_file=True)
    audit = op.quality_audit(log, by=["file"]).collect()
    assert {r.file.rsplit("/", 1)[1]: r.n_corrupt for r in audit} == {
        f"log-{k}.json": sum(f == f"log-{k}.json" for f, _, _ in want) for k in range(3)
    }


def test_file_of_each_row(spark, raw, tmp_path):
    for fmt in ("json", "parquet"):
        write_table(raw, str(tmp_path / fmt), fmt)
        log = read_events(spark, str(tmp_path / fmt), fmt, keep_file=True)
        assert log.columns == [*EVENT_SCHEMA.fieldNames(), "file"]
        assert log.where(F.col("file").contains(f"/{fmt}/")).count() == raw.count()


def test_mapped_json_needs_a_schema_and_keeps_it(spark, raw, tmp_path):
    path = str(tmp_path / "json")
    write_table(raw.withColumnRenamed("userId", "uid"), path, "json")
    mapping = {c: c for c in EVENT_SCHEMA.fieldNames()} | {"userId": "uid"}
    with pytest.raises(ValueError, match="schema"):
        read_events(spark, path, mapping=mapping)
    names = [f.simpleString() for f in EVENT_SCHEMA if f.name != "userId"]
    schema = "uid string, absent string, " + ", ".join(n.replace(":", " ") for n in names)
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup(None))
    mapped = read_events(spark, path, schema=schema, mapping=mapping | {"page": "coalesce(absent, page)"})
    assert len(jobs.getJobIdsForGroup(None)) == before  # nothing was inferred
    assert same(mapped, raw)
    assert same(read_events(spark, path, schema=None, mapping=mapping), raw)


def test_parquet_round_trip_and_mapping(spark, raw, tmp_path):
    path = str(tmp_path / "parquet")
    write_table(raw.withColumnRenamed("userId", "uid"), path)
    mapping = {c: c for c in EVENT_SCHEMA.fieldNames()} | {"userId": "uid"}
    assert same(read_events(spark, path, "parquet", mapping=mapping), raw)
    with pytest.raises(ValueError, match="uid"):
        map_columns(raw, {"uid": "userId"})


def test_require_columns(raw):
    assert require_columns(raw, EVENT_SCHEMA) is raw
    assert require_columns(raw, ["userId"]) is raw
    with pytest.raises(ValueError, match="page: missing"):
        require_columns(raw.drop("page"), EVENT_SCHEMA)
    with pytest.raises(ValueError, match="ts: string instead of bigint"):
        require_columns(raw.withColumn("ts", F.col("ts").cast("string")), EVENT_SCHEMA)


def test_schema_report(raw):
    report = {r.column: r for r in schema_report(raw).collect()}
    assert report["userId"].type == "string" and report["userId"].n_null == 1
    assert report["ts"].n_rows == 24 and report["ts"].n_null == 0
    assert report["status"].n_null == 1 and report["level"].position == 6


def test_preview_is_in_order(raw):
    assert [r.ts for r in preview(raw, 3, ["ts", "userId"]).collect()] == sorted(
        r.ts for r in raw.collect()
    )[:3]


def test_durable_tables_lie_in_the_shared_folder(spark, facts):
    stored = durable(facts)
    assert same(stored, facts)
    assert stored.schema == facts.schema
    assert shared_dir(spark) in stored.inputFiles()[0] or shared_dir(spark).split(":")[-1] in (
        stored.inputFiles()[0]
    )
