"""Readers, sinks, upserts and streams."""

import json

import pytest
from pyspark.sql import functions as F

from reviewmill import schemas, session
from reviewmill.operators import corpus, models, scoring, tenancy
from reviewmill.plans import jobs as batch_jobs
from reviewmill.sources import readers, sinks, upserts
from reviewmill.streaming import jobs


def test_corpus_columns_are_read_by_name(spark, tmp_path):
    path = str(tmp_path / "c.json")
    with open(path, "w") as f:
        f.write(json.dumps({"label": 1, "title": "T", "review": "R"}) + "\n")
    row = readers.read_corpus(spark, path, "json").first()
    assert (row.label, row.title, row.review) == (1.0, "T", "R")


def test_upload_roles(spark, tmp_path):
    assert readers.column_roles(["ID", "Body", "TEXT", "Stars", "Summary"]) == {"text": "Body", "rating": "Stars", "title": "Summary"}
    assert readers.column_roles(["x"]) == {"text": None, "rating": None, "title": None}
    path = tmp_path / "u.csv"
    path.write_text('Headline,Comment,Score\nhi,"two, lines",5\nho,,x\n')
    df = readers.read_upload(spark, str(path))
    prof = readers.upload_profile(df).first()
    assert (prof.row_count, prof.valid_rows, prof.invalid_rows, prof.detected_text_column) == (2, 1, 1, "Comment")
    assert [tuple(r) for r in readers.by_role(df).collect()] == [("hi", "two, lines", 5), ("ho", None, None)]
    assert [tuple(r) for r in readers.preview(df).collect()] == [("hi", "two, lines", "5"), ("ho", "", "x")]
    nothing = readers.upload_profile(df.select(F.col("Score").alias("n"))).first()
    assert (nothing.valid_rows, nothing.invalid_rows, nothing.has_review_column) == (0, 2, False)


def test_upload_keeps_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "u.csv"
    path.write_text('Headline,Comment,Score\nhi,"first line\nsecond, line\n\nthird",5\nho,,2\n')
    df = readers.read_upload(spark, str(path))
    prof = readers.upload_profile(df).first()
    assert (prof.row_count, prof.valid_rows, prof.invalid_rows) == (2, 1, 1)
    assert [tuple(r) for r in readers.by_role(df).collect()] == [("hi", "first line\nsecond, line\n\nthird", 5), ("ho", None, 2)]


def test_import_text_falls_through_empty_fields(spark):
    raw = spark.createDataFrame([(None, "", "", "c", None), ("t", "a", "b", None, 2), (None, "", None, None, 3), (None, "x", None, None, 0)],
                                schemas.IMPORT_RECORD)
    assert [tuple(r) for r in readers.import_records(raw).collect()] == [("", "c", 4), ("t", "a", 2), ("", "x", 4)]


def test_jdbc_reader_is_lazy_about_options(spark):
    with pytest.raises(Exception):
        readers.read_jdbc(spark, "jdbc:none:", "t", "id", 0, 10, 2)


def test_enum_check(spark):
    df = spark.createDataFrame([("owner",), ("boss",), (None,)], "role string")
    assert readers.check_enums(df, "organization_members").count() == 2


def test_review_rows_fill_defaults_and_repeatable_ids(spark):
    df = spark.createDataFrame([("o", "p", "good", None, 0.0, "")],
                               "organization_id string, product_id string, content string, sentiment string, sentiment_score double, id string")
    a, b = (sinks.review_rows(df, ["product_id", "content"]).first() for _ in range(2))
    assert (a.title, a.sentiment, a.sentiment_score, a.rating) == ("", "POSITIVE", 0.95, None)
    assert a.id == b.id and len(a.id) == 64


TABLE = "id bigint, name string, created_at bigint, updated_at bigint"


def test_upsert_is_idempotent_and_keeps_creation(spark, tmp_path):
    path = str(tmp_path / "t")
    upserts.upsert(spark.createDataFrame([(i, f"v{i}", 1, 1) for i in range(40)] + [(None, "nobody", 1, 1)], TABLE), path, ["id"], 1)
    update = spark.createDataFrame([(3, "new", 9, 9), (3, "old", 5, 5), (99, "add", 9, 9), (4, "stale", 0, 0), (5, "a", 2, 2), (5, "b", 2, 2),
                                    (None, "somebody", 2, 2)], TABLE)
    for buckets in (None, None, 4, 4, 7):
        upserts.upsert(update, path, ["id"], 2)
        if buckets:
            upserts.compact(spark, path, tie="name", buckets=buckets)
        rows = {r.id: tuple(r)[1:] for r in upserts.read_upserted(spark, path, tie="name").collect()}
        assert len(rows) == 42
        assert rows[3] == ("new", 1, 9) and rows[99] == ("add", 9, 9) and rows[5][0] == "b" and rows[None] == ("somebody", 1, 2)
        assert rows[4] == ("v4", 0, 1)  # an older version never replaces a newer one
        for key in (3, 4, 99, None):
            assert [tuple(r)[1:] for r in upserts.read_key(spark, path, {"id": key}, tie="name").collect()] == [rows[key]]
        assert upserts.read_key(spark, path, {"id": 1000}, tie="name").count() == 0
    assert {f.name for f in (tmp_path / "t").iterdir()} == {"generation=2", "generation=3"}


def test_wanted_columns_alone_are_read_and_moved(spark, tmp_path):
    path = str(tmp_path / "t")
    upserts.upsert(spark.createDataFrame([(i, f"v{i}", 1, 1) for i in range(9)] + [(None, "nobody", 1, 1)], TABLE), path, ["id"], 1)
    upserts.upsert(spark.createDataFrame([(3, "new", 9, 9), (4, "stale", 0, 0)], TABLE), path, ["id"], 2)
    for _ in range(2):
        whole = upserts.read_upserted(spark, path)
        few = upserts.read_upserted(spark, path, created=None, columns=["id"])
        assert sorted(few.collect(), key=str) == sorted(whole.select("id").collect(), key=str) and few.columns == ["id"]
        assert "name" not in few._jdf.queryExecution().executedPlan().toString()
        assert {r.id: (r.name, r.created_at) for r in whole.collect()}[4] == ("v4", 0)
        upserts.compact(spark, path)


def test_stored_versions_have_an_entropy_coding_codec(spark, tmp_path):
    """Half of the letters of a digest are no information; Snappy leaves them in."""
    path = str(tmp_path / "t")
    upserts.upsert(spark.range(20_000).selectExpr("id", "'a' as name", "id as created_at", "1L as updated_at").coalesce(1), path, ["id"], 1)
    size = sum(f.stat().st_size for f in (tmp_path / "t").rglob("*.parquet"))
    bloom = 1 << 20  # of fixed size
    assert size - bloom < 20_000 * 50


def test_gate_filters_ahead_of_its_join(spark):
    """Rows of writers who may not pass are not exchanged; what passes is what the plain gate lets pass."""
    rows = spark.range(3000).selectExpr("id", "if(id % 7 = 0, null, id % 500) AS user_id", "concat('S', id % 3) AS organization_id", "'x' AS `a.b`")
    members = spark.createDataFrame([(n, f"S{n % 3}", "owner") for n in range(0, 500, 25)] * 2 + [(3, "S0", "viewer"), (None, "S1", "owner")],
                                    "user_id long, organization_id string, role string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        passed, refused = tenancy.write_gate(rows, members, bitmaps=4)
        columns = tenancy.write_gate(rows, members)[0].columns
        plan = passed._jdf.queryExecution().optimizedPlan().toString()
        want, rest = (sorted(map(str, df.collect())) for df in tenancy.write_gate(rows, members))
        assert (sorted(map(str, passed.collect())), sorted(map(str, refused.collect()))) == (want, rest) and len(want) > 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert passed.columns == columns and plan.index("bitmap") > plan.index("Join Inner, (")


def test_upsert_writes_only_its_own_rows(spark, tmp_path):
    path = tmp_path / "t"
    upserts.upsert(spark.createDataFrame([(i, "a", 1, 1) for i in range(50)], TABLE), str(path), ["id"], 1)
    before = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    upserts.upsert(spark.createDataFrame([(7, "b", 2, 2)], TABLE), str(path), ["id"], 2)
    after = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    assert all(after[f] == before[f] for f in before)
    assert sum(spark.read.parquet(str(f)).count() for f in after.keys() - before.keys()) == 1


def test_interrupted_writes_change_nothing(spark, tmp_path):
    path, root = str(tmp_path / "t"), tmp_path / "t"
    upserts.upsert(spark.createDataFrame([(1, "a", 1, 1)], TABLE), path, ["id"], 1)
    read = lambda: [r.name for r in upserts.read_upserted(spark, path).collect()]
    (root / "generation=1" / "buckets=4").mkdir(parents=True)  # a compaction without success mark
    (root / "generation=0" / "batch=9").mkdir()  # a batch without one
    assert read() == ["a"]
    upserts.compact(spark, path, buckets=2)
    assert read() == ["a"] and (root / "generation=0" / "batch=1").exists()
    upserts.upsert(spark.createDataFrame([(1, "b", 2, 2)], TABLE), path, ["id"], 2)
    (root / "generation=2" / "buckets=2").mkdir(parents=True)
    assert read() == ["b"]
    upserts.compact(spark, path)
    assert read() == ["b"] and not (root / "generation=0").exists()


def test_stored_rows_are_not_exchanged_and_a_key_opens_one_bucket(spark, tmp_path):
    path = str(tmp_path / "t")
    upserts.upsert(spark.range(2000).selectExpr("id", "'a' as name", "id as created_at", "1L as updated_at"), path, ["id"], 1)
    upserts.compact(spark, path, buckets=16)
    upserts.upsert(spark.createDataFrame([(7, "b", 2, 2)], TABLE), path, ["id"], 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole = upserts.read_upserted(spark, path)._jdf.queryExecution().executedPlan().toString()
        key = upserts.read_key(spark, path, {"id": 7})._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    base = next(line for line in whole.splitlines() if "Bucketed: true" in line)
    above = whole.splitlines()[:whole.splitlines().index(base)]
    depth = len(base) - len(base.lstrip(" :+-"))
    parents, at = [], depth
    for line in reversed(above):  # the lines that lead from the base up to the root
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < at:
            parents.append(line)
            at = indent
    assert parents and not any("Exchange" in line for line in parents)
    assert "SelectedBucketsCount: 1 out of 16" in key


def test_ids_differ_for_different_keys(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a", None), (None, "a"), ("", "a"), (None, None)], "x string, y string")
    assert df.select(sinks.new_id("x", "y").alias("i")).distinct().count() == 6


def test_section_replacement(spark, tmp_path):
    root = str(tmp_path / "r")
    for section, value in (("a", 1), ("b", 2), ("a", 3)):
        sinks.write_section(spark.createDataFrame([(value,)], "v int"), root, section)
    assert [sinks.read_section(spark, root, s, "v int").first().v for s in "ab"] == [3, 2]


def test_text_and_csv(spark, tmp_path):
    df = spark.createDataFrame([("best model", 1)], "name string, n int")
    sinks.write_text(df, "name", str(tmp_path / "n"))
    assert sinks.read_text(spark, str(tmp_path / "n")).first().value == "best model"
    sinks.write_csv(df.union(df), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2


def test_audit_details_are_json(spark):
    df = spark.createDataFrame([("o", 1, 5)], "organization_id string, user_id bigint, total int")
    row = sinks.audit_rows(df, "RUN_ANALYSIS", "ANALYSIS", ["total"], ["user_id"]).first()
    assert json.loads(row.details) == {"total": 5}


def test_duplicates_keep_the_lowest_key(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (4, " "), (5, None)], "doc_id int, review string")
    assert sorted(r.doc_id for r in corpus.prepare(df).collect()) == [1, 2]
    report = corpus.cleaning_report(df).first()
    assert (report.rows_before, report.rows_after, report.rows_removed) == (5, 2, 3)


def test_import_and_analyse_can_be_repeated(spark, tmp_path):
    raw = spark.createDataFrame(
        [("1", 7, "A", "p", "t", "battery is great", None, None, 5), ("2", 7, "A", "p", None, "", "stopped working", None, 1),
         ("3", 8, "A", "p", None, "not allowed", None, None, 1)],
        "id string, user_id bigint, organization_id string, product_id string, title string, content string, review string, text string, rating int")
    members = spark.createDataFrame([(7, "A", "analyst"), (8, "A", "viewer")], "user_id bigint, organization_id string, role string")
    for _ in range(2):
        out = batch_jobs.import_and_analyse(raw, members, str(tmp_path), "d1")
        assert {r.id for r in out["reviews"].collect()} == {"1", "2"}
        assert [r.aspect for r in out["aspect_results"].collect()] == ["Battery"]
        assert [(r.phrase, r.frequency) for r in out["issue_results"].collect()] == [("stopped working", 1)]
        assert out["analyses"].first().health_score == 50


# --- streams ------------------------------------------------------------------------------

EVENTS = "id string, organization_id string, user_id bigint, sentiment string, review_date timestamp"


def event_files(spark, path, *batches):
    """One file per batch; the file source takes them in order of their names' write times."""
    import time

    for rows in batches:
        df = spark.createDataFrame(rows, "id string, organization_id string, user_id bigint, sentiment string, d string")
        df.withColumn("review_date", F.to_timestamp("d")).drop("d").coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    return jobs.read_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)


def test_running_kpis_equal_batch_and_drop_late_rows(spark, tmp_path):
    stream = event_files(
        spark, str(tmp_path / "in"),
        [("1", "A", 1, "POSITIVE", "2024-01-02"), ("2", "A", 1, "NEGATIVE", "2024-01-03")],
        [("3", "A", 1, "POSITIVE", "2024-03-20"), ("4", "B", 1, "POSITIVE", "2024-01-04")],
        [("6", "A", 1, "NEGATIVE", "2024-03-21")],  # Spark applies a watermark to late rows one batch after it rises
        [("5", "A", 1, "POSITIVE", "2024-01-05")],  # too late
    )
    out = str(tmp_path / "out")
    jobs.kpi_stream(stream, out, str(tmp_path / "cp"), watermark="10 days", window="10 days").awaitTermination()
    got = {(str(r.window_start)[:10], r.organization_id): (r.reviews, r.positives) for r in jobs.read_kpis(spark, out).collect()}
    assert sum(n for n, _ in got.values()) == 5
    assert sorted(got.values()) == [(1, 1), (2, 1), (2, 1)]


def test_score_stream_deals_out_the_reviews_of_one_row_group(spark, tmp_path):
    rows = [(str(n), text) for n, text in enumerate(["great charger, love it", "broken, useless", "It wasn't cheap", "", None, "lot 7"] * 20)]
    train = spark.createDataFrame([("good fine nice", 1.0), ("bad poor slow", 0.0)] * 4, "clean_text string, label double")
    model = models.fit(train, models.logistic_regression(maxIter=3), dims=64, min_df=1.0)
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, "id string, content string").coalesce(1).write.parquet(path)
    counts = {}
    for tasks in (None, 4):
        out = str(tmp_path / f"out-{tasks}")
        stream = jobs.read_stream(spark, path, spark.read.parquet(path).schema)
        jobs.score_stream(stream, model, out, str(tmp_path / f"cp-{tasks}"), tasks=tasks).awaitTermination()
        scored = spark.read.parquet(out)
        assert sorted(map(str, scored.collect())) == sorted(map(str, scoring.predict(spark.read.parquet(path), model, "content", ["id"]).collect()))
        counts[tasks] = scored.groupBy(F.input_file_name()).count().count()
    assert counts == {None: 1, 4: 4}


def test_import_stream_keeps_the_last_version(spark, tmp_path):
    members = spark.createDataFrame([(1, "A", "owner"), (2, "A", "viewer")], "user_id bigint, organization_id string, role string")
    stream = event_files(
        spark, str(tmp_path / "in"),
        [("1", "A", 1, "POSITIVE", "2024-01-02"), ("1", "A", 1, "POSITIVE", "2024-01-02"), ("2", "A", 2, "POSITIVE", "2024-01-02")],
        [("1", "A", 1, "NEGATIVE", "2024-01-03"), ("3", "A", 1, "NEGATIVE", "2024-01-03"), ("4", "B", 1, "NEGATIVE", "2024-01-03")],
        [("1", "A", 1, "STALE", "2023-01-03"), ("5", "A", 1, "POSITIVE", "2020-01-01")],  # years late
    )
    out = str(tmp_path / "out")
    jobs.import_stream(stream, members, out, str(tmp_path / "cp")).awaitTermination()
    rows = {r.id: r.sentiment for r in upserts.read_upserted(spark, out, "review_date", None).collect()}
    assert rows == {"1": "NEGATIVE", "3": "NEGATIVE", "5": "POSITIVE"}


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
    assert not hasattr(session, "localCheckpoint")


def test_shared_folder_is_never_local_on_a_cluster():
    class Stub:
        def __init__(self, master):
            self.conf = {"spark.sql.warehouse.dir": "/shared/warehouse"}
            self.sparkContext = type("C", (), {"master": master, "applicationId": f"app-{master}"})()

    assert session.shared_folder(Stub("local[2]")) == "/shared/warehouse/scratch-app-local[2]"
    with pytest.raises(RuntimeError):
        session.shared_folder(Stub("yarn"))


def test_scope_deletes_its_tables(spark):
    import os

    with session.scratch_scope(spark):
        outer = session.publish(spark.range(3), "outer").inputFiles()
        with session.scratch_scope(spark):
            inner = session.publish(spark.range(3), "inner").inputFiles()
        paths = [f.removeprefix("file://") for f in (*outer, *inner)]
        assert [os.path.exists(p) for p in paths] == [True] * len(outer) + [False] * len(inner)
    assert not any(os.path.exists(p) for p in paths)
