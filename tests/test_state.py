"""State log, source lock, selections, and phase 1 run twice."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollcall import settings as S
from rollcall.functions import payload
from rollcall.functions.ids import moment
from rollcall.operators.lookup import look_up
from rollcall.plans import submit, transitions
from rollcall.sources import catalog, fingerprint, roster, statelog

T0 = dt.datetime(2024, 1, 1)
HOUR = dt.timedelta(hours=1)
DOC, FILE = "https://docs.google.com/document/d/", "https://drive.google.com/file/d/"


def make_roster(spark):
    links = [
        (DOC + "D1/edit", "v"), (FILE + "F1/view", "v"), ("Sin dato", "v"), ("https://example.com", "v"),
        (FILE + "MOVIE/view", "v"), (FILE + "GONE/view", "v"), (FILE + "ODD/view", "v"),
        ("https://drive.google.com/drive/folders/EMPTY", "v"), (DOC + "LOCKED/edit", "v"),
    ]
    rows = [
        (i, f"{i}", "s", "d", "di", "Té Á", "Co", None, None, "", "x", v, t) for i, (t, v) in enumerate(links, 1)
    ]
    columns = ["row_position long", *[f"{c} string" for c in S.ROSTER_COLUMNS]]
    return spark.createDataFrame(rows, ", ".join(columns))


def make_assets(spark):
    files = [
        ("F1", None, "n", S.PLAIN_TEXT, False, 0), ("MOVIE", None, "n", S.MP4, False, 0),
        ("ODD", None, "n", "application/pdf", False, 0), ("c", "EMPTY", "n", S.MP4, False, 0),
    ]
    listed = spark.createDataFrame(
        files, "file_id string, folder_id string, name string, mime string, trashed boolean, list_order long"
    )
    content = spark.createDataFrame([("D1", 1), ("F1", 2), ("MOVIE", 3), ("ODD", 4)], "file_id string, content_id long")
    return catalog.usable_assets(listed, content)


def run_phase_1(spark, log, now, *, accept=True, post=True, prefix=S.EVENT_ID_PREFIX):
    """One whole submission run; returns the events that were put in the outbox."""
    rows = submit.with_event_id(make_roster(spark), prefix)
    batch = log.next_batch("submit")
    log.append(submit.new_images(rows, log.current(), now), "submit", batch)
    gated = submit.gate(rows, log.current(), make_assets(spark))
    box = submit.outbox(gated, now, payload.secret_pads(spark, "k"), bucket="b", blob_prefix="/p/")
    events = sorted(r["event_id"] for r in box.collect())
    log.append(submit.gated_images(gated, log.current(), now), "submit", batch + 1)
    results = box.select(
        "event_id", F.lit(True).alias("published"), F.lit(None).cast("string").alias("publish_error"),
        F.lit(202 if accept else 500).alias("status"), F.lit("m").alias("message_id"),
        F.lit("no" * 400).alias("body"), moment(now).alias("sent_at"),
    )
    log.append(submit.apply_submissions(log.current(), box, results, now, post=post), "submit", batch + 2)
    return events


def states(log):
    return {r["event_id"]: (r["state"], r["attempts"]) for r in log.current().collect()}


def test_phase_1_then_again(spark, folder):
    log = statelog.StateLog(spark, folder)
    assert run_phase_1(spark, log, T0) == ["studio-row-1", "studio-row-2"]
    first = {
        "studio-row-1": ("submitted", 0), "studio-row-2": ("submitted", 0),
        "studio-row-3": ("skipped_no_link", 0), "studio-row-4": ("skipped_unsupported_format", 0),
        "studio-row-5": ("skipped_no_transcript", 0), "studio-row-6": ("failed_drive_read", 1),
        "studio-row-7": ("failed_drive_read", 1), "studio-row-8": ("skipped_no_transcript_in_folder", 0),
        "studio-row-9": ("failed_drive_read", 1),
    }
    assert states(log) == first
    images = {r["event_id"]: r for r in log.current().collect()}
    assert images["studio-row-2"]["transcript_gcs_uri"] == "gs://b/p/studio-row-2/transcript.txt"
    assert images["studio-row-1"]["webhook_submitted_at"] == T0
    assert images["studio-row-3"]["drive_case"] is None and images["studio-row-6"]["drive_case"] == "B"
    assert images["studio-row-4"]["last_error"] == "[F_other] transcript no soportado: https://example.com"
    assert images["studio-row-7"]["last_error"] == "Unsupported mime for transcript: application/pdf (file ODD)"

    # Again: nothing is sent twice, nothing new is registered, read failures count.
    assert run_phase_1(spark, log, T0 + HOUR) == []
    second = {e: (s, a + (s == "failed_drive_read")) for e, (s, a) in first.items()}
    assert states(log) == second


def test_a_new_prefix_makes_new_events(spark, folder):
    log = statelog.StateLog(spark, folder)
    run_phase_1(spark, log, T0)
    assert run_phase_1(spark, log, T0 + HOUR, prefix="second") == ["second-1", "second-2"]
    found = states(log)
    assert len(found) == 18 and found["second-1"] == found["studio-row-1"] == ("submitted", 0)


def test_rejections_and_upload_only(spark, folder):
    log = statelog.StateLog(spark, f"{folder}/a")
    run_phase_1(spark, log, T0, accept=False)
    row = log.current().where("event_id = 'studio-row-1'").first()
    assert (row["state"], row["attempts"]) == ("failed_webhook", 1)
    assert row["last_error"] == "500: " + ("no" * 400)[:300]
    assert row["webhook_submitted_at"] is None

    log = statelog.StateLog(spark, f"{folder}/b")
    run_phase_1(spark, log, T0, post=False)
    row = log.current().where("event_id = 'studio-row-1'").first()
    assert (row["state"], row["attempts"], row["webhook_message_id"]) == ("transcript_uploaded", 0, None)


def test_retries(spark, folder):
    log = statelog.StateLog(spark, folder)
    run_phase_1(spark, log, T0)
    again = transitions.select_retryable(log.current(), roster.roster_schema())
    assert {r["row_position"] for r in again.collect()} == {6, 7, 9}
    assert again.where("row_position = 6").first()["transcriptLink"] == FILE + "GONE/view"
    log.append(transitions.retry_failed(log.current(), T0 + HOUR), "retry", 1)
    assert states(log)["studio-row-6"] == ("pending", 1)
    log.append(transitions.retry_rows(log.current(), [" studio-row-6", "unknown", ""], T0 + 2 * HOUR), "retry", 2)
    assert states(log)["studio-row-6"] == ("pending", 0)
    assert log.current().where("event_id = 'studio-row-6'").first()["last_error"] is None


def test_an_image_supersedes_its_source_whatever_the_clock(spark, folder):
    log = statelog.StateLog(spark, folder)
    run_phase_1(spark, log, T0)
    log.append(transitions.retry_failed(log.current(), T0 - 100 * HOUR), "retry", 1)
    assert states(log)["studio-row-6"] == ("pending", 1)


def test_sweep(spark, folder):
    log = statelog.StateLog(spark, folder)
    run_phase_1(spark, log, T0)
    assert transitions.timeout_sweep(log.current(), T0 + 48 * HOUR).count() == 0
    swept = transitions.timeout_sweep(log.current(), T0 + 49 * HOUR)
    log.append(swept, "sweep", 1)
    assert states(log)["studio-row-1"] == ("failed_timeout_pending_analysis", 0)
    assert transitions.pending_remaining(log.current()).first()[0] == 0


def test_repeated_batch_and_snapshot(spark, folder):
    log = statelog.StateLog(spark, folder)
    run_phase_1(spark, log, T0)
    before = states(log)
    images = log.log().count()
    retry = transitions.retry_failed(log.current(before=("retry", 1)), T0 + HOUR)
    log.append(retry, "retry", 1)
    log.append(transitions.retry_failed(log.current(before=("retry", 1)), T0 + HOUR), "retry", 1)
    assert log.log().count() == images + 3
    after = states(log)
    log.compact(T0 + 2 * HOUR)
    assert states(log) == after
    # The newest batch can still be repeated from the state before it.
    assert {r["event_id"]: r["state"] for r in log.current(before=("retry", 1)).collect()} == {
        e: s for e, (s, _) in before.items()
    }
    log.append(transitions.retry_rows(log.current(), ["studio-row-6"], T0 + 3 * HOUR), "retry", 2)
    log.compact(T0 + 4 * HOUR)
    assert states(log)["studio-row-6"] == ("pending", 0)
    assert len(states(log)) == 9


def test_source_lock_and_reset(spark, folder):
    log = statelog.StateLog(spark, folder)
    rows = make_roster(spark)
    known, other = fingerprint.table_fingerprint(rows), fingerprint.table_fingerprint(rows.limit(3))
    assert log.register_source("a", known, T0, "queue") is True
    assert log.register_source("a", known, T0) is False
    with pytest.raises(statelog.SourceChanged):
        log.register_source("a", other, T0)
    log.finish_phase_1(T0 + HOUR)
    fact = log.source_facts().first()
    assert (fact["rows"], fact["phase_1_started_at"], fact["phase_1_finished_at"]) == (9, T0, T0 + HOUR)
    run_phase_1(spark, log, T0)
    with pytest.raises(ValueError):
        log.reset(T0)
    assert log.reset(T0, confirm=True) == 1
    assert states(log) == {} and log.source_facts().count() == 0
    assert log.register_source("a", other, T0) is True
    assert statelog.StateLog(spark, folder).generation == 1


def test_selection_text():
    assert submit.parse_positions("3, 1,,1 ,") == [1, 3]
    assert submit.parse_range(" 9 - 2 ") == (2, 9)
    for bad in ("5", "a-b", "1-2-3", "", "-4"):
        with pytest.raises(ValueError):
            submit.parse_range(bad)


def test_range_filter_reaches_the_scan(spark, folder):
    make_roster(spark).write.parquet(f"{folder}/r")
    rows = submit.select_range(spark.read.parquet(f"{folder}/r"), "3-5").select("school", "row_position")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row_position,3)" in plan and "LessThanOrEqual(row_position,5)" in plan
    assert "transcriptLink" not in plan
    assert rows.count() == 3


def test_fetch(spark, folder):
    log = statelog.StateLog(spark, folder)
    run_phase_1(spark, log, T0)
    assert transitions.fetch_by_state(log.current(), []).count() == 0
    found = transitions.fetch_by_state(log.current(), ["failed_drive_read", "submitted"], 1)
    assert [r["row_position"] for r in found.collect()] == [1, 2]


def test_release_schedule(spark):
    rows = spark.createDataFrame([(p, f"e{p}") for p in (9, 2, 70, 5)], "row_position long, event_id string")
    found = submit.release_schedule(rows, T0, requests_per_second=0.2).collect()
    got = {r["row_position"]: (r["slot"], (r["release_at"] - T0).total_seconds()) for r in found}
    assert got == {2: (0, 0.0), 5: (1, 5.0), 9: (2, 10.0), 70: (3, 15.0)}
    assert submit.projected_duration(rows, requests_per_second=0).first()["hours"] == round(4 / 0.0001 / 3600, 2)


def test_outbox_files(spark, folder):
    log = statelog.StateLog(spark, f"{folder}/s")
    rows = submit.with_event_id(make_roster(spark))
    gated = submit.gate(rows, log.current(), make_assets(spark))
    box = submit.outbox(gated, T0, payload.secret_pads(spark, "k"), bucket="b", blob_prefix="p")
    for _ in range(2):
        submit.write_outbox(box, f"{folder}/outbox", "r1")
        documents = spark.createDataFrame([(1, "uno"), (2, "dos")], "content_id long, content string")
        submit.write_transcripts(gated, documents.union(documents), f"{folder}/blobs", "p", "r1", T0)
    assert spark.read.parquet(f"{folder}/outbox").count() == 2
    first = {
        ("p/studio-row-1/transcript.docx", "uno", "docx", "r1"), ("p/studio-row-2/transcript.txt", "dos", "txt", "r1"),
    }
    columns = ["blob_path", "content", "extension", "run"]

    def published():
        rows = submit.published_transcripts(spark, f"{folder}/blobs").select(columns).collect()
        assert len(rows) == len(set(rows))
        return set(map(tuple, rows))

    assert published() == first
    # A later run with one of the rows, and a new text: the other run's stay.
    newer = spark.createDataFrame([(2, "DOS")], "content_id long, content string")
    assert submit.write_transcripts(gated.where("content_id = 2"), newer, f"{folder}/blobs", "p", "r2", T0) == 3
    assert published() == {x for x in first if x[1] == "uno"} | {("p/studio-row-2/transcript.txt", "DOS", "txt", "r2")}


def test_the_last_publication_counts(spark, folder):
    """Whatever runs are called; one that was cut short before the manifest is not read."""
    rows = spark.createDataFrame(
        [("e1", submit.ELIGIBLE, S.PLAIN_TEXT, 1), ("e2", submit.ELIGIBLE, S.DOCX, 1), ("e3", "skipped", None, None)],
        "event_id string, outcome string, asset_mime string, content_id long",
    )
    path = f"{folder}/blobs"
    assert submit.published_transcripts(spark, path).collect() == []

    def publish(run, part="true"):
        text = spark.createDataFrame([(1, f"by {run}"), (9, "not asked for")], "content_id long, content string")
        return submit.write_transcripts(rows.where(part), text, path, "p", run, T0)

    for n in range(1, 13):
        assert publish(f"run-{n}") == n
    got = {r.event_id: (r.content, r.run) for r in submit.published_transcripts(spark, path).collect()}
    assert got == {"e1": ("by run-12", "run-12"), "e2": ("by run-12", "run-12")}
    assert publish("run-9", "event_id = 'e2'") == 13
    got = {r.event_id: r.run for r in submit.published_transcripts(spark, path).collect()}
    assert got == {"e1": "run-12", "e2": "run-9"}
    spark.createDataFrame([("e1", "x", "txt", "half")], "event_id string, blob_path string, extension string, content string").write.parquet(
        f"{path}/texts/publication=14"
    )
    assert {r.event_id: r.run for r in submit.published_transcripts(spark, path).collect()} == got
    assert publish("run-13") == 14
    assert {r.run for r in submit.published_transcripts(spark, path).collect()} == {"run-13"}
    assert [r.run for r in submit.publications(spark, path).where("publication = 13").collect()] == ["run-9"]


def test_many_rows_to_one_text(spark):
    """A text that most rows ask for is dealt over tasks; rows and texts stay whole."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 1).when(F.col("id") % 30 > 0, F.col("id")).alias("k"), "id")
    table = spark.range(5000).select(F.col("id").alias("k"), F.concat(F.lit("t"), "id").alias("text"))
    found = look_up(rows, table.union(table), "k", values=["text"], asking=100)
    got = {r.id: r.text for r in found.collect()}
    assert got == {n: "t1" if n % 3 else f"t{n}" for n in range(3000) if n % 3 or n % 30}
    # 2000 rows ask for one text, 100 a copy
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(sequence" in plan and found.count() == len(got)


def test_files_listed_twice_are_submitted_once(spark, folder):
    log = statelog.StateLog(spark, folder)
    once = make_assets(spark)
    again = spark.createDataFrame(
        [("F1", "SHELF", "n", S.MP4, False, 5), ("F1", "SHELF", "n", S.DOCX, True, 0)], once.listing.schema
    )
    assets = catalog.usable_assets(once.listing.union(again), once.content.union(once.content))
    gated = submit.gate(make_roster(spark), log.current(), assets)
    assert sorted(r["event_id"] for r in gated.where("outcome = 'eligible'").collect()) == ["studio-row-1", "studio-row-2"]
    assert gated.count() == 9
    assert catalog.file_mimes(assets.listing).where("file_id = 'F1'").first()["mime"] == S.PLAIN_TEXT


def test_only_what_links_ask_for_is_grouped(spark, folder):
    """Listing and content index are dropped where they are read, before any exchange, but
    for the rows that links ask for; and no row that is asked for is dropped."""
    listing = spark.range(20_000).selectExpr(
        "concat('F', id) AS file_id", "IF(id % 2 = 0, concat('D', id % 50), NULL) AS folder_id", "'n' AS name",
        "'text/plain' AS mime", "false AS trashed", "id AS list_order",
    )
    content = spark.range(20_000).selectExpr("concat('F', id) AS file_id", "id AS content_id")
    assets = catalog.usable_assets(listing, content)
    keys = spark.createDataFrame([("file:F7",), ("folder:D4",), (None,), ("file:GONE",)], "asset_key string")
    found = {r.asset_key: r.found_file for r in assets.wanted(keys).collect()}
    assert found["file:F7"] == "F7" and found["folder:D4"] == "F4" and len(found) < 60
    files = spark.createDataFrame([(f"F{k}",) for k in range(0, 20_000, 100)], "asset_file_id string")
    stored = assets.content_of(files)
    rows = {r.file_id: r.content_id for r in stored.collect()}
    assert all(rows[f"F{k}"] == k for k in range(0, 20_000, 100)) and len(rows) < 1000
    plan = stored._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("hashpartitioning(file_id") :]
    assert below.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan
    log = statelog.StateLog(spark, folder)
    final = submit.outcomes(make_roster(spark), log.current(), make_assets(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "teacher" not in final and "Aggregate" not in final  # what it is made of is written


def test_wide_rows_meet_their_outcome_once(spark, folder):
    log = statelog.StateLog(spark, folder)
    plan = submit.gate(make_roster(spark), log.current(), make_assets(spark))._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    assert text.count("teacher") == 2 or text.count("LogicalRDD") == 1  # the roster, once


def test_submission_results_of_one_event(spark, folder):
    """The result sent last counts, and one that does not say it was published was not."""
    log = statelog.StateLog(spark, folder)
    rows = submit.with_event_id(make_roster(spark))
    log.append(submit.new_images(rows, log.current(), T0), "submit", 1)
    gated = submit.gate(rows, log.current(), make_assets(spark))
    box = submit.outbox(gated, T0, payload.secret_pads(spark, "k"), bucket="b", blob_prefix="p")
    results = spark.createDataFrame(
        [
            ("studio-row-1", True, None, 500, None, "no", T0), ("studio-row-1", True, None, 202, "m", None, T0 + HOUR),
            ("studio-row-2", None, "lost", None, None, None, T0),
        ],
        "event_id string, published boolean, publish_error string, status int, message_id string, body string, sent_at timestamp_ntz",
    )
    new = submit.apply_submissions(log.current(), box, results, T0 + HOUR).collect()
    assert sorted((r["event_id"], r["state"], r["last_error"]) for r in new) == [
        ("studio-row-1", "submitted", None), ("studio-row-2", "failed_gcs_upload", "lost"),
    ]


def test_attempts_over_a_written_log(spark, folder):
    log = statelog.StateLog(spark, folder)
    run_phase_1(spark, log, T0)
    run_phase_1(spark, log, T0 + HOUR)
    log.append(transitions.retry_rows(log.current(), ["studio-row-6"], T0 + 2 * HOUR), "retry", 1)
    run_phase_1(spark, log, T0 + 3 * HOUR)
    found = {r["event_id"]: (r["spent"], r["attempts"]) for r in transitions.attempts_spent(log.log()).collect()}
    assert found["studio-row-6"] == (3, 1) and found["studio-row-7"] == (3, 3) and found["studio-row-1"] == (0, 0)


def test_current_where_is_current(spark, folder):
    log = statelog.StateLog(spark, folder)
    run_phase_1(spark, log, T0)
    failed = F.col("state") == "failed_drive_read"
    narrow = statelog.current_where(log.log().select(*statelog.LOG_COLUMNS), ["state"], failed)
    assert sorted(map(str, narrow.collect())) == sorted(map(str, log.current().where(failed).collect()))
    plan = narrow._jdf.queryExecution().optimizedPlan().toString()
    aggregates = [line for line in plan.splitlines() if "Aggregate" in line]
    assert aggregates and not any("excel_row_json" in line for line in aggregates)


def test_patches_of_one_key(spark):
    base = spark.createDataFrame([("a", "x", "y"), ("b", "x", "y")], "k string, p string, q string")
    rows = [("a", "1", None, 1), ("a", None, "2", 2), ("a", "0", None, 3), ("a", None, None, 4)]
    patch = spark.createDataFrame(rows, "k string, p string, q string, n int")
    assert sorted(map(tuple, transitions.dim_patch(base, patch, ["k"], ["n"]).collect())) == [("a", "0", "2"), ("b", "x", "y")]


def test_the_snapshot_is_not_moved(spark, folder):
    """Over a compacted log the current state, and that of some events, is found where the
    snapshot lies: what has been appended since, or is asked for, comes to it."""
    log = statelog.StateLog(spark, folder)
    run_phase_1(spark, log, T0)
    run_phase_1(spark, log, T0 + HOUR)
    log.compact(T0 + HOUR)
    log.append(transitions.retry_rows(log.current(), ["studio-row-6"], T0 + 2 * HOUR), "retry", 1)
    whole = {r.event_id: r for r in statelog.current_state(log.log().select(*statelog.LOG_COLUMNS)).collect()}
    assert {r.event_id: r for r in log.current().collect()} == whole
    some = spark.createDataFrame([("studio-row-6",), ("studio-row-3",), ("gone",), ("studio-row-3",)], "event_id string")
    assert {r.event_id: r for r in log.current_of(some).collect()} == {e: whole[e] for e in ("studio-row-6", "studio-row-3")}

    def moved(df):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        [at] = [k for k, line in enumerate(lines) if "Bucketed: true" in line]
        depth = lambda line: len(line) - len(line.lstrip(" :+-*(0123456789)"))
        above, level = [], depth(lines[at])
        for line in reversed(lines[:at]):
            if depth(line) < level:
                above.append(line.strip(" :+-"))
                level = depth(line)
        join = next(k for k, line in enumerate(above) if "SortMergeJoin" in line)
        return [line for line in above[:join] if "Exchange" in line]

    assert moved(log.current()) == [] and moved(log.current(["event_id", "state"])) == []
    assert moved(log.current_of(some)) == []
    # A session that has not written the snapshot knows it from the facts.
    for name in [x.name for x in spark.catalog.listTables() if x.name.startswith("rollcall_snapshot_")]:
        spark.sql(f"DROP TABLE {name}")
    assert {r.event_id: r for r in statelog.StateLog(spark, folder).current().collect()} == whole


def test_several_changes_of_one_event(spark, folder):
    log = statelog.StateLog(spark, folder)
    run_phase_1(spark, log, T0)
    rows = [("studio-row-6", "A", "x", 1), ("studio-row-6", None, "y", 3), ("studio-row-6", "B", None, 2), ("gone", "A", "x", 1)]
    changes = spark.createDataFrame(rows, "event_id string, drive_case string, last_error string, n int")
    new = transitions.patch_images(log.current(), changes, T0 + HOUR, order=["n"]).collect()
    assert [(r.event_id, r.drive_case, r.last_error) for r in new] == [("studio-row-6", None, "y")]
    same = changes.where("n = 1").union(changes.where("n = 1")).drop("n")
    assert transitions.patch_images(log.current(), same, T0 + HOUR).count() == 1
    for unclear, order in ((changes.drop("n"), None), (changes.withColumn("n", F.lit(1)), ["n"])):
        with pytest.raises(Exception, match="studio-row-6"):
            transitions.patch_images(log.current(), unclear, T0 + HOUR, order=order).collect()
    log.append(transitions.patch_images(log.current(), changes, T0 + HOUR, order=["n"]), "patch", 1)
    named = log.log().groupBy("event_id", "log_ts", "log_seq").count()
    assert named.where("count > 1").count() == 0


def test_time_zones_play_no_part(spark, folder):
    """Signature time, release times and cut-offs under a session zone far from UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        log = statelog.StateLog(spark, folder)
        gated = submit.gate(submit.with_event_id(make_roster(spark)), log.current(), make_assets(spark))
        box = submit.outbox(gated, T0, payload.secret_pads(spark, "k"), bucket="b", blob_prefix="p")
        row = box.select("headers.X-Webhook-Timestamp", "body", F.col("url_expires_at").cast("string").alias("u")).first()
        run_phase_1(spark, log, T0)
        swept = transitions.timeout_sweep(log.current(), T0 + 48 * HOUR).count()
        aware = T0.replace(tzinfo=dt.timezone(dt.timedelta(hours=-6)))
        later = transitions.timeout_sweep(log.current(), aware + 43 * HOUR).count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row["X-Webhook-Timestamp"] == "1704067200" and row["u"] == "2024-01-01 06:00:00"
    assert '"recorded_at":"2024-01-01T00:00:00+00:00"' in row["body"]
    assert (swept, later) == (0, 2)
