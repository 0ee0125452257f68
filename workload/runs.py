"""Run reports and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.functions.runs import canonical_command
from stackroom.plans.progress import (
    dataset_status,
    log_tail,
    pick_run,
    progress_snapshot,
    progress_totals,
    with_eta,
    with_pending,
)
from stackroom.plans.reports import (
    for_dataset,
    in_report_order,
    latest_per_command,
    latest_report_path,
    prunable_reports,
    report_breakdown,
    report_stamp,
    report_summary,
    select_reports,
    step_failures,
    step_rollup,
    with_report_position,
    with_totals,
)
from stackroom.schemas import REPORT
from workload.tables import derived, micros, seconds, table

RUNTIME = 86_400.0


def _k():
    return F.get_json_object("props", "$.k").cast("bigint")


def _user():
    return F.concat(F.lit("user_"), F.col("user_id").cast("string"))


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as the report of a run."""
    kind, value = F.col("event_type"), F.col("value")
    command = (
        F.when(kind == "view", "index")
        .when(kind == "click", "download")
        .when(kind == "error", "verify_index")
        .when(kind == "signup", "verify-download")
        .otherwise("all")
    )
    zero = F.lit(0).cast("bigint")
    failed = F.when(value > 150, F.col("k")).otherwise(zero)
    skipped = F.when(value < 10, F.col("k")).otherwise(zero)
    text = F.lit(None).cast("string")
    users = F.array(
        F.struct(
            F.col("user").alias("dataset"),
            F.col("k").alias("items_scanned"),
            (F.col("k") - failed - skipped).alias("succeeded"),
            failed.alias("failed"),
            skipped.alias("skipped"),
        ),
        F.struct(
            F.lit("shared").alias("dataset"),
            (F.col("k") + 1).alias("items_scanned"),
            (F.col("k") + 1).alias("succeeded"),
            zero.alias("failed"),
            zero.alias("skipped"),
        ),
    )
    steps = F.array(
        F.struct(
            F.lit("download").alias("step"), F.lit("ok").alias("status"), text.alias("report_path"), text.alias("message")
        ),
        F.struct(
            F.lit("index").alias("step"),
            F.when(value > 100, "failed").otherwise("ok").alias("status"),
            F.concat(F.lit("/reports/index-"), F.col("event_id").cast("string")).alias("report_path"),
            F.when(value > 100, F.concat(F.lit("broke on "), "user")).alias("message"),
        ),
    )
    failures = F.array(
        F.struct(
            F.concat(F.lit("broken_"), "user").alias("dataset"),
            F.lit("index_stage1").alias("phase"),
            *[text.alias(name) for name in ("rel_path", "source_path", "output_path")],
            F.lit("damaged").alias("error_message"),
            text.alias("suggested_recovery"),
        )
    )
    no_datasets, no_failures, no_steps = (
        F.array().cast(REPORT[name].dataType) for name in ("datasets", "failures", "step_runs")
    )
    events = table(spark, sf_dir, "events").withColumns({"k": _k(), "user": _user()})
    millis = F.call_function("div", micros("ts"), F.lit(1000))
    rows = events.select(
        command.alias("command"),
        F.lit("").alias("cli_version"),
        F.when(value < 5, zero).otherwise(millis).alias("report_nonce"),
        seconds("ts").alias("started_at_unix"),
        F.when((kind != "view") | (value < 300), seconds("ts") + value.cast("bigint")).alias("finished_at_unix"),
        F.when(value < 300, value).alias("duration_seconds"),
        F.create_map(F.lit("dataset"), F.col("user")).alias("args"),
        F.when(kind.isin("view", "click", "error"), users).otherwise(no_datasets).alias("datasets"),
        F.when(failed > 0, failures).otherwise(no_failures).alias("failures"),
        F.when(kind == "purchase", steps).otherwise(no_steps).alias("step_runs"),
        F.concat(F.lit("/reports/"), command, F.lit("-"), F.lpad(F.col("event_id").cast("string"), 20, "0"), F.lit(".json")).alias("path"),
    )
    return with_totals(rows)


_TOTALS = ("totals_items_scanned", "totals_succeeded", "totals_failed", "totals_skipped")


def report_latest(spark, sf_dir):
    latest = latest_per_command(_reports(spark, sf_dir))
    return latest.select("command", "path", report_stamp().alias("stamp"), *_TOTALS)


def report_totals(spark, sf_dir):
    return _reports(spark, sf_dir).select("path", *_TOTALS)


def report_order(spark, sf_dir):
    """Reports in listing order."""
    return report_summary(in_report_order(_reports(spark, sf_dir)), "UTC")


def report_positions(spark, sf_dir):
    """The place of each report in the listing."""
    return with_report_position(_reports(spark, sf_dir)).select("position", "command", "path")


def report_lines(spark, sf_dir):
    return report_breakdown(_reports(spark, sf_dir))


def report_command_filter(spark, sf_dir):
    chosen = select_reports(_reports(spark, sf_dir), command="index")
    return chosen.select("path", "duration_seconds")


def report_dataset_filter(spark, sf_dir):
    """Reports that list a failure of one user."""
    return for_dataset(_reports(spark, sf_dir), "broken_user_7").select("path", "command")


def reports_to_prune(spark, sf_dir):
    return prunable_reports(_reports(spark, sf_dir), keep=3).select("command", "path")


def latest_paths(spark, sf_dir):
    return latest_report_path(_reports(spark, sf_dir))


def command_names(spark, sf_dir):
    folded = canonical_command(F.col("command")).alias("name")
    return _reports(spark, sf_dir).groupBy("command", folded).agg(F.count(F.lit(1)).alias("n"))


def steps_per_run(spark, sf_dir):
    return step_rollup(_reports(spark, sf_dir))


def failed_steps(spark, sf_dir):
    return step_failures(_reports(spark, sf_dir))


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a log line of its user."""
    kind, value, k = F.col("event_type"), F.col("value"), F.col("k").cast("string")
    body = (
        F.when(kind == "signup", F.concat(F.lit("start source_files="), k, F.lit(" workers=4")))
        .when(kind == "click", F.concat(F.lit("plan todo_files="), k))
        .when(kind == "view", F.concat(F.lit("file indexed rows="), k))
        .when((kind == "purchase") & (value > 50), F.concat(F.lit("run summary scanned="), k, F.lit(" ok="), k, F.lit(" failed="), F.when(value > 200, "2").otherwise("0")))
        .when((kind == "error") & (value > 100), F.lit("all files already indexed"))
        .otherwise(F.concat(F.lit("note source_files=n/a ok="), k))
    )
    lines = table(spark, sf_dir, "events").withColumn("k", _k()).select(
        _user().alias("dataset"),
        F.concat(_user(), F.lit("/index/index.log")).alias("file"),
        # A day of a log is a block of it.
        F.call_function("div", micros("ts"), F.lit(86_400_000_000)).alias("block"),
        F.struct(micros("ts").alias("at"), "event_id").alias("row"),
        F.concat(seconds("ts").cast("string"), F.lit(" [index] "), body).alias("value"),
    )
    return derived(lines)


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of every customer's log; most customers have none."""
    datasets = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("user_"), F.col("c_custkey").cast("string")).alias("dataset")
    )
    return with_pending(datasets, dataset_status(_logs(spark, sf_dir)))


def progress_status(spark, sf_dir):
    return _status(spark, sf_dir)


def progress_eta(spark, sf_dir):
    return with_eta(_status(spark, sf_dir), F.lit(RUNTIME)).select(
        "dataset", "status", "converted", "todo", "eta", "message"
    )


def progress_overall(spark, sf_dir):
    return progress_totals(_status(spark, sf_dir), F.lit(RUNTIME))


def log_tails(spark, sf_dir):
    return log_tail(_logs(spark, sf_dir), 2)


def long_log_tails(spark, sf_dir):
    """The last 1,500 lines of one log per kind of event."""
    lines = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("file"),
        F.call_function("div", micros("ts"), F.lit(86_400_000_000)).alias("block"),
        F.struct(micros("ts").alias("at"), "event_id").alias("row"),
        F.col("props").alias("value"),
    )
    return log_tail(lines, 1_500)


def _touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When the log of each (command, user) was last touched: the user's last purchase."""
    events = table(spark, sf_dir, "events")
    return (
        events.where(F.col("event_type") == "purchase")
        .groupBy(_user().alias("dataset"))
        .agg(F.max(seconds("ts")).alias("touched_unix"))
        .select(F.lit("index").alias("command"), "dataset", "touched_unix")
    )


_PICKED = ("command", "report_path", "started_at_unix", "finished_at_unix", "runtime_seconds", *_TOTALS)


def pick_active_run(spark, sf_dir):
    now = F.lit(1_706_572_800).cast("bigint")
    run = pick_run(_reports(spark, sf_dir), _touched(spark, sf_dir), now)
    return progress_snapshot(run, now).select(*_PICKED)


def pick_recent_run(spark, sf_dir):
    """No run is open: the newest whose log was touched within five minutes."""
    now = F.lit(1_706_572_800).cast("bigint")
    finished = _reports(spark, sf_dir).withColumn(
        "finished_at_unix", F.coalesce("finished_at_unix", "started_at_unix")
    )
    run = pick_run(finished, _touched(spark, sf_dir), now, command="index")
    return progress_snapshot(run, now).select(*_PICKED)


QUERIES = {
    "report_latest": report_latest,
    "report_totals": report_totals,
    "report_order": report_order,
    "report_position": report_positions,
    "report_breakdown": report_lines,
    "report_command_filter": report_command_filter,
    "report_dataset_filter": report_dataset_filter,
    "reports_to_prune": reports_to_prune,
    "latest_report_path": latest_paths,
    "command_names": command_names,
    "step_rollup": steps_per_run,
    "step_failures": failed_steps,
    "progress_status": progress_status,
    "progress_eta": progress_eta,
    "progress_totals": progress_overall,
    "log_tail": log_tails,
    "log_tail_long": long_log_tails,
    "pick_active_run": pick_active_run,
    "pick_recent_run": pick_recent_run,
}

_REPORTS = """
ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 'user_' || user_id AS usr,
         epoch_us(ts) // 1000000 AS sec,
         CASE event_type WHEN 'view' THEN 'index' WHEN 'click' THEN 'download' WHEN 'error' THEN 'verify_index'
              WHEN 'signup' THEN 'verify-download' ELSE 'all' END AS command
  FROM events),
reports AS (
  SELECT command, event_type, event_id, k, usr, value, sec AS started_at_unix,
         CASE WHEN value < 5 THEN sec * 1000 ELSE epoch_us(ts) // 1000 END AS stamp,
         CASE WHEN event_type <> 'view' OR value < 300 THEN sec + CAST(trunc(value) AS BIGINT) END AS finished_at_unix,
         CASE WHEN value < 300 THEN value END AS duration_seconds,
         event_type IN ('view', 'click', 'error') AS has_datasets,
         CASE WHEN value > 150 THEN k ELSE 0 END AS d_failed,
         CASE WHEN value < 10 THEN k ELSE 0 END AS d_skipped,
         '/reports/' || command || '-' || lpad(CAST(event_id AS VARCHAR), 20, '0') || '.json' AS path,
         CASE command WHEN 'all' THEN 0 WHEN 'download' THEN 1 WHEN 'verify-download' THEN 2 WHEN 'index' THEN 7
              WHEN 'verify_index' THEN 9 END AS flow_rank
  FROM ev),
totals AS (
  SELECT *, CAST(CASE WHEN has_datasets THEN 2 * k + 1 ELSE 0 END AS BIGINT) AS totals_items_scanned,
         CAST(CASE WHEN has_datasets THEN 2 * k + 1 - d_failed - d_skipped ELSE 0 END AS BIGINT) AS totals_succeeded,
         CAST(CASE WHEN has_datasets THEN d_failed ELSE 0 END AS BIGINT) AS totals_failed,
         CAST(CASE WHEN has_datasets THEN d_skipped ELSE 0 END AS BIGINT) AS totals_skipped
  FROM reports)
"""

_TOTAL_NAMES = ", ".join(_TOTALS)


def _duration(seconds_sql: str) -> str:
    s = f"CAST(greatest(round({seconds_sql}), 0) AS BIGINT)"
    return f"""CASE WHEN {seconds_sql} IS NULL THEN NULL
      WHEN {s} >= 3600 THEN ({s} // 3600) || 'h' || lpad(CAST({s} % 3600 // 60 AS VARCHAR), 2, '0') || 'm'
           || lpad(CAST({s} % 60 AS VARCHAR), 2, '0') || 's'
      WHEN {s} >= 60 THEN ({s} // 60) || 'm' || lpad(CAST({s} % 60 AS VARCHAR), 2, '0') || 's'
      ELSE {s} || 's' END"""


_LOGS = """
lines AS (
  SELECT 'user_' || user_id AS dataset, epoch_us(ts) AS at_us, event_id,
         (epoch_us(ts) // 1000000) || ' [index] ' || CASE
           WHEN event_type = 'signup' THEN 'start source_files=' || k || ' workers=4'
           WHEN event_type = 'click' THEN 'plan todo_files=' || k
           WHEN event_type = 'view' THEN 'file indexed rows=' || k
           WHEN event_type = 'purchase' AND value > 50 THEN 'run summary scanned=' || k || ' ok=' || k
                || ' failed=' || CASE WHEN value > 200 THEN 2 ELSE 0 END
           WHEN event_type = 'error' AND value > 100 THEN 'all files already indexed'
           ELSE 'note source_files=n/a ok=' || k END AS line
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)),
marks AS (
  SELECT dataset, at_us, event_id, line, contains(line, ' summary ') AS is_summary,
         contains(line, 'all files already') AS idle, contains(line, ' indexed ') AS item,
         TRY_CAST(regexp_extract(line, '(?:source_files|scanned)=([0-9]+)', 1) AS BIGINT) AS scanned,
         TRY_CAST(regexp_extract(line, 'todo_files=([0-9]+)', 1) AS BIGINT) AS todo,
         CASE WHEN contains(line, ' summary ')
              THEN TRY_CAST(regexp_extract(line, 'ok=([0-9]+)', 1) AS BIGINT) END AS ok,
         TRY_CAST(regexp_extract(line, 'failed=([0-9]+)', 1) AS BIGINT) AS failed
  FROM lines),
running AS (
  SELECT *, last_value(scanned IGNORE NULLS) OVER (PARTITION BY dataset ORDER BY at_us, event_id) AS so_far FROM marks),
told AS (
  SELECT dataset,
         coalesce(arg_max(scanned, (at_us, event_id)) FILTER (scanned IS NOT NULL), 0) AS scanned,
         coalesce(arg_max(todo, (at_us, event_id)) FILTER (todo IS NOT NULL), 0) AS todo,
         count(*) FILTER (item) AS converted,
         coalesce(arg_max(ok, (at_us, event_id)) FILTER (ok IS NOT NULL), 0) AS ok,
         coalesce(arg_max(failed, (at_us, event_id)) FILTER (failed IS NOT NULL), 0) AS failed,
         coalesce(arg_max(so_far, (at_us, event_id)) FILTER (idle), 0) AS skipped,
         bool_or(is_summary OR idle) AS done, coalesce(bool_or(failed > 0), false) AS errored,
         arg_max(line, (at_us, event_id)) AS last_log
  FROM running GROUP BY dataset),
status AS (
  SELECT 'user_' || c_custkey AS dataset,
         CASE WHEN t.dataset IS NULL THEN 'pending' WHEN errored THEN 'error' WHEN done THEN 'done'
              WHEN scanned > 0 OR converted > 0 THEN 'in-progress' ELSE 'pending' END AS status,
         coalesce(scanned, 0) AS scanned, coalesce(todo, 0) AS todo, coalesce(converted, 0) AS converted,
         coalesce(ok, 0) AS ok, coalesce(failed, 0) AS failed, coalesce(skipped, 0) AS skipped,
         coalesce(last_log, '') AS last_log
  FROM customer LEFT JOIN told t ON t.dataset = 'user_' || c_custkey)
"""

_ETA = """CASE WHEN todo > 0 AND converted > 0
   THEN CAST(greatest(todo - converted, 0) AS DOUBLE) / (CAST(converted AS DOUBLE) / 86400.0) END"""

_SNAPSHOT = f"""SELECT command, path AS report_path, started_at_unix, finished_at_unix,
   coalesce(duration_seconds, CAST(greatest(1706572800 - started_at_unix, 0) AS DOUBLE)) AS runtime_seconds,
   {_TOTAL_NAMES}"""

_TOUCHED = """
touched AS (SELECT 'user_' || user_id AS usr, max(epoch_us(ts) // 1000000) AS last_touch FROM events
            WHERE event_type = 'purchase' GROUP BY 1)"""

SQL = {
    "report_latest": f"""
        WITH {_REPORTS} SELECT command, path, stamp, {_TOTAL_NAMES} FROM totals
        QUALIFY row_number() OVER (PARTITION BY command ORDER BY stamp DESC, path) = 1""",
    "report_totals": f"WITH {_REPORTS} SELECT path, {_TOTAL_NAMES} FROM totals",
    "report_order": f"""
        WITH {_REPORTS} SELECT command, flow_rank, CASE WHEN totals_failed = 0 THEN 'ok' ELSE 'FAILED' END AS status,
               totals_failed, totals_succeeded, totals_skipped,
               strftime(make_timestamp(started_at_unix * 1000000), '%Y-%m-%d %H:%M:%S') AS started_local,
               coalesce({_duration('duration_seconds')}, '-') AS runtime, path
        FROM totals ORDER BY flow_rank, stamp DESC, path""",
    "report_position": f"""
        WITH {_REPORTS} SELECT row_number() OVER (ORDER BY flow_rank, stamp DESC, path) AS position, command, path
        FROM totals""",
    "report_breakdown": f"""
        WITH {_REPORTS}, t AS (SELECT *, CASE WHEN totals_failed = 0 THEN 'ok' ELSE 'FAILED' END AS status FROM totals)
        SELECT path, command, status, 'dataset' AS kind, usr AS name, k AS scanned,
               CAST(k - d_failed - d_skipped AS BIGINT) AS ok, CAST(d_failed AS BIGINT) AS failed,
               CAST(d_skipped AS BIGINT) AS skipped,
               CASE WHEN d_failed > 0 THEN '!' ELSE '' END AS line_status FROM t WHERE has_datasets
        UNION ALL SELECT path, command, status, 'dataset', 'shared', k + 1, k + 1, 0, 0, '' FROM t WHERE has_datasets
        UNION ALL SELECT path, command, status, 'step', 'download', NULL, NULL, NULL, NULL, 'ok' FROM t
                  WHERE event_type = 'purchase'
        UNION ALL SELECT path, command, status, 'step', 'index', NULL, NULL, NULL, NULL,
                         CASE WHEN value > 100 THEN 'failed' ELSE 'ok' END FROM t WHERE event_type = 'purchase'
        UNION ALL SELECT path, command, status, 'totals', NULL, 0, 0, 0, 0, '' FROM t WHERE event_type = 'signup'""",
    "report_command_filter": f"""
        WITH {_REPORTS} SELECT path, duration_seconds FROM reports WHERE command = 'index'""",
    "report_dataset_filter": f"""
        WITH {_REPORTS} SELECT path, command FROM reports WHERE usr = 'user_7' AND d_failed > 0""",
    "reports_to_prune": f"""
        WITH {_REPORTS} SELECT command, path FROM reports
        QUALIFY row_number() OVER (PARTITION BY command ORDER BY stamp DESC, path) > 3""",
    "latest_report_path": f"""
        WITH {_REPORTS}, folded AS (
          SELECT CASE command WHEN 'verify_index' THEN 'verify-index' WHEN 'verify-download' THEN 'verify_download'
                 ELSE command END AS command, path, stamp FROM reports)
        SELECT command, path FROM folded
        QUALIFY row_number() OVER (PARTITION BY command ORDER BY stamp DESC, path) = 1""",
    "command_names": f"""
        WITH {_REPORTS} SELECT command, CASE command WHEN 'verify_index' THEN 'verify-index'
               WHEN 'verify-download' THEN 'verify_download' ELSE command END AS name, count(*) AS n
        FROM reports GROUP BY 1, 2""",
    "step_rollup": f"""
        WITH {_REPORTS} SELECT path, 2 AS steps, CASE WHEN value > 100 THEN 1 ELSE 0 END AS failed_steps,
               CASE WHEN value > 100 THEN 'failed' ELSE 'ok' END AS status
        FROM reports WHERE event_type = 'purchase'""",
    "step_failures": f"""
        WITH {_REPORTS} SELECT path, 'all' AS dataset, 'all_index' AS phase,
               '/reports/index-' || event_id AS output_path, 'broke on ' || usr AS error_message
        FROM reports WHERE event_type = 'purchase' AND value > 100""",
    "progress_status": f"WITH {_LOGS} SELECT * FROM status",
    "progress_eta": f"""
        WITH {_LOGS}, e AS (SELECT *, {_ETA} AS left_s FROM status)
        SELECT dataset, status, converted, todo, {_duration('left_s')} AS eta,
               regexp_replace(last_log, '^[^ ]* [^ ]* ', '') AS message FROM e""",
    "progress_totals": f"""
        WITH {_LOGS}, t AS (
          SELECT count(*) FILTER (status = 'done') AS done, count(*) FILTER (status = 'in-progress') AS in_progress,
                 count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'error') AS error,
                 CAST(sum(converted) AS BIGINT) AS converted, CAST(sum(todo) AS BIGINT) AS todo FROM status),
        e AS (SELECT *, {_ETA} AS left_s FROM t)
        SELECT done, in_progress, pending, error, converted, todo, {_duration('left_s')} AS eta FROM e""",
    "log_tail": f"""
        WITH {_LOGS} SELECT dataset || '/index/index.log' AS file, from_end, line AS value FROM (
          SELECT dataset, line, CAST(row_number() OVER (PARTITION BY dataset ORDER BY at_us DESC, event_id DESC) AS INTEGER)
                 AS from_end FROM lines) WHERE from_end <= 2""",
    "log_tail_long": """
        SELECT event_type AS file, from_end, props AS value FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY event_type ORDER BY epoch_us(ts) DESC, event_id DESC) AS INTEGER)
                 AS from_end FROM events) WHERE from_end <= 1500""",
    "pick_active_run": f"""
        WITH {_REPORTS}, {_TOUCHED},
        open_runs AS (SELECT count(*) AS n FROM totals WHERE finished_at_unix IS NULL)
        {_SNAPSHOT} FROM totals, open_runs
        WHERE finished_at_unix IS NULL
           OR (n = 0 AND command = 'index' AND usr IN (SELECT usr FROM touched WHERE 1706572800 - last_touch <= 300))
        ORDER BY stamp DESC, path LIMIT 1""",
    "pick_recent_run": f"""
        WITH {_REPORTS}, finished AS (
          SELECT * REPLACE (coalesce(finished_at_unix, started_at_unix) AS finished_at_unix) FROM totals),
        {_TOUCHED}
        {_SNAPSHOT} FROM finished WHERE command = 'index'
          AND usr IN (SELECT usr FROM touched WHERE 1706572800 - last_touch <= 300)
        ORDER BY stamp DESC, path LIMIT 1""",
}
