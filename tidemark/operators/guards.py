"""Duplicate-run guards: which candidate runs are already under way or done.

Candidates are rows about to start: ``job_nm``, ``tasksgroup_nm``, ``round_time``,
``dag_run_id``, ``ictrl_dt`` and, for the transform guard, ``labels`` and ``now``. One job
and label may hold a large part of the log, so every guard first cuts the log to what the
candidates can ask for: a bound on time, worked out from them in one small aggregation and
pushed into the scan, and a semi join with the keys they ask about. What is left shrinks to
a fixed number of rows per key, limited map-side, that answers any candidate exactly. A
candidate then meets those and never the runs themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas

# Fixed value: hours a running log blocks another run.
GUARD_HOURS = 3
_BUCKET_SECONDS = GUARD_HOURS * 3600
CANDIDATE_KEY = ["job_nm", "tasksgroup_nm", "round_time", "dag_run_id"]


def running(log: DataFrame) -> DataFrame:
    return log.filter(F.col("status") == schemas.RUNNING)


# --- what of the log matters --------------------------------------------------------------


def _between(log: DataFrame, candidates: DataFrame, column: str, first: Column, last: Column | None = None) -> DataFrame:
    """Log rows with ``column`` from the least ``first`` to before the greatest ``last`` of the candidates.

    The bounds are literals, so the scan skips what lies outside; no candidates, no rows.
    """
    high = F.lit(None).cast("timestamp_ntz") if last is None else last
    bounds = candidates.agg(F.min(first).alias("low"), F.max(high).alias("high")).first()
    if bounds["low"] is None:
        return log.filter(F.lit(False))
    log = log.filter(F.col(column) >= F.lit(bounds["low"]).cast("timestamp_ntz"))
    return log if last is None else log.filter(F.col(column) < F.lit(bounds["high"]).cast("timestamp_ntz"))


def _asked(log: DataFrame, candidates: DataFrame, key: list[str]) -> DataFrame:
    """Log rows of the keys that candidates ask about."""
    return log.join(candidates.select(*key).distinct(), key, "left_semi")


def _guard_hours(ts: str) -> Column:
    return F.col(ts) - F.make_dt_interval(F.lit(0), F.lit(GUARD_HOURS))


# --- transform guard ---------------------------------------------------------------------


def _newest_per(attempts: DataFrame, key: list[str], keep: int) -> DataFrame:
    """The newest ``keep`` attempts per key; Spark applies the limit in each task first."""
    order = [F.desc("job_start_time"), F.desc("dag_run_id"), F.desc("round_time")]
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return attempts.withColumn("_place", place).filter(F.col("_place") <= keep).drop("_place")


def newest_attempts(attempts: DataFrame) -> DataFrame:
    """Per job and label, at most five attempts that answer every candidate.

    ``attempts``: job_nm, label, dag_run_id, round_time, job_start_time. An attempt without a
    run id, round or start never differs from a candidate's or never is recent, so it blocks
    nothing and is left out first; with it the counts below would not hold.

    A candidate asks for the newest attempt of another run id and another round. Of that
    attempt's own run id at most one newer attempt exists that the candidate ignores (the
    one of its round), and of its own round at most one (the one of its run id). So it is
    among the two newest of its run id and of its round; and of such attempts the
    candidate ignores at most two per run id and two per round, so it is among five.
    """
    key = ["job_nm", "label"]
    each = (
        attempts.dropna(subset=["dag_run_id", "round_time", "job_start_time"])
        .repartition(*key, "dag_run_id")  # serves the grouping and the first ranking alike
        .groupBy(*key, "dag_run_id", "round_time").agg(F.max("job_start_time").alias("job_start_time"))
    )
    by_run = _newest_per(each, [*key, "dag_run_id"], 2)
    by_round = _newest_per(by_run, [*key, "round_time"], 2)
    return _newest_per(by_round, key, 5)


def blocked_transform(candidates: DataFrame, log: DataFrame) -> DataFrame:
    """Candidates whose job has another run under way on any of their labels.

    The other run has a different run id and round and started within three hours before
    ``now``.
    """
    asking = candidates.withColumn("label", F.explode("labels"))
    attempts = _between(running(log), candidates, "job_start_time", _guard_hours("now")).select(
        "job_nm", F.col("ictrl_dt").alias("label"), "dag_run_id", "round_time", "job_start_time"
    )
    blocks = (
        (F.col("c.job_nm") == F.col("o.job_nm")) & (F.col("c.label") == F.col("o.label"))
        & (F.col("o.dag_run_id") != F.col("c.dag_run_id"))
        & (F.col("o.round_time") != F.col("c.round_time"))
        & (F.col("o.job_start_time") >= _guard_hours("c.now"))
    )
    newest = newest_attempts(_asked(attempts, asking, ["job_nm", "label"]))
    return asking.alias("c").join(newest.alias("o"), blocks, "left_semi").select(*CANDIDATE_KEY).distinct()


# --- ingest guards --------------------------------------------------------------------


def _folded_keys(df: DataFrame) -> DataFrame:
    return df.withColumns({"job_key": F.lower("job_nm"), "group_key": F.lower("tasksgroup_nm")})


def _two_newest_rounds(log: DataFrame, key: list[str]) -> DataFrame:
    """The two newest rounds per key: the second serves a candidate that is the first.

    Spark applies the rank limit within each task before it shuffles, so a busy key
    sends two rows per task.
    """
    rounds = log.groupBy(*key, "round_time").agg(F.max("dag_run_id").alias("dag_run_id"))
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("round_time")))
    attempt = F.struct("round_time", "dag_run_id")
    return (
        rounds.withColumn("place", place).filter("place <= 2").groupBy(*key)
        .agg(F.max(F.when(F.col("place") == 1, attempt)).alias("newest"),
             F.max(F.when(F.col("place") == 2, attempt)).alias("before"))
    )


def blocked_ingest(candidates: DataFrame, log: DataFrame, any_label: bool = False) -> DataFrame:
    """Candidates with another round under way on the same label, on the same day.

    Only the newest other round counts, and it blocks when it is of the candidate's
    calendar day. With ``any_label`` (call records) any non-null label counts. Rounds before
    the first candidate's day are not read: they block nobody, and hide no newer round.
    """
    key = ["job_key", "group_key"] + ([] if any_label else ["ictrl_dt"])
    rows = _between(running(log), candidates, "round_time", F.date_trunc("day", "round_time").cast("timestamp_ntz"))
    rounds = _two_newest_rounds(
        _asked(_folded_keys(rows.filter(F.col("ictrl_dt").isNotNull())), _folded_keys(candidates), key), key
    )
    other = F.when(
        F.col("newest.round_time") != F.col("round_time"), F.col("newest")
    ).otherwise(F.col("before"))
    return (
        _folded_keys(candidates).join(rounds, key)
        .withColumn("other", other)
        .filter(F.to_date("other.round_time") == F.to_date("round_time"))
        .select(*CANDIDATE_KEY, "ictrl_dt", F.col("other.dag_run_id").alias("other_run"),
                F.col("other.round_time").alias("other_round"))
    )


def _bucket(ts: Column) -> Column:
    return F.floor(F.unix_timestamp(ts.cast("timestamp")) / _BUCKET_SECONDS)


def blocked_null_label(candidates: DataFrame, log: DataFrame) -> DataFrame:
    """Candidates with a run under way that has no label yet, at most three hours older.

    Time is cut into three-hour buckets. In the candidate's own bucket every round is
    recent enough, so the earliest decides whether one came before it; in the bucket
    before, the latest decides whether one is recent enough.
    """
    rows = _between(running(log), candidates, "round_time", _guard_hours("round_time"), F.col("round_time"))
    rounds = (
        _asked(_folded_keys(rows.filter(F.col("ictrl_dt").isNull())), _folded_keys(candidates), ["job_key", "group_key"])
        .withColumn("bucket", _bucket(F.col("round_time")))
        .groupBy("job_key", "group_key", "bucket")
        .agg(F.min(F.struct("round_time", "dag_run_id")).alias("earliest"),
             F.max(F.struct("round_time", "dag_run_id")).alias("latest"))
    )
    own = _bucket(F.col("round_time"))
    recent = _guard_hours("round_time")
    other = F.when(
        F.col("back") == 0,
        F.when(F.col("earliest.round_time") < F.col("round_time"), F.col("earliest")),
    ).when(F.col("latest.round_time") >= recent, F.col("latest"))
    return (
        _folded_keys(candidates)
        .withColumn("back", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("bucket", own - F.col("back"))
        .join(rounds, ["job_key", "group_key", "bucket"])
        .withColumn("other", other)
        .filter(F.col("other").isNotNull())
        .groupBy(*CANDIDATE_KEY, "ictrl_dt")
        .agg(F.max("other").alias("other"))
        .select(*CANDIDATE_KEY, "ictrl_dt", F.col("other.dag_run_id").alias("other_run"),
                F.col("other.round_time").alias("other_round"))
    )


_RUN = ["job_key", "group_key", "ictrl_dt"]


def _done(log: DataFrame) -> DataFrame:
    """Job, group and label of runs that succeeded without an error text."""
    ended = log.filter(F.col("status").isin(*schemas.SUCCEEDED) & (F.col("err_msg") == "-"))
    return _folded_keys(ended).select(*_RUN).distinct()


def already_succeeded(candidates: DataFrame, log: DataFrame) -> DataFrame:
    """Candidates whose job and label already succeeded without an error text."""
    found = _folded_keys(candidates).join(_done(log), _RUN, "left_semi")
    return found.drop("job_key", "group_key")


def without_succeeded(candidates: DataFrame, log: DataFrame) -> DataFrame:
    """Candidates that still have to run."""
    left = _folded_keys(candidates).join(_done(log), _RUN, "left_anti")
    return left.drop("job_key", "group_key")


# --- outcome ------------------------------------------------------------------------------


# The texts a blocked run is logged with.
BY_LABEL = ("Found Status RUNNING Job on ictrl_dt: ", " Running ON -> dag_run_id: ", " round_time: ")
BY_NULL_LABEL = ("Found Status RUNNING round_time under 3 with ictrl_dt NULL : Running ON -> dag_run_id: ", " round_time: ")
BLOCKED = "DropDuplicatesJobError: "


def outcome_events(same_label: DataFrame, null_label: DataFrame) -> DataFrame:
    """Failure events of blocked runs, the label guard before the null-label guard."""
    when = F.date_format("other_round", "yyyy-MM-dd HH:mm:ss")
    other = F.coalesce("other_run", F.lit(""))
    by_label = same_label.withColumn("rank", F.lit(1)).withColumn("reason", F.concat(
        F.lit(BY_LABEL[0]), "ictrl_dt", F.lit(BY_LABEL[1]), other, F.lit(BY_LABEL[2]), when,
    ))
    by_null = null_label.withColumn("rank", F.lit(2)).withColumn("reason", F.concat(
        F.lit(BY_NULL_LABEL[0]), other, F.lit(BY_NULL_LABEL[1]), when,
    ))
    return (
        by_label.unionByName(by_null)
        .groupBy(*CANDIDATE_KEY)
        .agg(F.min_by("reason", "rank").alias("reason"), F.any_value("ictrl_dt").alias("ictrl_dt"))
        .select(
            *CANDIDATE_KEY, "ictrl_dt", F.lit(schemas.FAILED).alias("status"),
            F.lit("00:00:00").alias("duration"),
            *[F.lit(0).cast("bigint").alias(c) for c in ("source_cnt", "process_cnt", "row_cnt")],
            F.concat(F.lit(BLOCKED), F.col("reason")).alias("err_msg"),
        )
    )


def refused_events(runs: DataFrame) -> DataFrame:
    """Failure events of runs that did not start, with the ``reason`` each is logged with."""
    return runs.select(
        "log_kind", *CANDIDATE_KEY, "ictrl_dt", F.lit(schemas.FAILED).alias("status"),
        F.lit("00:00:00").alias("duration"),
        *[F.lit(0).cast("bigint").alias(c) for c in ("source_cnt", "process_cnt", "row_cnt")],
        F.col("reason").alias("err_msg"), F.col("round_time").alias("event_time"),
    )
