"""Are the prerequisites there? One plan for every dependency and reference date.

The audit log and the data tables may be huge, the checks are not. So the log shrinks
first to one fact row per (job, table, label), combined map-side, and only missing labels
travel to the verdict. What the checks ask for, by source and label pattern, filters the log
and the raw tables before that. Nothing is hinted: Spark broadcasts a side below its size
threshold and splits skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import frequency as freq
from tidemark.functions import labels
from tidemark.operators import expected as exp
from tidemark.operators import raw_dates
from tidemark.operators.workflow import worst_days
from tidemark.session import materialize, spread

CHECK_KEY = ["dep_id", "ref_ts"]
# Fixed value: the Spark pattern whose beginnings sort as text like they do as time.
TIME_DIGITS = "yyyyMMddHHmmssSSSSSS"
# Sorts after every character a label may go on with.
_AFTER = "~"
# By (schema, table, column); a table given by its name in the catalog is read as little as can be.
RawTables = Mapping[tuple[str, str, str], DataFrame | str]
SOURCE_KEY = ["route", "job_key", "schema_nm", "table_nm"]
FACT_KEY = [*SOURCE_KEY, "match_len", "label"]


# --- inputs ------------------------------------------------------------------------


def dependency_fanout(jobs: DataFrame, dependencies: DataFrame) -> DataFrame:
    """Jobs (or planned runs) with each of their active dependencies."""
    active = dependencies.filter(F.upper("active_flag") == "Y").select(
        "job_nm", "dep_id", "prerequisite_job_nm", "prerequisite_schema_nm",
        "prerequisite_table_nm", "frequency_check", "value", "empty_flag", "data_column",
        F.col("ictrl_dt_tgtfmt").alias("pattern"),
        # converted here, on the small table, not once per check
        F.expr(labels.spark_pattern("ictrl_dt_tgtfmt")).alias("label_pattern"),
    )
    return jobs.join(active, "job_nm")


def checks_for_runs(runs: DataFrame, dependencies: DataFrame) -> DataFrame:
    """Checks of planned runs: the run's date is the reference, its loop the window."""
    ingest = F.col("job_type").isin(*schemas.INGEST_TYPES)
    planned = runs.select(
        "job_nm", F.when(ingest, "ingest").otherwise("transform").alias("consumer"),
        "frequency", "back_day",
        F.expr(labels.spark_pattern(labels.pattern_or_default("ictrl_dt_tgtfmt")))
        .alias("job_label_pattern"),
        F.col("loop_ts").alias("start_ts"), F.col("run_ts").alias("ref_ts"),
    )
    return dependency_fanout(planned, dependencies)


def prerequisite_names(dependencies: DataFrame) -> DataFrame:
    """A list of job names, one row per usable name, upper-cased."""
    name = F.trim(F.col("name"))
    return (
        dependencies.withColumn("name", F.explode(F.split("prerequisite_job_nm", ",")))
        .withColumn("name", F.upper(name))
        .filter((F.col("name") != "") & (F.col("name") != "NONE"))
    )


# A time and a hash in one number: 18 digits of microseconds from the year 1 on, 20 of the hash.
_FIRST_MICROS, _LAST_MICROS, _HASHES, _HASH_UNIT = 63 * 10**15, 10**18 - 1, 2**64 - 1, 10**20


def newest_by_hash(log: DataFrame, succeeded: Sequence[str]) -> DataFrame:
    """One row per logged (job, table, label), by aggregates that hold numbers only, so nothing is sorted for them.

    Rows are ordered by start and, among those of one start, by a hash of round and run id; both ends of that order
    are kept, so ``tied`` tells whether the newest start is more than one run's.
    """
    rows = F.when(F.col("status").isin(*succeeded), F.coalesce("row_cnt", F.lit(0)))
    micros = F.unix_micros(F.col("job_start_time").cast("timestamp"))
    at = F.least(F.greatest(F.coalesce(micros, F.lit(-_FIRST_MICROS)) + _FIRST_MICROS, F.lit(0)), F.lit(_LAST_MICROS))
    at = at.cast("decimal(18,0)") * F.lit(Decimal(_HASH_UNIT))
    run = F.xxhash64("round_time", "dag_run_id").cast("decimal(20,0)") + F.lit(Decimal(2**63))
    high, low = at + run, at + (F.lit(Decimal(_HASHES)) - run)
    return (
        log.filter(F.col("ictrl_dt").isNotNull())
        .groupBy(
            F.col("log_kind").alias("route"), F.upper("job_nm").alias("job_key"),
            "schema_nm", "table_nm", F.col("ictrl_dt").alias("label"),
        )
        .agg(
            F.max(rows).alias("best_rows"), F.max_by(rows, high).alias("latest_rows"),
            F.max("job_start_time").alias("latest_start"), F.max_by("round_time", high).alias("latest_round"),
            F.max(high).alias("_high"), F.max(low).alias("_low"),
        )
        .withColumn("tied", F.expr(f"cast(_high % {_HASH_UNIT} + _low % {_HASH_UNIT} AS decimal(21,0)) <> {_HASHES}"))
        .drop("_high", "_low")
    )


def _untied(log: DataFrame, tied: DataFrame, succeeded: Sequence[str]) -> DataFrame:
    """Facts whose newest start is several runs': the newest of those by round, then run id."""
    key = ["route", "job_key", "schema_nm", "table_nm", "label"]
    rows = F.when(F.col("status").isin(*succeeded), F.coalesce("row_cnt", F.lit(0)))
    named = log.select(
        F.col("log_kind").alias("route"), F.upper("job_nm").alias("job_key"), "schema_nm", "table_nm",
        F.col("ictrl_dt").alias("label"), F.col("job_start_time").alias("latest_start"),
        F.struct("round_time", F.col("dag_run_id"), rows.alias("rows")).alias("run"),
    )
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"t.{c}")) for c in [*key, "latest_start"]]
    newest = named.alias("l").join(tied.alias("t"), same).groupBy(
        *[F.col(f"t.{c}").alias(c) for c in [*key, "best_rows", "latest_start"]]).agg(F.max("l.run").alias("run"))
    return newest.select(*key, "best_rows", F.col("run.rows").alias("latest_rows"), "latest_start", F.col("run.round_time").alias("latest_round"))


def log_facts(log: DataFrame, succeeded: Sequence[str] = schemas.SUCCEEDED, raw: DataFrame | None = None) -> DataFrame:
    """One written row per logged (job, table, label), and those of ``raw_facts``, if given.

    ``best_rows`` is the largest row count of any success, ``latest_rows`` that of the
    newest run when it succeeded; both are null otherwise, and a null count is 0. The newest run is that of the last
    start, then round, then run id. The log is read once; a second time only for labels whose last start several
    runs share, and then only those rows go on.
    """
    found = newest_by_hash(log, succeeded).withColumn("match_len", F.lit(0))
    if raw is not None:
        found = found.unionByName(raw.withColumn("tied", F.lit(False)))
    found = materialize(found, "facts")
    tied = found.filter("tied").drop("tied")
    facts = found.filter("NOT tied").drop("tied")
    if not tied.isEmpty():
        untied = _untied(log, tied, succeeded).withColumn("match_len", F.lit(0))
        facts = facts.unionByName(materialize(untied, "untied-facts"))
    return facts


def raw_facts(dates: DataFrame) -> DataFrame:
    """Distinct business dates (``schema_nm, table_nm, data_column, label``) as facts."""
    return dates.select(
        F.lit("raw").alias("route"), F.col("data_column").alias("job_key"),
        "schema_nm", "table_nm", "label", F.lit(None).cast("bigint").alias("best_rows"),
        F.lit(None).cast("bigint").alias("latest_rows"),
        *[F.lit(None).cast("timestamp_ntz").alias(c) for c in ("latest_start", "latest_round")],
        F.lit(0).alias("match_len"),
    )


def prepare(checks: DataFrame) -> DataFrame:
    """Checks with their window and where to look; one narrow row per check.

    A named business column sends a check to the raw table, anything else to the logs.
    Transform jobs look in the transform log and fall back to the ingest log; ingest
    jobs look in the ingest log only and treat the column ``None`` as absent. A daily
    ingest check without a job name asks the external workflows that write the table.
    """
    ingest = F.col("consumer") == "ingest"
    uses_raw = F.col("data_column").isNotNull() & ~(ingest & (F.col("data_column") == "None"))
    table = F.when(ingest, F.split("prerequisite_table_nm", " ")[0]).otherwise(
        F.col("prerequisite_table_nm")
    )
    nameless = F.lower(F.coalesce("prerequisite_job_nm", F.lit(""))).isin("", "none")
    by_workflow = ingest & ~uses_raw & nameless & (F.col("frequency_check") == "daily")
    windows = exp.window_columns()
    windows["family"] = F.when(by_workflow, "newest").otherwise(windows["family"])
    routes = (
        F.when(uses_raw, F.array(F.lit("raw")))
        .when(by_workflow, F.array(F.lit("workflow")))
        .when(ingest, F.array(F.lit("ingest")))
        .otherwise(F.array(F.lit("trans"), F.lit("ingest")))
    )
    return spread(checks, *CHECK_KEY).select(
        *CHECK_KEY, "job_nm", "prerequisite_job_nm", "label_pattern", "empty_flag",
        routes.alias("routes"),
        F.when(uses_raw, F.col("data_column")).otherwise(F.upper("prerequisite_job_nm"))
        .alias("job_key"),
        F.col("prerequisite_schema_nm").alias("schema_nm"), table.alias("table_nm"),
        (ingest & ~uses_raw & F.col("frequency_check").isin("daily", "hourly"))
        .alias("by_prefix"),
        *[column.alias(name) for name, column in windows.items()],
    )


# --- what of the log matters ------------------------------------------------------------


@dataclass(frozen=True)
class Relevance:
    """Which log rows and business dates the checks can ask for.

    ``asked`` holds, per source and label pattern, the first and last label; null where the
    pattern's labels do not sort by time, or where the end is open. ``patterns`` holds the
    same per pattern alone, for the scan; None when some pattern has no range.
    """

    asked: DataFrame
    patterns: list[tuple[str, str | None]] | None

    def _log_range(self, label: str) -> Column:
        if self.patterns is None:
            return F.lit(True)
        spans = [
            (F.col(label) >= low) & (F.lit(True) if high is None else F.col(label) <= high)
            for low, high in self.patterns
        ]
        return reduce(Column.__or__, spans, F.lit(False))

    def of_log(self, log: DataFrame, listed: DataFrame | None = None) -> DataFrame:
        """``listed``: the labels (``ictrl_dt``) that a log partitioned by label has.

        Which of them some check asks for is found on the list; the log then meets those by equality, so that only
        their partitions are read.
        """
        asked = self.asked.filter("NOT is_raw").alias("a")
        if listed is not None:
            within = [F.col("a.low").isNull() | (F.col("l.ictrl_dt") >= F.col("a.low")),
                      F.col("a.high").isNull() | (F.col("l.ictrl_dt") <= F.col("a.high"))]
            # a short list and one row a source and pattern; the least label is a bound the join can push down
            wanted = listed.filter("ictrl_dt > ''").alias("l").join(asked, reduce(Column.__and__, within), "left_semi")
            log = log.join(materialize(wanted, "labels").filter("ictrl_dt > ''"), "ictrl_dt", "left_semi")
        match = [
            F.upper("l.job_nm") == F.col("a.job_key"),
            F.col("l.schema_nm") == F.col("a.schema_nm"),
            F.col("l.table_nm") == F.col("a.table_nm"),
            F.col("a.low").isNull() | (F.col("l.ictrl_dt") >= F.col("a.low")),
            F.col("a.high").isNull() | (F.col("l.ictrl_dt") <= F.col("a.high")),
        ]
        return log.filter(self._log_range("ictrl_dt")).alias("l").join(asked, match, "left_semi")

    def of_raw(self, dates: DataFrame | RawTables) -> DataFrame | None:
        """Business dates of the tables that some check names; the others are not read.

        Of a table given as such, only the column and the range asked for are read; the
        driver sees the few ranges of the tables it was given.
        """
        asked = self.asked.filter("is_raw")
        if isinstance(dates, DataFrame):
            match = [
                F.col("d.schema_nm") == F.col("a.schema_nm"), F.col("d.table_nm") == F.col("a.table_nm"),
                F.col("d.data_column") == F.col("a.job_key"),
                F.col("a.low").isNull() | (F.col("d.label") >= F.col("a.low")),
                F.col("a.high").isNull() | (F.col("d.label") <= F.col("a.high")),
            ]
            return dates.alias("d").join(asked.alias("a"), match, "left_semi")
        named = F.concat_ws("\x00", "schema_nm", "table_nm", "job_key").isin(["\x00".join(k) for k in dates])
        spans: dict[tuple[str, str, str], list[tuple[str | None, str | None]]] = {}
        found = asked.filter(named).select(
            "schema_nm", "table_nm", "job_key", "low", "high", "label_pattern", "newest_only", "by_time").distinct().collect()
        for row in found:
            spans.setdefault((row["schema_nm"], row["table_nm"], row["job_key"]), []).append((row["low"], row["high"]))
        if not spans:
            return None
        spark, tables, newest = self.asked.sparkSession, {}, []
        for key in spans:
            rows = [r for r in found if (r["schema_nm"], r["table_nm"], r["job_key"]) == key]
            if isinstance(dates[key], str):
                if all(r["newest_only"] and r["by_time"] for r in rows):
                    label = raw_dates.newest_label(spark, dates[key], key[2], [r["label_pattern"] for r in rows])
                    if label is not None:
                        newest.append((*key, label))
                        continue
                tables[key] = raw_dates.business_dates(spark, dates[key], key[2])
            else:
                tables[key] = dates[key]
        told = spark.createDataFrame(newest, "schema_nm string, table_nm string, data_column string, label string")
        return raw_dates.observed_dates(tables, spans).unionByName(told) if tables else told


def relevance(prepared: DataFrame) -> Relevance:
    """Worked out in one small aggregation over the checks.

    Where labels run from the year down they compare as text like time does, whatever stands
    between the units, so only the labels from the first to the last asked for matter. A
    check for the newest date leaves the end open.
    """
    first = f"coalesce({freq.shift('low_ts', '-step_minutes * reach', '-step_months * reach')}, low_ts)"
    last = f"coalesce({freq.shift('high_ts', 'step_minutes * reach', 'step_months * reach')}, high_ts)"
    units = F.regexp_replace("label_pattern", "[^A-Za-z]", "")
    by_time = F.lit(TIME_DIGITS).startswith(units) & (units != "")
    spans = (
        prepared.filter(f"({exp.WINDOW_PROBLEM}) IS NULL")
        .select("job_key", "schema_nm", "table_nm", "label_pattern", "family", "by_prefix",
                F.array_contains("routes", "raw").alias("is_raw"),
                F.expr(f"struct({first} AS first_ts, {last} AS last_ts)").alias("span"))
        .groupBy("job_key", "schema_nm", "table_nm", "label_pattern", "is_raw")
        .agg(F.min("span.first_ts").alias("first_ts"), F.max("span.last_ts").alias("last_ts"),
             F.bool_or(F.col("family") == "newest").alias("open_end"),
             F.bool_and(F.col("family") == "newest").alias("newest_only"),
             F.bool_or("by_prefix").alias("by_prefix"))
    )
    low = F.expr(labels.write("first_ts", "label_pattern"))
    high = F.concat(F.expr(labels.write("last_ts", "label_pattern")), F.when(F.col("by_prefix"), _AFTER).otherwise(""))
    asked = materialize(spans.select(
        "job_key", "schema_nm", "table_nm", "label_pattern", "is_raw", "open_end", "newest_only", by_time.alias("by_time"),
        F.when(by_time, low).alias("low"), F.when(by_time & ~F.col("open_end"), high).alias("high"),
    ), "asked")
    found = asked.filter("NOT is_raw").groupBy("label_pattern").agg(
        F.bool_and("by_time").alias("by_time"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.bool_or("open_end").alias("open_end"),
    ).collect()  # one row per pattern in use
    if not all(row["by_time"] for row in found):
        return Relevance(asked, None)
    return Relevance(asked, [(r["low"], None if r["open_end"] else r["high"]) for r in found])


# --- expected against observed -------------------------------------------------------


def expected_labels(prepared: DataFrame) -> DataFrame:
    """One row per distinct label a usable check needs on each of its routes.

    A pattern coarser than the steps of the window names several dates alike; there the
    labels are written and made distinct before they become rows.
    """
    dates = F.expr(f"""CASE WHEN ({exp.WINDOW_PROBLEM}) IS NULL AND family <> 'newest'
        THEN {exp.expected_dates()} END""")
    fine = """contains(label_pattern, 'yyyy') AND contains(label_pattern, 'MM') AND contains(label_pattern, 'dd')
        AND (contains(label_pattern, 'HH') OR step_minutes >= 1440 OR step_months >= 1)
        AND (contains(label_pattern, 'mm') OR step_minutes >= 60 OR step_months >= 1)"""
    wanted = F.expr(f"""CASE WHEN {fine} THEN transform(_dates, d -> struct(d, cast(null AS string) AS label))
        ELSE transform(array_distinct(transform(_dates, d -> {labels.write("d", "label_pattern")})),
                       label -> struct(cast(null AS timestamp_ntz) AS d, label)) END""")
    return (
        prepared.withColumn("_dates", dates).filter(F.col("_dates").isNotNull())
        .select(*CHECK_KEY, "job_key", "schema_nm", "table_nm", "label_pattern",
                "family", "empty_flag", "required", "by_prefix", "routes",
                F.explode(wanted).alias("_wanted"))
        .select(*CHECK_KEY, "job_key", "schema_nm", "table_nm", "family", "empty_flag",
                "required", "by_prefix", F.explode("routes").alias("route"),
                F.coalesce("_wanted.label", F.expr(labels.write("_wanted.d", "label_pattern"))).alias("label"))
        .filter(F.col("label").isNotNull())
        .withColumn("match_len", F.when(F.col("by_prefix"), F.length("label")).otherwise(0))
        .drop("by_prefix")
    )


def prefix_facts(facts: DataFrame, checks: DataFrame) -> DataFrame:
    """Facts cut to the label lengths that prefix checks ask for, so the match is equal.

    ``label LIKE 'x%'`` becomes an equality on the first characters; the newest run and
    best row count of all labels sharing the prefix are combined from the facts. Of runs of one start and
    round the later label's counts.
    """
    # such checks expect one date each, so its label tells the length without expanding windows
    lengths = (
        checks.filter(f"by_prefix AND ({exp.WINDOW_PROBLEM}) IS NULL AND family <> 'newest'")
        .select("job_key", "schema_nm", "table_nm", F.explode("routes").alias("route"),
                F.length(F.expr(labels.write("low_ts", "label_pattern"))).alias("match_len"))
        .distinct()
    )
    return (
        facts.filter(F.col("route") == "ingest").drop("match_len").join(lengths, SOURCE_KEY)
        .filter(F.length("label") >= F.col("match_len"))
        .withColumn("_run", F.struct("latest_start", "latest_round", "label", "latest_rows"))
        .withColumn("label", F.expr("substring(label, 1, match_len)"))
        .groupBy(*FACT_KEY)
        .agg(F.max("best_rows").alias("best_rows"), F.max("_run").alias("_run"))
        .select(*FACT_KEY, "best_rows", "_run.latest_rows", "_run.latest_start", "_run.latest_round")
    )


def _is_enough() -> Column:
    """Does the observed fact satisfy the expected label it was matched to?

    A tolerant check that requires no label at all still needs one logged run, so for it
    any fact counts.
    """
    return (
        F.when(F.col("e.route") == "raw", True)
        .when(F.col("e.required") <= 0, True)
        .when(F.col("e.family") == "single", F.col("o.latest_rows") >= F.col("e.empty_flag"))
        .otherwise(F.col("o.best_rows") >= F.col("e.empty_flag"))
    )


def missing_labels(expected: DataFrame, facts: DataFrame) -> DataFrame:
    """Expected labels without a fact that satisfies them (an anti join)."""
    matched = [F.col(f"e.{k}") == F.col(f"o.{k}") for k in FACT_KEY]
    return expected.alias("e").join(
        facts.alias("o"), [*matched, F.coalesce(_is_enough(), F.lit(False))], "left_anti"
    )


def _log_and_labels(spark: SparkSession, log: DataFrame | str) -> tuple[DataFrame, DataFrame | None]:
    """The log, and the labels the catalog lists of one given by its name and partitioned by them."""
    if not isinstance(log, str):
        return log, None
    listed = raw_dates.listed_dates(spark, log, "ictrl_dt") if raw_dates.is_partitioned_by(spark, log, "ictrl_dt") else None
    return spark.table(log), listed


def looked_up(checks: DataFrame, log: DataFrame | str) -> DataFrame:
    """``log_lookup`` of what the checks ask, from the part of the log they ask about."""
    prepared = materialize(prepare(checks), "checks")
    rows = relevance(prepared).of_log(*_log_and_labels(checks.sparkSession, log))
    return log_lookup(expected_labels(prepared), log_facts(rows))


def log_lookup(expected: DataFrame, facts: DataFrame) -> DataFrame:
    """Each expected label with what the logs know of it; nulls where they know nothing."""
    return expected.join(facts.select(*FACT_KEY, "best_rows", "latest_rows"), FACT_KEY, "left")


def newest_succeeded(checks: DataFrame, facts: DataFrame) -> DataFrame:
    """Per dependency and route, the newest observed date with enough rows.

    Found once per source, pattern and flag, and only then handed to the dependencies: a
    table that many of them ask about is not repeated for each.
    """
    question = [*SOURCE_KEY, "label_pattern", "empty_flag"]
    wanted = (
        checks.filter(f"family = 'newest' AND ({exp.WINDOW_PROBLEM}) IS NULL")
        .select("dep_id", "job_key", "schema_nm", "table_nm", "label_pattern", "empty_flag",
                F.explode("routes").alias("route"))
        .distinct()
    )
    enough = (F.col("route") == "raw") | (F.col("best_rows") >= F.col("empty_flag"))
    newest = (
        facts.filter(F.col("match_len") == 0).join(wanted.select(*question).distinct(), SOURCE_KEY)
        .filter(F.coalesce(enough, F.lit(False)))
        .groupBy(*question)
        .agg(F.max(F.expr(labels.read("label", "label_pattern"))).alias("newest_ts"))
    )
    same = [F.col(f"w.{c}").eqNullSafe(F.col(f"n.{c}")) for c in question]
    return (
        wanted.alias("w").join(newest.alias("n"), same)
        .groupBy("w.dep_id", "w.route").agg(F.max("newest_ts").alias("newest_ts"))
    )


def newest_workflow_day(prepared: DataFrame, completions: DataFrame) -> DataFrame:
    """Per dependency on external workflows, the day its slowest workflow last succeeded."""
    wanted = prepared.filter("array_contains(routes, 'workflow')").select(
        "dep_id", "schema_nm", "table_nm", F.lit(None).cast("array<string>").alias("names")
    ).distinct()
    return worst_days(wanted, completions).select(
        "dep_id", F.lit("workflow").alias("route"),
        F.col("worst_day").cast("timestamp_ntz").alias("newest_ts"),
    )


# --- verdicts ---------------------------------------------------------------------------


def _allowed() -> Column:
    """How many labels may be missing; a check requiring none still needs one run."""
    return F.when(
        F.col("family") == "tolerant",
        exp.HOURS_PER_DAY - F.greatest(F.col("required"), F.lit(1)),
    ).otherwise(0)


def route_verdicts(checks: DataFrame, missing: DataFrame, newest: DataFrame) -> DataFrame:
    """One verdict per check and route."""
    per_route = missing.groupBy(*CHECK_KEY, "route").agg(
        F.sort_array(F.collect_set("label")).alias("missing")
    )
    none = F.array().cast("array<string>")
    is_newest = F.col("family") == "newest"
    # a workflow finishes on a day, so only the day of the reference date counts there
    wanted_ts = F.when(
        F.col("route") == "workflow", F.to_date("ref_ts").cast("timestamp_ntz")
    ).otherwise(F.col("ref_ts"))
    reached = F.coalesce(F.col("newest_ts") >= wanted_ts, F.lit(False))
    own_label = F.expr(f"array({labels.write('ref_ts', 'label_pattern')})")
    return (
        checks.select(*CHECK_KEY, "job_nm", "prerequisite_job_nm", "family", "label_pattern",
                      "required", F.expr(exp.WINDOW_PROBLEM).alias("problem"),
                      F.posexplode("routes").alias("route_no", "route"))
        .join(per_route, [*CHECK_KEY, "route"], "left")
        .join(newest, ["dep_id", "route"], "left")
        .withColumn("missing", F.when(is_newest, F.when(reached, none).otherwise(own_label))
                    .otherwise(F.coalesce("missing", none)))
        .withColumn("ready", F.col("problem").isNull() & (F.size("missing") <= _allowed()))
        .withColumn("missing", F.when(F.col("ready") | F.col("problem").isNotNull(), none)
                    .otherwise(F.col("missing")))
        .select(*CHECK_KEY, "job_nm", "prerequisite_job_nm", "route", "route_no", "ready",
                "missing", "problem")
    )


def fold_routes(verdicts: DataFrame) -> DataFrame:
    """A check is ready when any of its logs is; else the last log tells what is missing."""
    return (
        verdicts.groupBy(*CHECK_KEY, "job_nm", "prerequisite_job_nm")
        .agg(
            F.bool_or("ready").alias("ready"),
            F.max_by("missing", "route_no").alias("_last_missing"),
            F.max("problem").alias("problem"),
        )
        .select(
            *CHECK_KEY, "job_nm", "prerequisite_job_nm", "ready",
            F.when(F.col("ready"), F.array().cast("array<string>"))
            .otherwise(F.col("_last_missing")).alias("missing"),
            F.when(~F.col("ready"), F.coalesce("problem", F.lit("missing"))).alias("reason"),
        )
    )


def readiness(
    checks: DataFrame, log: DataFrame | str, raw: DataFrame | RawTables | None = None,
    completions: DataFrame | None = None, succeeded: Sequence[str] = schemas.SUCCEEDED,
) -> DataFrame:
    """Verdict per check: ``ready``, sorted ``missing`` labels and a ``reason``.

    The log and the raw tables are read once, into a small written table of facts, and
    the window of each check is worked out once, into a narrow written table. ``log``: the rows, or the name of
    a table, which is best partitioned by ``ictrl_dt``: then only partitions asked for are read. ``raw``:
    tables by (schema, table, column), of which only those asked for are read, or business
    dates (``raw_dates.observed_dates``); ``completions``: external workflows
    (``workflow.last_completions``).
    """
    return fold_routes(verdicts_by_route(checks, log, raw, completions, succeeded))


def verdicts_by_route(
    checks: DataFrame, log: DataFrame | str, raw: DataFrame | RawTables | None = None,
    completions: DataFrame | None = None, succeeded: Sequence[str] = schemas.SUCCEEDED,
) -> DataFrame:
    """Readiness before the fallback from one log to the next is applied."""
    prepared = materialize(prepare(checks), "checks")
    relevant = relevance(prepared)
    dates = None if raw is None else relevant.of_raw(raw)
    asked = relevant.of_log(*_log_and_labels(checks.sparkSession, log))
    facts = log_facts(asked, succeeded, None if dates is None else raw_facts(dates))
    needed = expected_labels(prepared)
    missing = missing_labels(needed, facts.unionByName(prefix_facts(facts, prepared)))
    newest = newest_succeeded(prepared, facts)
    if completions is not None:
        newest = newest.unionByName(newest_workflow_day(prepared, completions))
    return route_verdicts(prepared, missing, newest)


def job_rollup(runs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """A run is ready when all its checks are; a run without checks is ready.

    ``runs`` holds ``job_nm`` and ``ref_ts``; ``verdicts`` also the prerequisite name.
    """
    per_run = verdicts.groupBy("job_nm", "ref_ts").agg(
        F.bool_and("ready").alias("ready"),
        F.sort_array(F.collect_set(F.when(~F.col("ready"), F.col("prerequisite_job_nm"))))
        .alias("not_ready"),
    )
    return runs.join(per_run, ["job_nm", "ref_ts"], "left").select(
        *runs.columns,
        F.coalesce("ready", F.lit(True)).alias("ready"),
        F.coalesce("not_ready", F.array().cast("array<string>")).alias("not_ready"),
    )
