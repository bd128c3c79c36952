"""Table maintenance: archiving with proof before removal, repartitioning, recompression; and the run loop."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from threading import Lock, Timer

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stallwatch.operators.lake import days_available, days_of, differing_days, merge_days, read_days, replace_days, row_digests
from stallwatch.sources.shared import remove


def archive_days(hot: DataFrame, root: str, staging: str, id_col: str, as_of: str, keep_days: int, day: str = "snapshot_date", dry_run: bool = False, context: DataFrame | None = None, context_keys: list[str] = ()) -> DataFrame:
    """Moves rows older than keep_days to their day partitions; returns the hot rows that stay.

    A day's rows leave the hot tier only if the archive, read again, holds that day just as it was merged, by the digest of its rows; rows of
    other days stay. Rows without a day stay. context: what is archived along with each row, such as its product's name and category, by
    context_keys, one row per key; rows without context are archived with nulls.
    """
    old = hot.where(F.col(day) < F.date_sub(F.lit(as_of).cast("date"), keep_days))
    if dry_run or old.isEmpty():
        return hot
    rich = old if context is None else old.join(context, list(context_keys), "left")
    proven = merge_days(rich, root, id_col, staging, day)
    gone = (F.col(day) < F.date_sub(F.lit(as_of).cast("date"), keep_days)) & F.col(day).isin(proven)
    return hot.where(~F.coalesce(gone, F.lit(False)))


def archive_results(df: DataFrame, root: str, as_of: str, keep_days: int, unique_on: list[str] | None = None, day: str = "snapshot_date") -> DataFrame:
    """Archives whole days of a result table. Tables whose rows carry the event's own day are merged on unique_on,
    as later runs rewrite earlier days; others overwrite the day. Returns the rows that stay, once the archive, read
    again for these days, holds just the rows that were to be written; raises if it does not."""
    old = df.where(F.col(day) < F.date_sub(F.lit(as_of).cast("date"), keep_days))
    days = days_of(old, day)
    if not days:
        return df
    spark = df.sparkSession
    if unique_on:
        short = set(days) - set(merge_days(old, root, unique_on, f"{root}__staged", day))
    else:
        replace_days(old, root, day)
        have = read_days(spark, root, days, day)
        short = days if have is None else differing_days(old, have, day)
    if short:
        raise RuntimeError(f"the archive of {len(short)} days is not whole")
    return df.where(F.col(day).isNull() | (F.col(day) >= F.date_sub(F.lit(as_of).cast("date"), keep_days)))


def repartition_by_day(source: DataFrame, root: str, id_cols: list[str] | None, day: str = "snapshot_date", legacy: list[str] = ()) -> int:
    """Files of several days become one partition per day, without repeats: by ids, or by whole rows. Returns the number of rows.

    Every day is proven by the digest of its rows before the files named in ``legacy`` are removed.
    """
    spark = source.sparkSession
    rows = source.dropDuplicates(id_cols) if id_cols else source.dropDuplicates()
    staging = f"{root.rstrip('/')}__staged"
    rows.write.mode("overwrite").parquet(staging)  # which of the repeats stays is settled here
    rows = spark.read.parquet(staging)
    days = days_of(rows, day)
    if not days:
        return 0
    replace_days(rows, root, day)
    have = read_days(spark, root, days, day)
    bad = days if have is None else differing_days(rows, have, day)
    if bad:
        raise RuntimeError(f"{len(bad)} days of {root} do not hold what was written")
    for path in legacy:
        remove(spark, path)
    return rows.count()


def recompress(spark: SparkSession, source: str, target: str, codec: str = "snappy", day: str | None = None) -> int:
    """Writes a table anew under another codec, as a table of days if ``day`` is named; returns the number of rows.

    The rows are digested as they pass and read again from the new files; raises if the digests differ. The source stays. An empty table gives an empty one.
    """
    rows = spark.read.parquet(source)
    digests, passed = row_digests(rows.columns, dict(rows.dtypes)), Observation()
    out = rows.repartition(day) if day else rows
    writer = out.observe(passed, *digests).write.mode("overwrite").option("compression", codec)
    (writer.partitionBy(day) if day else writer).parquet(target)
    have = spark.read.schema(rows.schema).parquet(target).agg(*digests).first().asDict()
    if have != passed.get:
        raise RuntimeError(f"{target} does not hold the rows of {source}")
    return have["n_rows"]


@dataclass
class Signal:
    """A registered signal: what to build, what it needs, and where its rows go."""

    signal_id: str
    build: Callable[[], DataFrame]
    min_days: int = 1
    enabled: bool = True
    blocked_by: list[str] = field(default_factory=list)
    requires: list[str] = field(default_factory=list)
    suppressed: Callable[[], DataFrame] | None = None


def runnable(signals: list[Signal]) -> list[Signal]:
    return [s for s in signals if s.enabled and not s.blocked_by]


def good_runs(spark: SparkSession, logs: list[str], run_day: date) -> set[str]:
    """Signals with a good run on a day, by the logs that exist."""
    found: set[str] = set()
    for log in logs:
        try:
            runs = spark.read.parquet(log)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            found |= {r[0] for r in runs.where((F.col("status") == "ok") & (F.to_date("run_at") == F.lit(run_day))).select("signal_id").distinct().collect()}  # one per registered signal
    return found


def run_waves(signals: list[Signal]) -> list[list[Signal]]:
    """Signals in waves: each stands in a wave after those that it requires. Raises if some require one another in a ring."""
    own, waves, placed = {s.signal_id for s in signals}, [], set()
    left = list(signals)
    while left:
        wave = [s for s in left if all(r in placed or r not in own for r in s.requires)]
        if not wave:
            raise ValueError("signals require one another: " + ", ".join(s.signal_id for s in left))
        waves.append(wave)
        placed |= {s.signal_id for s in wave}
        left = [s for s in left if s.signal_id not in placed]
    return waves


def _run_signal(spark: SparkSession, s: Signal, root: str, day: str, tag: str) -> tuple[int, int | None]:
    """Builds and writes one signal under a job tag and in a pool of its own: (rows written, rows held back)."""
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", s.signal_id)
    spark.sparkContext.addJobTag(tag)
    try:
        frame, seen, written = s.build(), Observation(), 0
        if day not in frame.columns or not frame.isEmpty():  # an empty plan leaves nothing to observe
            replace_days(frame.observe(seen, F.count(F.lit(1)).alias("n")), f"{root}/{s.signal_id}", day)
            written = seen.get["n"]
        return written, s.suppressed().first()[0] if s.suppressed else None
    finally:
        spark.sparkContext.removeJobTag(tag)
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)


def run_signals(spark: SparkSession, signals: list[Signal], snapshots: DataFrame, root: str, log: str, day: str = "snapshot_date", gates: list[str] | None = None, at_once: int = 4, time_limit: float | None = None) -> DataFrame:
    """Runs signals in waves by what they require and logs each, also when it writes nothing; one that fails stops no other.

    A signal is skipped with a reason if it is off, blocked, short of days, or a requirement has no good run: in this
    call, or today by the run logs named in ``gates`` (products wait for the day's signals so). rows_written counts the
    rows of this run. Raises only if all that ran failed.

    Up to ``at_once`` signals of a wave run side by side, each in its own pool (which share fairly where spark.scheduler.mode is FAIR)
    and under its own job tag: one that takes longer than ``time_limit`` seconds has its jobs cancelled and counts as failed.
    """
    days, context = days_available(snapshots), spark.sparkContext
    good = good_runs(spark, gates or [], datetime.now(timezone.utc).date())
    rows: dict[str, tuple] = {}
    failed, ran = 0, 0

    def why_not(s: Signal) -> str | None:
        if not s.enabled:
            return "disabled"
        if s.blocked_by:
            return "blocked by " + ", ".join(s.blocked_by)
        if days < s.min_days:
            return f"{days} of {s.min_days} days"
        missing = [r for r in s.requires if r not in good]
        return "needs " + ", ".join(missing) if missing else None

    for wave in run_waves(signals):
        ready = []
        for s in wave:
            reason = why_not(s)
            if reason:
                rows[s.signal_id] = (s.signal_id, "skipped", reason, 0, None, datetime.now(timezone.utc))
            else:
                ready.append(s)
        pool, lock, begun = ThreadPoolExecutor(at_once), Lock(), {}

        def run(s: Signal, tag: str) -> tuple[int, int | None]:
            timer = Timer(time_limit, context.cancelJobsWithTag, [tag]) if time_limit else None
            with lock:
                begun[s.signal_id] = datetime.now(timezone.utc)
            if timer:
                timer.start()
            try:
                return _run_signal(spark, s, root, day, tag)
            finally:
                if timer:
                    timer.cancel()

        waiting = {s.signal_id: pool.submit(inheritable_thread_target(spark)(run), s, f"{s.signal_id}-{uuid.uuid4().hex}") for s in ready}
        for s in ready:
            try:
                written, held = waiting[s.signal_id].result()
                rows[s.signal_id] = (s.signal_id, "ok", None, written, held, datetime.now(timezone.utc))
                good.add(s.signal_id)
                ran += 1
            except Exception as e:
                late = time_limit and (datetime.now(timezone.utc) - begun[s.signal_id]).total_seconds() >= time_limit and "cancel" in str(e).lower()
                rows[s.signal_id] = (s.signal_id, "failed", f"cancelled after {time_limit} s" if late else str(e)[:500], 0, None, datetime.now(timezone.utc))
                failed += 1
        pool.shutdown()
    runs = spark.createDataFrame([rows[s.signal_id] for s in signals], "signal_id string, status string, reason string, rows_written long, suppressed long, run_at timestamp")
    runs.write.mode("append").parquet(log)
    if failed and not ran:
        raise RuntimeError("all signals failed")
    return runs


def markdown_table(df: DataFrame) -> DataFrame:
    """A frame as lines of a Markdown table: (line, value), the head first. Bars and line ends inside values are kept as text; nulls are empty."""

    def cell(c: str) -> Column:
        text = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
        return F.regexp_replace(F.regexp_replace(text, r"\|", r"\\|"), r"\r?\n", "<br>")

    head = [f"| {' | '.join(c.replace('|', chr(92) + '|') for c in df.columns)} |", f"|{' --- |' * len(df.columns)}"]
    rows = df.select((F.monotonically_increasing_id() + 2).alias("line"), F.concat(F.lit("| "), F.concat_ws(" | ", *map(cell, df.columns)), F.lit(" |")).alias("value"))
    return df.sparkSession.createDataFrame(list(enumerate(head)), "line long, value string").unionByName(rows)


def write_report(df: DataFrame, root: str, run: str, formats: tuple[str, ...] = ("csv", "json", "md")) -> None:
    """A report's frame as one file per format in the run's folder, and again under latest/. Reports are small; the frame is made once.

    md is a Markdown table."""
    rows = df.coalesce(1).persist()
    for kind in formats:
        for place in (run, "latest"):
            if kind == "md":
                markdown_table(rows).coalesce(1).sortWithinPartitions("line").select("value").write.mode("overwrite").text(f"{root}/{place}/md")
            else:
                rows.write.mode("overwrite").option("header", True).option("escape", '"').format(kind).save(f"{root}/{place}/{kind}")
    rows.unpersist()
