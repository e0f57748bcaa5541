"""Incremental, idempotent ingest of landed raw batches.

Order of work for one batch (`ingest_batch`):
  ensure watermark table -> newest watermark (or fallback from the raw
  table, or the default start) -> gate on the newest stamp available ->
  keep rows after the watermark -> land a JSON copy -> first row per natural
  key -> drop keys already stored (null-safe anti-join) -> append ->
  append the advanced watermark.
Rows are written before the watermark; a crash between the two writes is
healed on the next run, because the anti-join skips the rows already stored,
and the years recorded before the append (`on_years`) tell the caller what
its models still miss. Records that cannot be parsed or compared are stored
as rejects, with their reason and file, before anything else. A file with open
rejects is read whole again: what was repaired in it is loaded although the
watermark may have passed its week, and its rejects are closed.
The driver only ever handles the one-row watermark, counts, and the years of a batch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewatch import schemas
from casewatch.operators import (
    advance_watermark, anti_join_new, dedup_first, has_newer, latest_watermark, watermark_from_raw,
)
from casewatch.reference_data import BACKFILL_YEARS, DEFAULT_START, NATURAL_KEY
from casewatch.plans import quality
from casewatch.session import drop_scratch, scratch_path
from casewatch.sources.landing import CORRUPT_COLUMN, POSITION_COLUMNS, flatten, land_raw, read_landed
from casewatch.sources.tables import append_raw, table_exists, write_table


def _int(c: str) -> Column:
    """A number, or null where there is none: one bad value must not stop a load."""
    return F.col(c).try_cast("long")


def rows_after(raw: DataFrame, year: int, week: int) -> DataFrame:
    """Rows strictly after (year, week), compared as integers.

    The extra `year >= year` conjunct is implied by the other two; it is there
    so a raw table partitioned by year skips older partitions at the scan.
    """
    return raw.where(_is_after(year, week))


def _is_after(year: int, week: int) -> Column:
    y, w = _int("year"), _int("week")
    return (y >= year) & ((y > year) | ((y == year) & (w > week)))


def rows_between_years(raw: DataFrame, start_year: int = BACKFILL_YEARS[0],
                       end_year: int = BACKFILL_YEARS[1]) -> DataFrame:
    """Backfill range: weeks 1-53 of every year of the inclusive range, in one pass."""
    return raw.where(_is_between(start_year, end_year))


def _is_between(start_year: int, end_year: int) -> Column:
    return _int("year").between(start_year, end_year) & _int("week").between(*BACKFILL_WEEKS)


BACKFILL_WEEKS = (1, 53)


def ordered_extract(raw: DataFrame) -> DataFrame:
    """Rows ordered by (year, week) as integers, for presentation only (a global sort)."""
    return raw.orderBy(_int("year").asc_nulls_first(), _int("week").asc_nulls_first())


# A total order for "first row per key" when no landing position is known.
CONTENT_ORDER = ["sort_order", "m1", "m2", "m3", "m4", "m1_flag", "m2_flag", "m3_flag", "m4_flag"]


def batch_order(df: DataFrame) -> list[Column]:
    """Landing position when the batch carries it, else content; always a total order."""
    cols = [c for c in POSITION_COLUMNS if c in df.columns] or [c for c in CONTENT_ORDER if c in df.columns]
    rest = [c for c in df.columns if c not in cols and c not in NATURAL_KEY and not c.startswith("_landed")]
    return [F.col(c).asc_nulls_first() for c in cols + rest]


def dedup_batch(df: DataFrame, keys: Sequence[str] = NATURAL_KEY) -> DataFrame:
    """First row per natural key within one batch (null keys count as equal)."""
    return dedup_first(df, keys, batch_order(df))


def restrict_to_batch_weeks(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Existing rows that can share a key with the batch: only its (year, week) pairs.

    Year and week are both part of the natural key, so rows of other weeks can never match. On a raw
    table partitioned by year and week the join prunes partitions at run time (the batch's distinct
    weeks are broadcast, and the scan lists only theirs): a weekly load reads one or two weeks of
    existing keys, not a year, and nothing comes to the driver. Years of four digits and weeks of
    one or two bound the broadcast; existing rows with any other year or week, nulls too, are kept.
    """
    calendar = F.col("year").rlike("^[0-9]{4}$") & F.col("week").rlike("^[0-9]{1,2}$")
    weeks = batch.select("year", "week").where(calendar).distinct()
    same = existing.where(calendar).join(F.broadcast(weeks), ["year", "week"], "left_semi").select(*existing.columns)
    return same.union(existing.where(~F.coalesce(calendar, F.lit(False))))


def new_rows(incoming: DataFrame, existing: DataFrame | None, keys: Sequence[str] = NATURAL_KEY,
             restrict: bool = True) -> DataFrame:
    """Dedup the batch, then drop keys already stored. No existing table: all deduped rows."""
    batch = dedup_batch(incoming, keys)
    if existing is None:
        return batch
    if restrict:
        existing = restrict_to_batch_weeks(existing, incoming)
    return anti_join_new(batch, existing, keys)


def backfill_rows(incoming: DataFrame, existing: DataFrame | None, start_year: int = BACKFILL_YEARS[0],
                  end_year: int = BACKFILL_YEARS[1]) -> DataFrame:
    """Backfill over a year range as one set-based pass (no loop over weeks)."""
    return new_rows(rows_between_years(incoming, start_year, end_year), existing)


def current_watermark(wm: DataFrame | None, raw: DataFrame | None,
                      default: tuple[int, int] = DEFAULT_START) -> tuple[int, int]:
    """Newest watermark row; else the greatest stamp of the raw table; else the default."""
    if wm is not None:
        row = latest_watermark(wm).first()
        if row is not None and row["year"] is not None and row["week"] is not None:
            return int(row["year"]), int(row["week"])
    if raw is not None:
        row = watermark_from_raw(raw, default).first()
        return int(row["year"]), int(row["week"])
    return default


def plan_batch(incoming: DataFrame, existing: DataFrame | None, wm: DataFrame | None,
               keys: Sequence[str] = NATURAL_KEY) -> tuple[bool, tuple[int, int], DataFrame, DataFrame]:
    """Decide and plan one incremental batch without writing anything.

    Returns (run, watermark, fetched, to_append): `fetched` are the rows after
    the watermark (what an incremental pull returns), `to_append` the new rows.
    """
    year, week = current_watermark(wm, existing)
    gate = has_newer(incoming, year, week).first()
    fetched = rows_after(incoming, year, week)
    if not gate["has_newer"]:
        return False, (year, week), fetched.limit(0), fetched.limit(0)
    return True, (year, week), fetched, new_rows(fetched, existing, keys)


def ensure_watermark(spark: SparkSession, path: str) -> DataFrame:
    """Create an empty watermark table if absent; return it."""
    if not table_exists(spark, path):
        spark.createDataFrame([], schemas.WATERMARK).write.mode("ignore").parquet(path)
    return spark.read.schema(schemas.WATERMARK).parquet(path)


@dataclass
class IngestResult:
    ran: bool
    watermark_before: tuple[int, int]
    fetched_rows: int
    appended_rows: int
    watermark_after: tuple[int, int] | None
    touched_years: list[int] = field(default_factory=list)  # feed to refresh_models(years=...)
    rejected_rows: int = 0                                  # new rejects stored by this call
    repaired_rejects: int = 0                               # rejects that their file no longer holds


REJECT_COLUMNS = ["reject_id", "reason", "landed_file", "record", "rejected_at"]


def load_reason() -> Column:
    """Why a landed row cannot be loaded, or null when it can."""
    checks = quality.quarantine_reason(None, quality.LOAD_CHECKS)
    return F.when(F.col(CORRUPT_COLUMN).isNotNull(), "malformed_json").otherwise(checks)


CLOSED = "reject_id string, version long, closed_at timestamp"


def _record() -> Column:
    return F.coalesce(F.col(CORRUPT_COLUMN), F.to_json(F.struct(*schemas.RAW_COLUMNS)))


def _reject_id() -> Column:
    """A reject is its record in its file."""
    return F.md5(F.concat_ws("|", "_landed_file", _record())).alias("reject_id")


def _closed_path(path: str) -> str:
    return f"{path.rstrip('/')}-closed"


def open_rejects(spark: SparkSession, path: str) -> DataFrame | None:
    """(reject_id, landed_file, version): stored rejects that no load has found repaired; None without a rejects table.

    A reject is open if it was stored more often than its last closure says (`version`), so a record that
    is broken again is open again, and closing twice, or after a crash, changes nothing.
    """
    if not table_exists(spark, path):
        return None
    stored = spark.read.parquet(path).groupBy("reject_id").agg(F.first("landed_file").alias("landed_file"), F.count("*").alias("version"))
    if not table_exists(spark, _closed_path(path)):
        return stored
    closed = spark.read.schema(CLOSED).parquet(_closed_path(path)).groupBy("reject_id").agg(F.max("version").alias("closed"))
    return stored.join(closed, "reject_id", "left").where(F.coalesce("closed", F.lit(0)) < F.col("version")).drop("closed")


def close_rejects(kept: DataFrame, path: str, at: dt.datetime | None) -> int:
    """Close the open rejects of files that this load has read (`kept`, stored rows with `load_reason`) and that no
    longer hold them. Rejects of files that are gone, or have no record left, stay open. Returns their number."""
    spark = kept.sparkSession
    still = open_rejects(spark, path)
    if still is None:
        return 0
    read = kept.select(F.col("_landed_file").alias("landed_file")).distinct()
    bad = kept.where(F.col("load_reason").isNotNull()).select(_reject_id()).distinct()
    gone = still.join(read, "landed_file", "left_semi").join(bad, "reject_id", "left_anti").select(
        "reject_id", "version", (F.lit(at).cast("timestamp") if at else F.current_timestamp()).alias("closed_at"))
    new = write_table(gone, scratch_path(spark, "ingest-closed"))
    n = new.count()
    if n:
        new.write.mode("append").parquet(_closed_path(path))
    return n


def with_reopened(tagged: DataFrame, rejects_path: str) -> DataFrame:
    """`tagged` with `_reopened`: whether the row's file has open rejects. A record repaired there may be of a week that
    the watermark has passed, so its rows are loaded whatever their week; those stored already fall to the anti-join."""
    still = open_rejects(tagged.sparkSession, rejects_path)
    if still is None:
        return tagged.withColumn("_reopened", F.lit(False))
    files = still.select(F.col("landed_file").alias("_landed_file")).distinct().withColumn("_reopened", F.lit(True))
    return tagged.join(files, "_landed_file", "left").select(*tagged.columns, F.coalesce("_reopened", F.lit(False)).alias("_reopened"))


def store_rejects(bad: DataFrame, path: str, at: dt.datetime | None) -> int:
    """Append the rejects that are not open yet (a landing folder is read again every week); return their number."""
    spark = bad.sparkSession
    rows = bad.select(_reject_id(), F.col("load_reason").alias("reason"), F.col("_landed_file").alias("landed_file"), _record().alias("record"),
                      (F.lit(at).cast("timestamp") if at else F.current_timestamp()).alias("rejected_at")).dropDuplicates(["reject_id"])
    known = open_rejects(spark, path)
    if known is not None:
        rows = rows.join(known.select("reject_id"), "reject_id", "left_anti")
    new = write_table(rows.select(*REJECT_COLUMNS), scratch_path(spark, "ingest-rejects"))
    n = new.count()
    if n:
        new.write.mode("append").parquet(path)
    return n


def write_watermark(spark: SparkSession, row, path: str) -> None:
    spark.createDataFrame([(row["year"], row["week"], row["loaded_at"])], schemas.WATERMARK).write.mode("append").parquet(path)


def append_new_rows(rows: DataFrame, raw_path: str, on_years: Callable[[list[int]], None] | None = None) -> tuple[int, list[int]]:
    """Write `rows` once, announce their years, append them; return their number and years."""
    staged = write_table(rows.select(*schemas.RAW_COLUMNS), scratch_path(rows.sparkSession, "ingest-new"))
    n = staged.count()
    # one row per calendar year present in the batch
    years = sorted(int(r[0]) for r in staged.select(_int("year")).distinct().collect() if r[0] is not None) if n else []
    if n:
        if on_years:
            on_years(years)
        append_raw(staged, raw_path)
    return n, years


def append_loadable(tagged: DataFrame, raw_path: str, rejects_path: str | None, loaded_at: dt.datetime | None = None,
                    on_years: Callable[[list[int]], None] | None = None) -> tuple[int, int, list[int]]:
    """Store the rejects of flattened landed rows that carry `load_reason`, and append those of the rest that are
    not stored yet; return the numbers of new rows and new rejects, and the new rows' years. Doing it again adds nothing."""
    spark = tagged.sparkSession
    existing = spark.read.schema(schemas.RAW).parquet(raw_path) if table_exists(spark, raw_path) else None
    rejected = store_rejects(tagged.where(F.col("load_reason").isNotNull()), rejects_path or f"{raw_path.rstrip('/')}-rejects", loaded_at)
    good = tagged.where(F.col("load_reason").isNull()).drop("load_reason", CORRUPT_COLUMN)
    n, years = append_new_rows(new_rows(good, existing), raw_path, on_years)
    return n, rejected, years


def tagged_rows(landed: DataFrame) -> DataFrame:
    """Flattened landed rows with the reason why a row cannot be loaded."""
    return flatten(landed).withColumn("load_reason", load_reason())


def ingest_batch(spark: SparkSession, landing: str, raw_path: str, wm_path: str,
                 loaded_at: dt.datetime | None = None, land_base: str | None = None,
                 multi_line: bool | None = None, rejects_path: str | None = None,
                 on_years: Callable[[list[int]], None] | None = None,
                 backfill: tuple[int, int] | None = None) -> IngestResult:
    """Run one load from landed files into the raw table.

    The landed files are parsed once: the rejects, the rows after the
    watermark (with `backfill`, the rows of those years, weeks 1-53) and all
    rows of files with open rejects (`with_reopened`) are written to a fresh folder under the shared checkpoint dir, and the gate,
    the landing copy, the dedup + anti-join and the watermark advance all read
    that stored copy. The gate ("newest stamp available > watermark") is the
    same as "some row is after the watermark". The new rows are written once
    more before the append, so the anti-join runs once and a retried append
    task re-reads files instead of recomputing the join. Both copies are
    deleted at the end. `on_years` is called with the years of the new rows
    before they are appended. A backfill moves the watermark forward only.
    """
    wm = ensure_watermark(spark, wm_path)
    existing = spark.read.schema(schemas.RAW).parquet(raw_path) if table_exists(spark, raw_path) else None
    before = current_watermark(wm, existing)
    landed = read_landed(spark, landing, multi_line=multi_line, with_position=True, malformed="column")
    tagged = tagged_rows(landed)
    rejects = rejects_path or f"{raw_path.rstrip('/')}-rejects"
    good, wanted = F.col("load_reason").isNull(), _is_between(*backfill) if backfill else _is_after(*before)
    rows = with_reopened(tagged, rejects).where(~good | F.col("_reopened") | F.coalesce(wanted, F.lit(False))).drop("_reopened")
    kept = write_table(rows, scratch_path(spark, "ingest-fetched"))
    fetched = kept.where(good & wanted).drop("load_reason", CORRUPT_COLUMN)
    adv = advance_watermark(fetched, loaded_at).first()
    if adv is not None and land_base:
        day = (loaded_at or dt.datetime.now(dt.timezone.utc)).date()
        land_raw(fetched.drop(*POSITION_COLUMNS), land_base, day)
    n_new, rejected, years = append_loadable(kept, raw_path, rejects, loaded_at, on_years)
    repaired = close_rejects(kept, rejects, loaded_at)  # after the append: a load that dies before tries them again
    after = None
    if adv is not None:
        if (adv["year"], adv["week"]) > before:
            write_watermark(spark, adv, wm_path)
        after = max((adv["year"], adv["week"]), before)
    ran = adv is not None or n_new > 0
    result = IngestResult(ran, before, fetched.count() if adv is not None else 0, n_new, after, years, rejected, repaired)
    drop_scratch(spark, "ingest-fetched", "ingest-new", "ingest-rejects", "ingest-closed")
    return result
