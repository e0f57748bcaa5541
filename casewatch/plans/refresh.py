"""Incremental refresh of stored models: rebuild only the years a load touched.

Staging deduplicates within (state, year, week, disease), so the staging
rows of a year depend only on the raw rows of that year: a refresh stages
the touched years (raw read with year-partition pruning) and overwrites just
those year partitions (dynamic partition overwrite). The dimensions are
re-derived from the stored staging (a scan of 2-4 columns). The fact is a
projection of staging and is computed on read, never stored twice. The star of
the touched years is joined and read once, for its cells (`star_cells`), which
are stored by year; the three marts and the dashboard measures add up from
them. The top-5 and season marts rank within a state and year, so they are
rebuilt for the touched years only. The week-over-week LAG crosses year ends (the previous
row may lie in any earlier year): each year is stored as far as it tells by
itself, beside the last value of each of its series, and a reader joins the
first row of a series in a year, and no other, with the last value before
it. So no year is written because another one changed.

A store holds versions: every refresh writes its partitions under a new
`v/<version>` folder and publishes, last of all, a manifest that says which
version each partition of each table is read from. A reader or a crash sees
the store before the refresh or after it, never a mix; a store without a
manifest is not built yet, and the next refresh builds it whole. Manifests
are numbered, and a refresh must claim the number after the one it began
from: of two at a time one publishes, and the other begins again from what
the first has published. The manifest also keeps a table's parameters; years
made with other parameters are made anew.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewatch.plans.dims import dim_date, dim_diseases, dim_location
from casewatch.plans.facts import fact_disease_cases
from casewatch.plans.marts import (
    CELL_COLUMNS, SEASON_COLUMNS, TOP5_COLUMNS, season_of_cells, season_ranked, star, star_cells, top5_of_cells, top5_ranked,
    wow_last_rows, wow_of_cells, wow_over_year_ends, wow_year_rows,
)
from casewatch.plans.staging import stage_weekly
from casewatch.reference_data import SEASON_FIRST_YEAR, SEASON_LAST_YEAR, US_HOLIDAYS
from casewatch.schemas import STAGING_COLUMNS
from casewatch.session import drop_scratch, scratch_path
from casewatch.sources import files
from casewatch.sources.seeds import us_holidays
from casewatch.sources.tables import write_table

MART_TOP5 = "agg_top5_diseases_per_state_year_quarter"
MART_SEASON = "agg_top_disease_per_season_year"
MART_WOW = "agg_week_over_week_change_by_region_week_year"


#: The week-over-week mart by year, and the last row of each series and year.
WOW_ROWS, WOW_LAST = f"marts/{MART_WOW}-by-year", "work/wow_last"
#: The star's cells by year, which the marts and the dashboard measures add up from.
CELLS = "work/star_cells"
YEAR_TABLES = ("staging", CELLS, f"marts/{MART_TOP5}", f"marts/{MART_SEASON}", WOW_ROWS, WOW_LAST)

MANIFEST = "table string, part string, version string, schema string, params string"
#: (table, partition folder or "") -> (version, schema of the table, its parameters)
Manifest = dict[tuple[str, str], tuple[str, str, str]]
#: A claimed number that is not published after so many seconds is one of a run that died.
CLAIM_SECONDS = 600
#: Beginnings of a refresh that meets others.
ATTEMPTS = 5


class Conflict(RuntimeError):
    """Another refresh has published meanwhile."""


def _finished(spark, store: str) -> list[int]:
    folder = f"{store.rstrip('/')}/manifest"
    return sorted(int(n) for n in files.children(spark, folder) if n.isdigit() and files.exists(spark, f"{folder}/{n}/_SUCCESS"))


def _read(spark, store: str, number: int) -> Manifest:
    rows = spark.read.schema(MANIFEST).parquet(f"{store.rstrip('/')}/manifest/{number:08d}").collect()  # one row per table and year
    return {(r["table"], r["part"]): (r["version"], r["schema"], r["params"] or "") for r in rows}


def read_manifest(spark, store: str) -> Manifest | None:
    """The newest finished manifest; None for a store that was never built to the end, or by a library that kept other tables."""
    done = _finished(spark, store)
    manifest = _read(spark, store, done[-1]) if done else None
    return manifest if manifest and set(YEAR_TABLES) <= {t for t, _ in manifest} else None


def _claim(spark, store: str, base: int) -> int:
    """The number to publish under: the first after `base` that no living refresh holds."""
    number = base + 1
    while not files.claim(spark, path := f"{store.rstrip('/')}/claims/{number:08d}"):
        if (newest := max(_finished(spark, store), default=0)) > base:
            raise Conflict(f"manifest {newest} was published after {base}")
        if files.age_seconds(spark, path) > CLAIM_SECONDS:
            number += 1
        else:
            time.sleep(1)
    if max(_finished(spark, store), default=0) > base:
        raise Conflict(f"another manifest was published after {base}")
    return number


def _publish(spark, store: str, manifest: Manifest, base: int) -> None:
    root, folder = store.rstrip("/"), f"{store.rstrip('/')}/manifest"
    number = _claim(spark, store, base)
    rows = [(t, p, v, sch, par) for (t, p), (v, sch, par) in sorted(manifest.items())]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{folder}/{number:08d}")
    # Versions that neither this manifest nor the one before reads, and that no refresh is writing, are gone for every reader.
    kept = {v for v, _, _ in manifest.values()}
    if base:
        kept |= {v for v, _, _ in _read(spark, store, base).values()}
    for v in files.children(spark, f"{root}/v"):
        if v not in kept and not _is_open(spark, root, v):
            files.delete(spark, f"{root}/v/{v}")


def _is_open(spark, root: str, version: str) -> bool:
    """Is a refresh still writing this version? One that died is given up after a day."""
    mark = f"{root}/open/{version}"
    return files.exists(spark, mark) and files.age_seconds(spark, mark) < 86_400


class _Refresh:
    """Tables written under one new version, and the manifest that will name them."""

    def __init__(self, spark, store: str, previous: Manifest | None):
        self.spark, self.root, self.version = spark, store.rstrip("/"), uuid.uuid4().hex[:12]
        self.manifest: Manifest = dict(previous or {})
        files.touch(spark, f"{self.root}/open/{self.version}")

    def years(self, df: DataFrame, table: str, replaces: Callable[[int], bool] | None, params: str = "") -> DataFrame:
        """Write `df` by year; it takes the place of the years that `replaces` names (None: all)."""
        path = f"{self.root}/v/{self.version}/{table}"
        df.write.partitionBy("year").parquet(path)
        for t, part in list(self.manifest):
            if t == table and (replaces is None or part[5:].isdigit() and replaces(int(part[5:]))):
                del self.manifest[t, part]
        schema = df.schema.json()
        for part in [n for n in files.children(self.spark, path) if n.startswith("year=")] or [""]:
            self.manifest[table, part] = (self.version, schema, params)
        return _read_years(self.spark, self.root, self.manifest, table, df.columns)

    def whole(self, df: DataFrame, table: str) -> DataFrame:
        self.manifest[table, ""] = (self.version, df.schema.json(), "")
        return write_table(df, f"{self.root}/v/{self.version}/{table}")


def _read_years(spark, root: str, manifest: Manifest, table: str, columns: Sequence[str]) -> DataFrame:
    """A year-partitioned table of the manifest, with `year` as a long, in the model's column order."""
    by_version: dict[str, list[str]] = {}
    schema = None
    for (t, part), (version, sch, _) in sorted(manifest.items()):
        if t == table:
            schema = sch
            if part:
                by_version.setdefault(version, []).append(part)
    typed = T.StructType.fromJson(json.loads(schema))
    out = None
    for version, parts in by_version.items():  # at most one version per year
        base = f"{root.rstrip('/')}/v/{version}/{table}"
        df = spark.read.schema(typed).option("basePath", base).parquet(*[f"{base}/{p}" for p in parts])
        out = df if out is None else out.unionByName(df)
    if out is None:  # a table without rows
        out = spark.createDataFrame([], typed)
    return out.withColumn("year", F.col("year").cast("long")).select(*columns)


def _in_years(years: Sequence[int] | None) -> "F.Column":
    return F.lit(True) if years is None else F.col("year").try_cast("long").isin([int(y) for y in years])


def _holiday_mark(holidays: DataFrame) -> str:
    """What tells one list of holidays from another, whatever its order."""
    rows = holidays.select(F.xxhash64(*sorted(holidays.columns)).cast("decimal(38,0)").alias("h"))
    n, total = rows.agg(F.count(F.lit(1)), F.sum("h")).first()
    return json.dumps({"holidays": [n, str(total)]})


def refresh_models(raw: DataFrame, store: str, years: Sequence[int] | None = None,
                   holidays: DataFrame | None = None, season_years: tuple[int, int] | None = None) -> dict[str, DataFrame]:
    """Rebuild the stored models under `store` for `years` (None, or a store not built yet: all years).

    `season_years` bounds the season mart (default: the source's 2022-2026); where it differs from the
    stored mart's, that mart is rebuilt for all years, from the stored cells; other `holidays` than the store's
    rebuild the cells and marts of all years. If another refresh publishes meanwhile, this one begins
    again from what it published. Returns DataFrames reading the stored models (the fact as a projection of the
    stored staging).
    """
    for attempt in range(1, ATTEMPTS + 1):
        try:
            return _refresh(raw, store, years, holidays, season_years or (SEASON_FIRST_YEAR, SEASON_LAST_YEAR))
        except Conflict:
            if attempt == ATTEMPTS:
                raise
    raise AssertionError


def _refresh(raw: DataFrame, store: str, years: Sequence[int] | None, holidays: DataFrame | None,
             season_years: tuple[int, int]) -> dict[str, DataFrame]:
    spark = raw.sparkSession
    base = max(_finished(spark, store), default=0)
    previous = None if years is None else read_manifest(spark, store)
    scope = None if previous is None else sorted({int(y) for y in years})
    touches = None if scope is None else set(scope).__contains__
    new = _Refresh(spark, store, previous)

    stg = new.years(stage_weekly(raw.where(_in_years(scope))), "staging", touches)
    holiday_rows = len(US_HOLIDAYS) if holidays is None else None
    holidays = us_holidays(spark) if holidays is None else holidays
    loc = new.whole(dim_location(stg), "dims/dim_location")
    date = new.whole(dim_date(stg, holidays, holiday_rows), "dims/dim_date")
    dis = new.whole(dim_diseases(stg), "dims/dim_diseases")
    bounds = {"dim_location": loc.count(), "dim_date": date.count(), "dim_diseases": dis.count()}

    # Cells carry the holidays; with other holidays than the stored ones, all years are made anew.
    made_with = _holiday_mark(holidays)
    if previous is not None and not {par for (t, _), (_, _, par) in previous.items() if t == CELLS} <= {made_with}:
        scope = touches = None
    fact = fact_disease_cases(stg.where(_in_years(scope)))
    cells = new.years(star_cells(star(fact, loc, dis, date, bounds).where(_in_years(scope))), CELLS, touches, made_with)
    now = cells.where(_in_years(scope))
    new.years(top5_ranked(top5_of_cells(now)), f"marts/{MART_TOP5}", touches)
    season, params = f"marts/{MART_SEASON}", json.dumps({"season_years": list(season_years)})
    same = previous is not None and {par for (t, _), (_, _, par) in previous.items() if t == season} <= {params}
    new.years(season_ranked(season_of_cells(now if same else cells, *season_years)), season, touches if same else None, params)

    pre = write_table(wow_of_cells(now), scratch_path(spark, f"wow-preagg-{new.version}"))
    new.years(wow_year_rows(pre), WOW_ROWS, touches)
    new.years(wow_last_rows(pre), WOW_LAST, touches)
    drop_scratch(spark, f"wow-preagg-{new.version}")
    _publish(spark, store, new.manifest, base)
    files.delete(spark, f"{new.root}/open/{new.version}")
    return open_models(spark, store)


def open_models(spark, store: str) -> dict[str, DataFrame]:
    """DataFrames reading a model store written by `refresh_models` (in any session)."""
    manifest = read_manifest(spark, store)
    if manifest is None:
        raise ValueError(f"no finished model store at {store}")
    root = store.rstrip("/")

    def whole(table: str) -> DataFrame:
        version, schema, _ = manifest[table, ""]
        return spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(f"{root}/v/{version}/{table}")

    def by_year(table: str) -> DataFrame:
        schema = next(sch for (t, _), (_, sch, _) in manifest.items() if t == table)
        return _read_years(spark, root, manifest, table, T.StructType.fromJson(json.loads(schema)).names)

    stg = _read_years(spark, root, manifest, "staging", STAGING_COLUMNS)
    return {
        "stg_nndss_weekly": stg,
        "dim_location": whole("dims/dim_location"),
        "dim_date": whole("dims/dim_date"),
        "dim_diseases": whole("dims/dim_diseases"),
        "fact_disease_cases": fact_disease_cases(stg),
        "star_cells": _read_years(spark, root, manifest, CELLS, CELL_COLUMNS),
        MART_TOP5: _read_years(spark, root, manifest, f"marts/{MART_TOP5}", TOP5_COLUMNS),
        MART_SEASON: _read_years(spark, root, manifest, f"marts/{MART_SEASON}", SEASON_COLUMNS),
        MART_WOW: wow_over_year_ends(by_year(WOW_ROWS), by_year(WOW_LAST)),
    }
