"""Landed files of any layout, cut into byte ranges anywhere, lose no record."""

import json
import random
import tempfile
from pathlib import Path

import pytest

from casewatch.sources import read_landed
from casewatch.sources.landing import CORRUPT_COLUMN, flatten
from tests.test_jobs import rec

ODD_TEXTS = ['a "quoted" {brace} \\ back', "}{][,", "line\nbreak", "é語🙂", "", 'ends with backslash \\', '\\"}', "x" * 300]


def records(rng, n):
    return [{**rec(rng.choice(ODD_TEXTS) + str(i), str(rng.randrange(2020, 2026)), str(rng.randrange(1, 54)), label=rng.choice(ODD_TEXTS)),
             "geocode": rng.choice([None, {"type": "Point", "coordinates": [1.5, -2.0]}])} for i in range(n)]


LAYOUTS = {
    "array": json.dumps,
    "lines": lambda r: "".join(json.dumps(x) + "\n" for x in r),
    "lines without a last break": lambda r: "\n".join(json.dumps(x, ensure_ascii=False) for x in r),
    "windows lines": lambda r: "\r\n".join(json.dumps(x) for x in r),
    "pretty array": lambda r: json.dumps(r, indent=2),
    "pretty objects": lambda r: "\n".join(json.dumps(x, indent=1) for x in r),
    "an array a line": lambda r: "\n".join(json.dumps(r[i:i + 3]) for i in range(0, len(r), 3)),
    "array over lines": lambda r: "[" + ",\n ".join(json.dumps(x) for x in r) + "]\n",
    "one line": lambda r: " ".join(json.dumps(x) for x in r),
    "marked": lambda r: "﻿" + json.dumps(r),
}


@pytest.fixture(params=[128 << 20, 700, 90])
def ranges(request, spark):
    """Byte ranges of the usual size, and far smaller ones than a record."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set(keys[0], str(request.param))
    spark.conf.set(keys[1], "1")
    spark.conf.set(keys[2], "1")
    yield request.param
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def key(row):
    return json.dumps(row, sort_keys=True)


def test_a_folder_of_every_layout(spark, ranges):
    rng, root, want = random.Random(7), tempfile.mkdtemp(prefix="casewatch-layouts-"), []
    for i, (name, text) in enumerate(LAYOUTS.items()):
        r = records(rng, 25 if ranges > 90 else 6)
        want += [(f"{i}.json", x) for x in r]
        with open(f"{root}/{i}.json", "w", newline="") as fh:
            fh.write(text(r))
    open(f"{root}/empty.json", "w").close()
    got = read_landed(spark, root, with_position=True, malformed="column").collect()
    assert [r for r in got if r[CORRUPT_COLUMN] is not None] == []
    order = sorted(got, key=lambda r: (r._landed_file, r._landed_offset, r._landed_seq))
    found = [(r._landed_file.rsplit("/", 1)[1], r.asDict(recursive=True)) for r in order]
    assert [(f, x["states"], x["label"], x["week"], x["geocode"]) for f, x in found] == [
        (f, x["states"], x["label"], x["week"], x["geocode"]) for f, x in want]
    assert read_landed(spark, root).count() == len(want)


@pytest.mark.parametrize("large", ["array", "lines"])
def test_layout_of_a_file_does_not_depend_on_the_others(spark, large):
    rng, root = random.Random(3), tempfile.mkdtemp(prefix="casewatch-mixed-")
    n = {"array": 8, "lines": 3} if large == "array" else {"array": 2, "lines": 30}
    for name, k in n.items():
        with open(f"{root}/{name}.json", "w") as fh:
            fh.write(LAYOUTS[name](records(rng, k)))
    assert read_landed(spark, root, malformed="column").where(f"{CORRUPT_COLUMN} IS NULL").count() == sum(n.values())


def test_broken_files_keep_what_is_whole(spark, ranges):
    rng, root = random.Random(5), tempfile.mkdtemp(prefix="casewatch-broken-")
    r = records(rng, 8)
    line = LAYOUTS["lines"](r).split("\n")
    texts = {
        "cut.json": json.dumps(r)[:-30],                                       # seven whole records
        "bare.json": json.dumps(r)[:-2],                                       # cut before the last brace
        "line.json": "\n".join([*line[:3], line[3][:50], *line[4:]]),          # one broken line
        "junk.json": json.dumps(r[:2])[:-1] + ", null, 17, " + json.dumps(r[2]) + "] trailing",
        "twice.json": line[0] + line[1] + "\n" + line[2] + "\n" + line[3] + "\n",
    }
    for name, text in texts.items():
        with open(f"{root}/{name}", "w") as fh:
            fh.write(text)
    got = read_landed(spark, root, with_position=True, malformed="column").collect()
    good, bad = {}, {}
    for x in got:
        into = good if x[CORRUPT_COLUMN] is None else bad
        into.setdefault(x._landed_file.rsplit("/", 1)[1], []).append(x.states if into is good else x[CORRUPT_COLUMN])
    assert {k: len(v) for k, v in good.items()} == {"cut.json": 7, "bare.json": 7, "line.json": 7, "junk.json": 3, "twice.json": 4}
    assert {k: len(v) for k, v in bad.items()} == {"cut.json": 1, "bare.json": 1, "line.json": 1, "junk.json": 2}
    assert bad["line.json"][0].strip() == line[3][:50] and sorted(x.strip() for x in bad["junk.json"]) == ["null, 17", "trailing"]
    with pytest.raises(Exception, match="(?i)no record|malformed|parse"):
        read_landed(spark, root).collect()


def test_over_long_records_come_in_pieces(spark, monkeypatch):
    from casewatch.sources import json_records as j
    cutter = j._Cutter(False, False, 0)
    monkeypatch.setattr(j, "RECORD_BYTES", 10)
    cutter.piece(b'{"a": "xxxxxxxx", "b": {', closed=True)
    cutter.piece(b', "c": "y"', closed=True)
    kinds = [k for k, _ in cutter.found]
    assert kinds == [j.BEGIN, *[j.MIDDLE] * (len(kinds) - 2), j.END] and len(kinds) > 2
    assert b"".join(t for _, t in cutter.found) == b'{"a": "xxxxxxxx", "b": {}, "c": "y"}'


def test_compressed_files(spark):
    import gzip
    rng, root = random.Random(1), tempfile.mkdtemp(prefix="casewatch-gz-")
    for name in ("array", "lines"):
        with gzip.open(f"{root}/{name}.json.gz", "wt") as fh:
            fh.write(LAYOUTS[name](records(rng, 9)))
    assert flatten(read_landed(spark, root)).count() == 18


def test_a_compressed_file_may_be_as_long_as_its_text(spark):
    """Its size then tells nothing about where the last record ends."""
    import gzip
    rng, root, want = random.Random(2), tempfile.mkdtemp(prefix="casewatch-gz-size-"), set()
    for end in ("", "\n"):
        for longer in (-1, 0, 1, 2, 3):  # a byte less or more, a mark of three bytes
            for n in range(5000):  # a text whose compressed form has that size
                state = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(n % 500))
                text = json.dumps({"states": state}) + end
                if len(gzip.compress(text.encode(), mtime=0)) == len(text) + longer:
                    break
            else:
                raise AssertionError((end, longer))
            want.add(state)
            with open(f"{root}/{len(want)}.json.gz", "wb") as fh:
                fh.write(gzip.compress(text.encode(), mtime=0))
    assert {r.states for r in read_landed(spark, root).collect()} == want and len(want) == 10


def test_landed_files_take_less_disk_than_their_text(spark, tmp_path, monkeypatch):
    """Three layouts, the two of short lines compressed in files of few records; every record comes back."""
    import gzip
    from casewatch import queries
    spark.range(3000).selectExpr(
        "id AS l_orderkey", "id * 7 AS l_partkey", "id % 11 AS l_suppkey", "id % 7 + 1 AS l_linenumber", "id % 50 + 0.5D AS l_quantity",
        "id * 1.25D AS l_extendedprice", "CASE id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'R' END AS l_returnflag", "IF(id % 2 = 0, 'F', 'O') AS l_linestatus",
        "TIMESTAMP_NTZ '1995-01-01' + make_dt_interval(CAST(id % 900 AS INT)) AS l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(queries, "LANDED_PAGE", 50, raising=False)
    path = queries.landed_files(spark, str(tmp_path))
    texts = {f: (gzip.open(f) if f.suffix == ".gz" else f.open("rb")).read().decode() for f in Path(path.removeprefix("file:")).glob("part-*")}
    begins = {("[", False), ("{", True)}
    assert {(t[0], f.suffix == ".gz") for f, t in texts.items() if t} == begins
    packed = [(f, t) for f, t in texts.items() if f.suffix == ".gz" and t]
    assert {t.startswith("{\n") for _, t in packed} == {True, False} and all(t.count('"sort_order"') <= 50 for _, t in packed)
    assert sum(t.count('"sort_order"') for t in texts.values()) == 3000
    assert sum(f.stat().st_size for f in texts) < 0.7 * sum(len(t.encode()) for t in texts.values())
    got = queries.q_ingest_landed_files(spark, str(tmp_path)).drop("geocode_type")
    want = queries.raw(spark, str(tmp_path)).select(got.columns)
    assert got.count() == 3000 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
