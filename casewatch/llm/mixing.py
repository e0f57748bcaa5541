"""Mixing sources to target weights by pivotal dependent rounding. DataFrame functions only.

A source's target divided by its size is the copies that each of its documents is worth;
the whole part is taken, the fractional part is rounded dependently: two documents at a time
move words between their fractions, at random but without bias, until one of them is whole.
Small groups of documents are folded this way, what is left open of each group goes to the
next level of a reduction tree, and one document a source is left at the end. So the words
taken from a source miss its target by less than one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import KEY, keyed, ranked, written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_COPIES = 2.0
#: Documents that one group of the reduction tree folds, about.
GROUP = 64
SEED = 20240229

_BLANK = r"[\x20\x09-\x0D]"
_UNIT = "struct<kf:bigint,kr:bigint,doc_id:bigint,size:bigint,x:double>"


def n_words(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text (null: 0): every word and the blanks after it become
    one character, so no more memory is used than the text takes."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.coalesce(F.length(F.regexp_replace(trimmed, rf"[^\x20\x09-\x0D]++{_BLANK}*+", "x")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_copies: float = MAX_COPIES) -> DataFrame:
    """source, source_size, n, target from (source, source_size, n), a written table.

    Sources in code point order, null last, weigh `weights` in turn and share `share` times all
    sizes; a target stops at `max_copies` times its source's size, and what is over goes to the
    others by weight, until none is above.
    """
    order = ranked(sizes, [F.col("source").asc_nulls_last()], "ranked-sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    weighed = order.withColumn("weight", weight).withColumn("most", max_copies * F.col("source_size"))
    everything = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:  # one row per round; the level only rises, and with it the number of full sources
        full = F.col("weight") * level > F.col("most")
        r = weighed.agg(F.count_if(full).alias("n"), F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)).alias("given"),
                        F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("weight")).first()
        if r["n"] == capped or not r["weight"]:
            break
        capped, level = r["n"], (share * everything - r["given"]) / r["weight"]
    return weighed.select("source", "source_size", "n", F.least(F.col("weight") * level, F.col("most")).alias("target"))


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts only."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *parts), 11) * F.lit(2.0**-53)


def _with(unit: Column, x: Column) -> Column:
    return F.struct(unit["kf"].alias("kf"), unit["kr"].alias("kr"), unit["doc_id"].alias("doc_id"), unit["size"].alias("size"),
                    F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)).alias("x"))


def _fold(state: Column, e: Column) -> Column:
    """Pair the open unit with the next: one of them becomes 0 or 1 and is done, the other stays open.

    Words move up (to the open unit) by at most `up`, or down by at most `down`, with chances that
    leave both expectations as they are.
    """
    s = state["open"]
    s_room, s_has = s["size"] * (1 - s["x"]), s["size"] * s["x"]
    e_room, e_has = e["size"] * (1 - e["x"]), e["size"] * e["x"]
    up, down = F.least(s_room, e_has), F.least(s_has, e_room)
    rises = F.coalesce(_uniform(s["doc_id"], e["doc_id"], s["size"], e["size"]) * (up + down) < down, F.lit(False)) & (up + down > 0)
    s_done = F.when(rises, s_room <= e_has).otherwise(s_has <= e_room)
    done = F.when(s_done, _with(s, F.when(rises, F.lit(1.0)).otherwise(F.lit(0.0)))).otherwise(
        _with(e, F.when(rises, F.lit(0.0)).otherwise(F.lit(1.0))))
    still = F.when(s_done, _with(e, e["x"] + F.when(rises, -s_room).otherwise(s_has) / e["size"])).otherwise(
        _with(s, s["x"] + F.when(rises, e_has).otherwise(-e_room) / s["size"]))
    return F.when(s.isNull(), F.struct(_with(e, e["x"]).alias("open"), state["done"].alias("done"))).otherwise(
        F.struct(still.alias("open"), F.concat(state["done"], F.array(done)).alias("done")))


def spread(units: DataFrame) -> DataFrame:
    """source, unit, h for `units` (source, unit, text_hash): h is a hash by which no group gets more than its share.

    An id that one unit has is hashed alone. Units that share an id, or have none, are hashed with their rank among
    all such units, by id, text, size and source; those equal in all of these are alike, so reruns agree on any layout.
    """
    id = F.col("unit.doc_id")
    repeated = written(units.groupBy(id.alias("id")).agg(F.count("*").alias("n")).filter("n > 1 OR id IS NULL").select("id"), "repeated-ids")
    marked = written(units.alias("u").join(repeated.alias("r"), F.expr("u.unit.doc_id <=> r.id"), "left_semi").select(
        "source", "unit", "text_hash", id.alias("id"), F.col("unit.size").alias("size"), F.col("unit.kf").alias("kf"), F.col("unit.kr").alias("kr")), "repeats")
    order = ["id", "text_hash", "size", "source", *KEY]
    again = ranked(marked, order, "ranked-repeats").select("source", "unit", F.xxhash64(F.lit(SEED), F.coalesce("id", F.lit(0)), "rank").alias("h"))
    single = units.alias("u").join(repeated.alias("r"), F.expr("u.unit.doc_id <=> r.id"), "left_anti")
    return single.select("source", "unit", F.xxhash64(F.lit(SEED), id).alias("h")).union(again)


def pivotal(units: DataFrame, n: int, group: int = GROUP) -> DataFrame:
    """kf, kr, pick (0 or 1) for `units` (source, unit, text_hash), of which no source has more than n.

    Each level of the tree puts the units of a source in groups of about `group`, by their `spread`
    (so a source with a third of all rows is spread like all others), and folds each group.
    """
    groups, level, decided = max(1, -(-n // group)), spread(units), []
    while True:
        empty = F.struct(F.lit(None).cast(_UNIT).alias("open"), F.array().cast(f"array<{_UNIT}>").alias("done"))
        folded = written(
            level.groupBy("source", F.pmod("h", F.lit(groups)).alias("g"))
            .agg(F.sort_array(F.collect_list(F.struct("h", "unit"))).alias("all"))
            .select("source", "all", F.aggregate(F.transform("all", lambda x: x["unit"]), empty, _fold).alias("r"))
            .select("source", F.element_at("all", 1)["h"].alias("h"), "r"), "folded")
        decided.append(folded.select(F.explode("r.done").alias("u")).select("u.kf", "u.kr", (F.col("u.x") > 0.5).cast("int").alias("pick")))
        level = folded.select("source", F.col("r.open").alias("unit"), "h")
        if groups == 1:
            break
        # One open unit is left of each group, so about `group` of them meet in a group of the next level.
        groups = -(-groups // group)
    last = level.select(F.col("unit.kf").alias("kf"), F.col("unit.kr").alias("kr"),
                        (_uniform(F.col("unit.doc_id"), F.col("unit.size")) < F.col("unit.x")).cast("int").alias("pick"))
    for d in decided:
        last = last.union(d)
    return last


def mix(docs: DataFrame, source: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
        max_copies: float = MAX_COPIES, group: int = GROUP) -> DataFrame:
    """Per row of `docs`: kf, kr, doc_id, source, size, source_size, target, copies, taken.

    size: words of the text; target: words that the row's source gives to the mix; copies: how often the
    mix has the document; taken: copies * size. Reads `doc_id`, `text` and the source column; other columns are
    ignored. A null or empty text has size 0 and is never rounded up; rows without a source are one source, the last; rows
    that repeat an id are separate documents; an empty table gives an empty result.
    """
    rows = written(keyed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"),
                         n_words(F.col("text").cast("string")).alias("size"),
                         F.xxhash64(F.col("text").cast("string")).alias("text_hash")), "sizes")
    sizes = written(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "source-sizes")
    goals = written(targets(sizes, weights, share, max_copies), "targets")
    most = goals.agg(F.max("n")).first()[0] or 0
    # Written tables, no hint: a few sources are broadcast by their measured size, a hot one among many is split.
    with_goal = rows.alias("d").join(goals.alias("t"), F.expr("d.source <=> t.source")).select(
        *[F.col(f"d.{c}") for c in (*KEY, "doc_id", "source", "size", "text_hash")], "source_size", "target",
        F.coalesce(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size")), F.lit(0.0)).alias("rate"))
    x = F.col("rate") - F.floor("rate")
    units = with_goal.filter((F.col("size") > 0) & (x > 0)).select(
        "source", F.struct("kf", "kr", "doc_id", "size", x.alias("x")).alias("unit"), "text_hash")
    picks = pivotal(units, most, group)
    copies = (F.floor("rate") + F.coalesce("pick", F.lit(0))).cast("long")
    return with_goal.join(picks, KEY, "left").select(
        *KEY, "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
