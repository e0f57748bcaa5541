"""Best-fit packing by linear grouping.

The histogram of piece lengths (at most `size` numbers, whatever the corpus) is packed on
the driver: large lengths are rounded up within groups of equal cardinality, the few sizes
are packed by an optimal mix of configurations (a linear program, rounded down), actual
documents take the places, each the longest that fits, and everything else goes where it fits best. Several
numbers of groups are tried on the histogram, and for each several shares of the mix and rooms that a sequence of
the mix may leave; the plan with the fewest sequences is taken. All plans take these steps, none is best fit alone
(but where no length is large, or no configuration is filled well enough). The result is a short list of runs, "the
documents of this length and these ranks go to these sequences", which Spark applies to the documents.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import ranked, written
from casewatch.llm.tokens import token_pieces

SIZE = 4096
#: Numbers of groups of large lengths that are tried.
GROUPS = (48, 96)
#: (room, share) tried with each: this share of the mix is placed, as far as its sequences leave at most so much room.
#: Rounding costs little where the mix is all there is to gain; where lengths fit each other anyhow, a strict share does.
FILLS = ((SIZE, 1.0), (8, 1.0), (0, 0.25), (0, 0.0625))
#: Lengths over size // SMALL are large.
SMALL = 4
#: Column generation stops this near the optimum.
TOLERANCE = 0.001
#: And after so many steps a size at the latest; what it has by then is a valid mix.
STEPS = 8


def configurations(sizes: list[int], demand: list[int], size: int) -> list[tuple[list[int], float]]:
    """(how many of each size, how often) that cover the demand with the fewest sequences, fractions allowed.

    Column generation: start from one-size configurations, add the best one by a
    knapsack over the dual prices until none helps.
    """
    k, w = len(sizes), np.array(sizes)
    d = np.array(demand, float) * (1 + np.arange(1, k + 1) / (1e4 * k))  # no ties, so the steps don't circle
    basis = np.diag(size // w).astype(float)
    room = np.arange(size + 1)
    at = room[None, :] - w[:, None]
    fits, at = at >= 0, np.maximum(at, 0)
    for _ in range(STEPS * k):
        inverse = np.linalg.inv(basis)
        prices = inverse.sum(axis=0)
        best, picks = np.zeros(size + 1), []
        for _ in range(size // int(w.min())):
            value = np.where(fits, best[at] + prices[:, None], -1.0)
            pick = value.argmax(axis=0)
            better = value[pick, room] > best + 1e-12
            picks.append(np.where(better, pick, -1))
            best = np.where(better, value[pick, room], best)
        if best[size] <= 1 + TOLERANCE:  # at most this share above the optimum
            break
        new, left = np.zeros(k), size
        for pick in reversed(picks):
            if pick[left] >= 0:
                new[pick[left]] += 1
                left -= w[pick[left]]
        amounts, change = inverse @ d, inverse @ new
        ratios = np.where(change > 1e-9, np.maximum(amounts, 0) / np.where(change > 1e-9, change, 1), np.inf)
        basis[:, ratios.argmin()] = new
    amounts = np.linalg.solve(basis, d)
    return [(basis[:, i].astype(int).tolist(), max(0.0, float(amounts[i]))) for i in range(k)]


class _Plan:
    def __init__(self, size: int):
        self.size, self.bins = size, 0
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free room -> ranges of sequences
        self.rooms: list[int] = []  # sorted keys of self.open

    def add_range(self, start: int, count: int, room: int) -> None:
        if count and room:
            if not self.open[room]:
                bisect.insort(self.rooms, room)
            self.open[room].append((start, count))

    def new(self, count: int) -> int:
        self.bins += count
        return self.bins - count

    def best_fit(self, length: int, rank: int, n: int) -> None:
        """n documents of this length, from this rank on: each to the sequence with the least room that is enough."""
        while n:
            i = bisect.bisect_left(self.rooms, length)
            if i == len(self.rooms):
                count = -(-n // (self.size // length))
                self.add_range(self.new(count), count, self.size)
                continue
            room = self.rooms[i]
            start, count = self.open[room].pop()
            if not self.open[room]:
                del self.rooms[i]
            each = min(room // length, n)  # the same sequence stays the tightest until it is full
            take = min(count, n // each)
            self.runs.append((length, rank, take * each, start, each, self.size - room))
            self.add_range(start + take, count - take, room)
            self.add_range(start, take, room - each * length)
            rank, n = rank + take * each, n - take * each


def pack(histogram: dict[int, int], size: int = SIZE, groups: tuple[int, ...] = GROUPS, small: int = SMALL) -> tuple[list[tuple], int]:
    """Runs (length, first rank, documents, first sequence, documents a sequence, offset) and the number of sequences.

    Ranks number the documents of one length from 0. No number of groups can do better than a mix that
    leaves less than a sequence of room in all, so trying ends there.
    """
    least = -(-sum(x * n for x, n in histogram.items()) // size)
    best = None
    for k in groups:
        sizes, mix = _mix(histogram, size, k, small)
        for room, share in FILLS:
            plan = _filled(histogram, size, sizes, mix, room, share)
            if best is None or plan.bins < best.bins:
                best = plan
            if best.bins == least:
                return best.runs, best.bins
    return best.runs, best.bins


def _mix(histogram: dict[int, int], size: int, groups: int, small: int) -> tuple[list[int], list[tuple[list[int], float]]]:
    """Large lengths rounded up within `groups` groups: the sizes, and the configurations that pack them."""
    large = sorted((x for x in histogram if size // small < x < size), reverse=True)
    if not groups or not large:
        return [], []
    each, filled = -(-sum(histogram[x] for x in large) // groups), 0
    sizes, demand = [], []
    for x in large:  # groups of `each` documents by falling length, rounded up to their longest
        rest = histogram[x]
        while rest:
            if not sizes or filled == each and sizes[-1] != x:
                sizes.append(x)
                demand.append(0)
                filled = 0
            n = rest if sizes[-1] == x else min(rest, each - filled)
            demand[-1] += n
            filled, rest = min(each, filled + n), rest - n
    mix = configurations(sizes, demand, size)
    return sizes, sorted(mix, key=lambda m: -sum(c * s for c, s in zip(m[0], sizes, strict=True)))


def _filled(histogram: dict[int, int], size: int, sizes: list[int], mix: list[tuple[list[int], float]], most: int, share: float) -> _Plan:
    """A share of the mix, its places filled by documents with at most `most` room left, then best fit of all others."""
    plan = _Plan(size)
    if full := histogram.get(size, 0):
        plan.runs.append((size, 0, full, plan.new(full), 1, 0))
    left = _Left({x: n for x, n in histogram.items() if x < size})
    for counts, often in mix:
        _substitute(plan, left, [s for s, c in zip(sizes, counts, strict=True) for _ in range(c)], int(often * share + 1e-6), most)
    for x in sorted(left.count, reverse=True):
        plan.best_fit(x, left.rank[x], left.count[x])
    return plan


class _Left:
    """Documents not placed yet: per length, how many and the first one's rank."""

    def __init__(self, histogram: dict[int, int]):
        self.count, self.rank, self.lengths = dict(histogram), dict.fromkeys(histogram, 0), sorted(histogram)

    def longest(self, most: int, held: list[int]) -> int:
        """The longest length up to `most` of which more are left than `held` takes; 0 if there is none."""
        i = bisect.bisect_right(self.lengths, most) - 1
        while i >= 0 and held.count(self.lengths[i]) >= self.count[self.lengths[i]]:
            i -= 1
        return self.lengths[i] if i >= 0 else 0

    def take(self, x: int, n: int) -> int:
        rank = self.rank[x]
        self.rank[x] += n
        self.count[x] -= n
        if not self.count[x]:
            del self.count[x]
            self.lengths.pop(bisect.bisect_left(self.lengths, x))
        return rank


def _substitute(plan: _Plan, left: _Left, places: list[int], many: int, most: int) -> None:
    """`many` sequences of one configuration: each place takes the longest document of its size at most, the last
    one of whatever room is left. Ends with the first that would leave more room than `most`."""
    while many and left.lengths:
        room, held = plan.size, []
        for i, s in enumerate(places):
            if x := left.longest(room if i == len(places) - 1 else min(s, room), held):
                held.append(x)
                room -= x
        if not held or room > most:
            return
        n = min(many, *(left.count[x] // held.count(x) for x in held))
        first, offset = plan.new(n), 0
        for x in held:
            plan.runs.append((x, left.take(x, n), n, first, 1, offset))
            offset += x
        plan.add_range(first, n, room)
        many -= n


def _place(runs: list[tuple], before: dict[int, int]):
    """Sequence and offset of each piece, from its length and its rank among all pieces."""
    table = np.array(sorted(runs), np.int64).reshape(-1, 6)
    shorter = np.zeros(max(before, default=0) + 1, np.int64)
    for x, n in before.items():
        shorter[x] = n
    starts = shorter[table[:, 0]] + table[:, 1]  # runs by the rank among all pieces: sorted, without gaps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rank = b.column("rank").to_numpy(zero_copy_only=False)
            own = table[np.searchsorted(starts, rank, "right") - 1] if len(rank) else table[:0]
            nth = rank - shorter[own[:, 0]] - own[:, 1]
            sequence, offset = own[:, 3] + nth // np.maximum(own[:, 4], 1), own[:, 5] + nth % np.maximum(own[:, 4], 1) * own[:, 0]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sequence), pa.array(offset)],
                                             names=[*b.schema.names[:-1], "sequence_id", "offset"])
    return run


def pack_documents(docs: DataFrame, size: int = SIZE, tokenizer: str | None = None) -> DataFrame:
    """Pack all documents into sequences of at most `size` tokens, one row per piece.

    Columns: kf, kr, doc_id, piece, start, length, ids_crc32, sequence_id, offset. Reads `doc_id`
    and `text`; other columns are ignored. A document is its text's ids, then id 1; only longer
    ones are cut. A null or empty text is the one id 1; repeated rows are packed once each; an
    empty table gives an empty result.
    """
    pieces = written(token_pieces(docs, size, 1, tokenizer), "pieces")
    order = ranked(pieces, ["length", "kf", "kr", "piece"], "ranked-pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `size` rows
    before, n = {}, 0
    for x in sorted(histogram):
        before[x], n = n, n + histogram[x]
    runs, _ = pack(histogram, size)
    keep = [*pieces.columns, "rank"]
    return order.select(*keep).mapInArrow(
        _place(runs, before),
        "kf long, kr long, doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
