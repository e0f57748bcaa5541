"""Spans of a text and their digest, shared by the scanners of personal data and secrets."""

from __future__ import annotations

import bisect
import hashlib
from typing import NamedTuple


class Span(NamedTuple):
    start: int
    kind: int  # position in the scanner's list of kinds
    end: int


def joined(spans: list[Span], kinds: tuple[str, ...]) -> str:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return ",".join(f"{kinds[s.kind]}:{s.start}:{s.end}" for s in sorted(spans))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def added(base: list[Span], more: list[Span], fuller: frozenset[Span] = frozenset()) -> list[Span]:
    """The spans of `more`, in order, that overlap no span of their kind in `base` or taken before.

    A span that is also in `fuller` may overlap base spans of its kind if it holds each of them whole and more.
    """
    own: dict[int, list[tuple[int, int]]] = {}
    taken: dict[int, list[tuple[int, int]]] = {}
    for s in sorted(base):
        own.setdefault(s.kind, []).append((s.start, s.end))

    def over(spans: list[tuple[int, int]], s: Span) -> list[tuple[int, int]]:
        i = bisect.bisect_left(spans, (s.start, s.start))
        i -= i > 0 and spans[i - 1][1] > s.start
        j = i
        while j < len(spans) and spans[j][0] < s.end:
            j += 1
        return spans[i:j]
    out = []
    for s in sorted(set(more)):
        before = over(own.get(s.kind, []), s)
        holds = s in fuller and all(s.start <= a and b <= s.end and (a, b) != (s.start, s.end) for a, b in before)
        if (holds or not before) and not over(mine := taken.setdefault(s.kind, []), s):
            bisect.insort(mine, (s.start, s.end))
            out.append(s)
    return out


class Mapped:
    """A text made from a source text, and where each of its characters came from.

    `edits` are (start, end, replacement) on the source, in order. The map is kept per
    edit, so a long text with few edits costs little more than itself.
    """

    def __init__(self, source: str, edits: list[tuple[int, int, str]]):
        parts, at, made = [], 0, 0
        self.made, self.lengths, self.froms = [], [], []
        for a, b, new in edits:
            parts += (source[at:a], new)
            made += a - at
            self.made.append(made)
            self.lengths.append(len(new))
            self.froms.append((a, b))
            made, at = made + len(new), b
        parts.append(source[at:])
        self.text = "".join(parts)

    def _back(self, pos: int, end: bool) -> int:
        """Source position of a boundary; inside an edit, the edit's start or end."""
        i = bisect.bisect_right(self.made, pos - end) - 1
        if i < 0:
            return pos
        a, b = self.froms[i]
        past = pos - self.made[i] - self.lengths[i]
        if past > 0 or past == 0 and not end:
            return b + past
        return b if end else a

    def source_span(self, start: int, end: int) -> tuple[int, int]:
        return self._back(start, False), self._back(end, True)

    def edited(self, start: int, end: int) -> bool:
        """Does the span hold any character of an edit?"""
        i = bisect.bisect_left(self.made, end) - 1
        return i >= 0 and self.made[i] + max(self.lengths[i], 1) > start
