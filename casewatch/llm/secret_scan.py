"""Secrets, with a recursive decoding worklist.

A text is scanned as it stands (the base). Then its encoded parts are unwrapped (percent
codes, Unicode and HTML escapes, base64, compressed bytes), each result is scanned and
unwrapped in turn, until nothing new comes up; a layer whose content was seen before is not
opened again, so chains that lead back to themselves end. What base64 or compression gives is
bytes, scanned as they are and without NULs (UTF-16), whether or not they read as text. Every
find maps to the source characters that held it.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import html
import lzma
import mmap
import re
import tempfile
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from urllib.parse import unquote_to_bytes

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import keyed
from casewatch.llm.spans import Mapped, Span, added, digest, joined

KINDS = ("assign", "access", "hex")
ASSIGN, ACCESS, HEX = range(3)

#: Bytes of one layer that are held in memory; a larger one goes to a temporary file, is scanned from there piece by piece, and counted in n_closed.
LAYER_BYTES = 64 << 20
#: Largest window of a zstd frame, which has to be held whole to open it.
WINDOW_BYTES = 128 << 20

_ASSIGN = re.compile(r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("(?<![0-9a-f])[0-9a-f]{24,}+")


def secrets(text: str) -> list[Span]:
    """The base spans of a text: leftmost, non-overlapping per kind; a match that fails its check is dropped."""
    out = []
    low = text.lower()
    if any(w in low for w in ("passw", "secret", "token", "api")):
        out += [Span(m.start(), ASSIGN, m.end()) for m in _ASSIGN.finditer(text) if m.end() - m.start(1) >= 6]
    if "AKIA" in text:
        out += [Span(m.start(), ACCESS, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [Span(m.start(), HEX, m.end()) for m in _HEX.finditer(text)]
    return out


_PERCENT = re.compile("(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|&(?:quot|amp|lt|gt|apos|equals|colon);)+")
_ONE_ESCAPE = re.compile(r"\\[uUx]\{?([0-9A-Fa-f]+)\}?")
_BASE64 = re.compile("(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}")
_ENDS_LINE = re.compile(r"(?:[A-Za-z0-9+/]{60,76}\r?\n)+[A-Za-z0-9+/]{2,76}={0,2}")
_RUN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
#: A line of nothing but one run.
_SOLE = re.compile(r"\n[ \t]*+([A-Za-z0-9+/_-]++={0,2})[ \t\r]*+(?=\n|\Z)")
#: What may be bytes in percent codes or escapes: signs that need no code stand for themselves.
_RAW_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~!*'()/+-])++")
_RAW_ESCAPE = re.compile(r"[^\s\\]{0,4}(?:\\(?:x|u00)[0-9A-Fa-f]{2})[^\n]*+")
_RAW_ONE = re.compile(r"\\(?:(?:x|u00)([0-9A-Fa-f]{2})|([nrt0abfv\\'\"]))")
_RAW_SIGNS = {"n": "\n", "r": "\r", "t": "\t", "0": "\0", "a": "\a", "b": "\b", "f": "\f", "v": "\v"}


def _percent(m: re.Match) -> str:
    data = unquote_to_bytes(m[0])
    try:
        return data.decode()
    except UnicodeDecodeError:
        return data.decode("latin-1")


def _escapes(m: re.Match) -> str:
    def one(e: re.Match) -> str:
        n = int(e[1], 16)
        return chr(n) if n < 0x110000 else e[0]
    # Pairs of surrogates become one character.
    return html.unescape(_ONE_ESCAPE.sub(one, m[0])).encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _raw(text: str) -> Iterator[tuple[int, int, bytes]]:
    """Runs of percent codes or escapes that may hold compressed bytes, and their bytes."""
    if "%" in text and _PERCENT.search(text):
        for m in _RAW_PERCENT.finditer(text):
            if "%" in m[0] and _MAGIC.search(data := unquote_to_bytes(m[0])):
                yield m.start(), m.end(), data
    if "\\x" in text or "\\u00" in text:
        for m in _RAW_ESCAPE.finditer(text):
            plain = _RAW_ONE.sub(lambda e: chr(int(e[1], 16)) if e[1] else _RAW_SIGNS.get(e[2], e[2]), m[0])
            if _MAGIC.search(data := plain.encode("latin-1", "replace")):
                yield m.start(), m.end(), data


def _wrapped(text: str | mmap.mmap, sole: re.Pattern = _SOLE, run: str | bytes = _RUN, blanks: str | bytes = " \t\r", pad: str | bytes = "=") -> Iterator[tuple[int, int]]:
    """Runs wrapped over lines of one width, indented or not, and a last line that may be shorter; the first may have text before it."""
    first = stop = width = last = 0
    after = -1  # where the block of such lines goes on
    for m in sole.finditer(text):
        n = len(m[1].rstrip(pad))
        if m.start() != after or n > width or last < width:
            if after >= 0:
                yield first, stop
            first, width = m.start(1), n
            if m.start() != after:
                end = m.start()
                while end and text[end - 1:end] in blanks:
                    end -= 1
                at = end
                while at and text[at - 1:at] in run:
                    at -= 1
                if at < end and end - at >= width:
                    first = at
        last, stop, after = n, m.end(1), m.end()
    if after >= 0:
        yield first, stop


def _coded(text: str) -> Iterator[tuple[int, int]]:
    """Places of what may be base64."""
    at = [m.span() for m in _BASE64.finditer(text)]
    if "\n" in text:
        at += [m.span() for m in _ENDS_LINE.finditer(text)]
        at += [(a, b) for a, b in _wrapped(text) if b - a >= 16 and "\n" in text[a:b]]
    return iter(dict.fromkeys(at))


_ZLIB = b"|".join(re.escape(bytes((c, f))) for c in range(8, 0x79, 16) for f in range(256) if (c * 256 + f) % 31 == 0 and not f & 32)
_MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|" + _ZLIB)
_MAKERS: dict[bytes, tuple[Callable, int]] = {
    b"\x1f\x8b": (lambda: zlib.decompressobj(31), 1 << 16), b"BZ": (bz2.BZ2Decompressor, 1 << 16), b"\xfd7": (lzma.LZMADecompressor, 1 << 16),
    # Has no limit of what one call gives, so it gets little at a time.
    b"\x28\xb5": (lambda: zstandard.ZstdDecompressor(max_window_size=WINDOW_BYTES).decompressobj(), 1 << 9)}
_ERRORS = (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError)
_CHUNK = 1 << 20


class _Layer:
    """The bytes of one layer: in memory up to the limit, beyond it in a file that goes with the layer."""

    def __init__(self):
        self.bytes, self.file = bytearray(), None

    def write(self, data: bytes) -> None:
        if self.file is None:
            self.bytes += data
            if len(self.bytes) > LAYER_BYTES:
                self.file = tempfile.TemporaryFile()
                self.file.write(self.bytes)
                self.bytes = bytearray()
        else:
            self.file.write(data)

    def done(self) -> bytes | mmap.mmap:
        if self.file is None:
            return bytes(self.bytes)
        self.file.flush()
        with self.file:
            return mmap.mmap(self.file.fileno(), 0, access=mmap.ACCESS_READ)


def _pieces(d, step: int, view: memoryview, pos: int) -> Iterator[tuple[bytes, int]]:
    """What one member or frame at `pos` opens to, piece by piece, and how far it was read."""
    limited = step > 1 << 9
    while not d.eof and pos < len(view):
        piece = view[pos:pos + step]
        pos += len(piece)
        yield (d.decompress(piece, _CHUNK) if limited else d.decompress(piece)), pos
        while limited and not d.eof and (d.unconsumed_tail if hasattr(d, "unconsumed_tail") else not d.needs_input):
            yield d.decompress(getattr(d, "unconsumed_tail", b""), _CHUNK), pos
    if hasattr(d, "flush") and limited and not d.eof:
        yield d.flush(), pos


def _opened(data: bytes | mmap.mmap) -> Iterator[bytes | mmap.mmap | None]:
    """What `data` holds in compressed form, with all members or frames that follow one another; None for a window over the limit."""
    view, at = memoryview(data), 0
    while m := _MAGIC.search(data, at):
        make, step = _MAKERS.get(m[0][:2], (zlib.decompressobj, 1 << 16))
        out, pos, at = _Layer(), m.start(), m.start() + 1
        try:
            while True:
                d = make()
                for piece, pos in _pieces(d, step, view, pos):
                    out.write(piece)
                if not d.eof:
                    break
                at = pos = pos - len(d.unused_data)
                while m[0][:2] == b"\xfd7" and data[pos:pos + 4] == b"\0\0\0\0":
                    pos += 4
                if not (after := _MAGIC.match(data, pos)) or after[0][:2] != m[0][:2] and (after[0][:2] in _MAKERS or m[0][:2] in _MAKERS):
                    break
        except _ERRORS as e:  # what came out before it is kept
            if isinstance(e, zstandard.ZstdError) and "memory" in str(e):
                yield None
        inner = out.done()
        if len(inner):
            yield inner


def _readable(data: bytes) -> bool:
    """UTF-8 or UTF-16 with a mark, and hardly any control characters."""
    try:
        text = data.decode("utf-16" if data[:2] in (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE) else "utf-8")
    except UnicodeDecodeError:
        return False
    odd = sum(c < " " and c not in "\t\n\r" or c == "\x7f" for c in text)
    return 20 * odd <= len(text)


_UNWRAP = str.maketrans("-_", "+/", " \t\r\n=")


def _phases(run: str) -> Iterator[bytes]:
    """The bytes of a base64 run from each of its first four characters: whatever stands before the code, one of them is in step."""
    body = run.translate(_UNWRAP)
    for k in range(4):
        n = len(body) - k
        n -= n % 4 == 1
        if n >= 2:
            yield base64.b64decode(body[k:k + n] + "=" * (-n % 4))


_END = object()


def _of_bytes(p: re.Pattern) -> re.Pattern:
    return re.compile(p.pattern.encode(), p.flags & ~re.UNICODE)


_BASE64_BYTES, _SOLE_BYTES, _ESCAPE_BYTES = map(_of_bytes, (_BASE64, _SOLE, _ESCAPE))
_ENDS_LINE_BYTES = re.compile(rb"(?:[A-Za-z0-9+/]{60,76}\r?\n)++(?:[A-Za-z0-9+/]{2,76}={0,2})?")


def _chunks(layer: mmap.mmap) -> Iterator[bytes]:
    for at in range(0, len(layer), _CHUNK):
        yield layer[at:at + _CHUNK]


def _kinds_of_large(layer: mmap.mmap) -> set[int]:
    """The kinds of secrets in a layer. Blanks in a row count as one and a find is sure after 24
    characters, so the last 64 are all that a find over the cut between two pieces needs."""
    kinds, kept = set(), b""
    for chunk in _chunks(layer):
        now = re.sub(rb"\x20{2,}", b" ", kept + chunk)
        kinds |= {s.kind for s in secrets(now.decode("latin-1"))}
        kept = now[-64:]
    return kinds


def _rewritten(layer: mmap.mmap, change: Callable[[bytes], bytes], codes: bytes, longest: int) -> Iterator[bytes | mmap.mmap]:
    """The layer with its codes changed, if it has any; a code starts with one of `codes` and is not cut."""
    out, kept, same = _Layer(), b"", True
    for chunk in _chunks(layer):
        now = kept + chunk
        cut = next((i for i in range(max(len(now) - longest, 0), len(now)) if now[i] in codes), len(now))
        new = change(now[:cut])
        same = same and new == now[:cut]
        out.write(new)
        kept = now[cut:]
    new = change(kept)
    out.write(new)
    if not (same and new == kept):
        yield out.done()


def _large_phases(layer: mmap.mmap, a: int, b: int) -> Iterator[bytes | mmap.mmap]:
    """_phases of a run of any length."""
    if b - a <= LAYER_BYTES:
        yield from _phases(layer[a:b].decode())
        return
    for k in range(4):
        out, kept, skip = _Layer(), "", k
        for at in range(a, b, _CHUNK):
            body = layer[at:min(at + _CHUNK, b)].decode().translate(_UNWRAP)
            body, skip = kept + body[skip:], max(skip - len(body), 0)
            n = len(body) // 4 * 4
            out.write(base64.b64decode(body[:n]))
            kept = body[n:]
        if len(kept) > 1:
            out.write(base64.b64decode(kept + "=" * (-len(kept) % 4)))
        yield out.done()


def _below_large(layer: mmap.mmap, above: frozenset[bytes]) -> tuple[set[int], int, int]:
    """_below for one layer of any length, with memory for one piece or one run up to the limit at a time."""
    kinds, layers, closed = _kinds_of_large(layer), 1, 1

    def children() -> Iterator[Iterator[bytes | mmap.mmap | None]]:
        if layer.find(b"\0") >= 0:  # UTF-16
            yield _rewritten(layer, lambda x: x.replace(b"\0", b""), b"", 0)
        if layer.find(b"%") >= 0:
            yield _rewritten(layer, unquote_to_bytes, b"%", 2)
        if layer.find(b"\\") >= 0 or layer.find(b"&") >= 0:
            yield _rewritten(layer, lambda x: _ESCAPE_BYTES.sub(
                lambda m: _latin(_escapes(_ESCAPE.fullmatch(m[0].decode()))).encode("latin-1"), x), b"\\&", 12)
        yield _opened(layer)
        for p in (_BASE64_BYTES, _ENDS_LINE_BYTES):
            for m in p.finditer(layer):
                yield _large_phases(layer, *m.span())
        for a, b in _wrapped(layer, _SOLE_BYTES, _RUN.encode(), b" \t\r", b"="):
            if b - a >= 16:
                yield _large_phases(layer, a, b)
    for inside in children():
        found, n, shut = _below(inside, above)
        kinds |= found
        layers, closed = layers + n, closed + shut
    return kinds, layers, closed


#: A layer without any of these holds nothing.
_HOPE = re.compile(r"(?ai)passw|secret|token|api|akia|[0-9a-f]{24}|[%\\&\0]|[a-z0-9+/_-]{16}|\n")


def _below(inside: Iterator[bytes | mmap.mmap | None], above: frozenset[bytes] = frozenset()) -> tuple[set[int], int, int]:
    """Kinds of secrets in layers of bytes and all layers in them, layers opened, layers over the limit. `above`: large layers they came out of."""
    kinds, layers, closed, seen = set(), 0, 0, set()
    work = deque([inside])
    while work:
        if (now := next(work[0], _END)) is _END:
            work.popleft()
            continue
        if now is None:
            closed += 1
            continue
        if isinstance(now, mmap.mmap):
            if (h := hashlib.sha256(now).digest()) not in seen and h not in above:
                seen.add(h)
                found, n, shut = _below_large(now, above | {h})
                kinds |= found
                layers, closed = layers + n, closed + shut
            continue
        text = now.decode("latin-1")  # the patterns are ASCII
        hope, readable = _HOPE.search(text), _readable(now)
        if not hope and not readable and not _MAGIC.search(now):
            continue
        if (h := hashlib.sha256(now).digest()) in seen:
            continue
        seen.add(h)
        own = {s.kind for s in secrets(text)} if hope else set()
        kinds |= own
        layers += bool(own) or readable
        if "\0" in text:  # UTF-16
            work.append(iter([now.replace(b"\0", b"")]))
        if "%" in text and (plain := unquote_to_bytes(now)) != now:
            work.append(iter([plain]))
        if ("\\" in text or "&" in text) and (plain := _ESCAPE.sub(lambda m: _latin(_escapes(m)), text)) != text:
            work.append(iter([plain.encode("latin-1")]))
        work.append(_opened(now))
        if hope:
            work.extend(_phases(text[a:b]) for a, b in _coded(text))
    return kinds, layers, closed


def _latin(text: str) -> str:
    """Text as the Latin-1 reading of its bytes; characters up to U+00FF stand for bytes."""
    return text if all(c <= "\xff" for c in text) else text.encode(errors="replace").decode("latin-1")


def _edits(text: str, pattern: re.Pattern, decode: Callable[[re.Match], str | None]) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), new) for m in pattern.finditer(text) if (new := decode(m)) is not None]


def _digest(text: str) -> bytes:
    return hashlib.sha256(text.encode(errors="surrogatepass")).digest()


def scan(text: str) -> tuple[list[Span], list[Span], int, int]:
    """Base spans, spans of decoded layers (both in source code points), layers opened, layers over the limits."""
    base, more, layers, closed = secrets(text), [], 0, 0
    # Layer, the contents it came out of, and how a span of it maps to the source.
    work: deque[tuple[str, frozenset, Callable[[int, int], tuple[int, int]]]] = deque([(text, frozenset(), lambda a, b: (a, b))])
    while work:
        now, above, back = work.popleft()
        children: list[tuple[str, Callable, Callable]] = []
        edits = _edits(now, _PERCENT, _percent) if "%" in now else []
        if "\\" in now or "&" in now:
            edits = sorted(edits + _edits(now, _ESCAPE, _escapes))
        if edits:
            m = Mapped(now, edits)
            children.append((m.text, m.source_span, m.edited))
        inside = [(a, b, _phases(now[a:b])) for a, b in _coded(now)] + [(a, b, _opened(data)) for a, b, data in _raw(now)]
        for a, b, inner in inside:
            kinds, n, shut = _below(inner)
            layers, closed = layers + n, closed + shut
            at = back(a, b)
            more += [Span(at[0], k, at[1]) for k in sorted(kinds)]
        if children:
            above = above | {_digest(now)}
        for child, up, edited in children:
            if _digest(child) in above:  # back where it came from
                continue
            layers += 1

            def whole(a: int, b: int, up=up, back=back) -> tuple[int, int]:
                return back(*up(a, b))
            for s in secrets(child):
                if edited(s.start, s.end):
                    a, b = whole(s.start, s.end)
                    more.append(Span(a, s.kind, b))
            work.append((child, above, whole))
    return base, added(base, more), layers, closed


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, base_sha, spans, plus, opened, shut = [[] for _ in KINDS], [], [], [], [], []
        for text in b.column("text").to_pylist():
            base, more, layers, closed = scan(text or "")
            for k, of_kind in enumerate(n):
                of_kind.append(sum(s.kind == k for s in base))
            base_sha.append(digest(joined(base, KINDS)))
            spans.append(joined(base + more, KINDS))
            plus.append(len(more))
            opened.append(layers)
            shut.append(closed)
        yield pa.RecordBatch.from_arrays(
            [b.column("kf"), b.column("kr"), b.column("doc_id"), *[pa.array(x, pa.int64()) for x in n], pa.array(base_sha, pa.string()),
             pa.array(spans, pa.string()), *[pa.array(x, pa.int64()) for x in (plus, opened, shut)]],
            names=["kf", "kr", "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added", "n_layers", "n_closed"])


def find_secrets(docs: DataFrame) -> DataFrame:
    """Spans of secrets in every whole text and all its decoded layers, one row per document, in one pass without a shuffle.

    Columns: kf, kr, doc_id, n_assign, n_access, n_hex (base spans), base_sha256, spans (base and
    decoded ones), n_added, n_layers (layers that read as text or hold a secret), n_closed (layers over LAYER_BYTES,
    which are scanned from a temporary file, and zstd frames with a window over WINDOW_BYTES, which are not).
    Reads `doc_id` and `text`; other columns are ignored. A null text counts as empty: no
    spans. Repeated rows are scanned once each; an empty table gives an empty result.
    """
    rows = keyed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(_scan, f"kf long, kr long, doc_id long, {counts}, base_sha256 string, spans string, n_added long, n_layers long, n_closed long")
