"""Secret scans: a recursive decoding worklist over every text.

Layer 0 is the text itself.  Every layer is scanned with the three patterns,
then decoded.  With all its escapes of one kind replaced in place it is a new
layer each: percent escapes, percent escapes and ``+`` for a space, and
character escapes (``\\uXXXX``, ``\\u{X}``, ``\\UXXXXXXXX``, ``\\xXX``, ``%uXXXX``,
``&#N;``, ``&#xN;``).  The decoded bytes of its base64 (standard and URL
alphabet) and hex runs are layers too, read as UTF-8 and, where they look like
it, as UTF-16, and unpacked when they are gzip or zlib.  A run is also read at
the other alignments, as a word may be glued to its front, and joined with the
full-width lines below it.  A layer already seen (same content, same place) is
not scanned again, so cycles end; the worklist ends when no layer yields a new
one (fixpoint).  Every layer keeps, per character, the span of the original
text it came from, so a secret found at any depth is reported as a span of the
original text; inside a compressed layer, whose characters have no place of
their own, as the whole run.  Bytes that are not UTF-8 and unprintable
characters stay in their layer and hide nothing beside them; of cut or damaged
compressed data what unpacks is scanned (but for its last byte at a damaged
place), and all its members.

Compressed data is unpacked to its end, whatever it expands to, in blocks of
``BLOCK`` bytes that overlap by ``OVERLAP``; one block of each depth is held at
a time.  Only what a block cannot hold is not put together again: encoded runs
inside compressed data that are longer than a block are read in parts, which
finds all of their text, but of data compressed a second time in such a run
what the first part holds.

Results for edge cases: a null text is the empty text (no spans); repeated
rows give repeated results; a text of any length is scanned whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Generator, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.text import texts

KINDS = ("assign", "access", "hex")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # a run is maximal, so shorter ones fail as a whole

# Encoded runs worth decoding.
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_PERCENT_PLUS = re.compile(r"(?:%[0-9A-Fa-f]{2})+|\+")
# A plus next to an assignment may stand for a space without any escape beside it.
_PLUS = re.compile(r"\+['\"]?[:=]|[:=]['\"]?\+")
_ESCAPE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\U([0-9A-Fa-f]{8})|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|%u([0-9A-Fa-f]{4})"
    r"|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
)
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_HEXRUN = re.compile(r"[0-9a-fA-F]{28,}")
# The base64 of a next line; a shorter word with prose after it is none.
_NEXT_LINE = re.compile(r"[ \t]*\r?\n[ \t]*([A-Za-z0-9+/_-]++)(?!={0,2}[ \t]+\S)")
_HEX_DIGITS = frozenset("0123456789abcdefABCDEF")
_SEPARATOR = re.compile(r"[-_/]")
_URL_ALPHABET = str.maketrans("-_", "+/")
# The shortest secret, "token=" and eight characters, has 14.
_SHORTEST = 14
# Bytes as printable, zero or other: plain text is a stretch of printable ones,
# UTF-16 text one that takes turns with zeros.
_CLASSES = bytes(112 if b in b"\t\n\r" or 32 <= b < 127 else 122 if b == 0 else 120 for b in range(256))
_PLAIN = b"p" * _SHORTEST
_TURNS = re.compile(rb"(?:pz){%d,}|(?:zp){%d,}" % (_SHORTEST, _SHORTEST))

#: Unpacked bytes that are scanned at once, and how many of them again with the
#: next ones.
BLOCK, OVERLAP = 16 << 20, 1 << 20

Span = tuple[str, int, int]


def scan(text: str) -> list[Span]:
    """(kind, start, end) of the secrets of one layer, as it stands."""
    found: list[Span] = []
    low = text.lower()
    if any(k in low for k in ("password", "passwd", "secret", "token", "key")):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


class _Same(Sequence):
    """One place for all characters of an unpacked layer."""

    __slots__ = ("value", "n")

    def __init__(self, value: int, n: int):
        self.value, self.n = value, n

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int | slice) -> int | _Same:
        if isinstance(i, slice):
            return _Same(self.value, len(range(*i.indices(self.n))))
        if not -self.n <= i < self.n:
            raise IndexError(i)
        return self.value


class _Layer:
    """Decoded text with, per character, its start and end in the original."""

    __slots__ = ("text", "starts", "ends")

    def __init__(self, text: str, starts: Sequence[int], ends: Sequence[int]):
        self.text, self.starts, self.ends = text, starts, ends

    def place(self, a: int, b: int) -> tuple[int, int]:
        return self.starts[a], self.ends[b - 1]

    def same(self) -> bool:
        return isinstance(self.starts, _Same)


def _kinds(raw: bytes) -> tuple[bool, bool]:
    """Whether some stretch is long enough for a secret or a run, as plain text
    and as UTF-16."""
    kinds = raw.translate(_CLASSES)
    return _PLAIN in kinds, b"pz" * _SHORTEST in kinds or b"zp" * _SHORTEST in kinds


def _readable(raw: bytes) -> bool:
    return any(_kinds(raw))


def _chars(text: str, sizes: Callable[[str], int], starts: Sequence[int], ends: Sequence[int]) -> _Layer:
    """The layer of decoded characters that take ``sizes`` bytes each, of which
    the source spans are given."""
    if isinstance(starts, _Same):
        return _Layer(text, _Same(starts.value, len(text)), _Same(ends.value, len(text)))
    s, e, at = [], [], 0
    for c in text:
        n = sizes(c)
        s.append(starts[at])
        e.append(ends[min(at + n, len(ends)) - 1])
        at += n
    return _Layer(text, s, e)


def _decoded(raw: bytes, starts: Sequence[int], ends: Sequence[int]) -> _Layer:
    """A layer from decoded bytes with the source span of each byte.  A byte
    that is not UTF-8 becomes a lone surrogate, which no pattern matches."""
    text = raw.decode("utf-8", "surrogateescape")
    if len(text) == len(raw):
        return _Layer(text, starts, ends)
    return _chars(text, lambda c: len(c.encode("utf-8", "surrogateescape")), starts, ends)


def _wide(raw: bytes, starts: Sequence[int], ends: Sequence[int]) -> Iterator[_Layer]:
    """Layers of UTF-16 text in decoded bytes: either byte order, from the first
    or the second byte."""
    found = {(m.start() + (raw[m.start()] == 0)) % 2 for m in _TURNS.finditer(raw.translate(_CLASSES))}
    for odd in sorted(found):  # where the bytes that are not zero stand
        for at, order in ((odd, "utf-16-le"), (1 - odd, "utf-16-be")):
            text = raw[at : len(raw) - (len(raw) - at) % 2].decode(order, "replace")
            yield _chars(text, lambda c: 4 if ord(c) > 0xFFFF else 2, starts[at:], ends[at:])


def _packed(raw: bytes) -> bool:
    """True for a gzip or zlib header."""
    return raw[:2] == b"\x1f\x8b" or (len(raw) > 2 and raw[0] & 0x0F == 8 and (raw[0] << 8 | raw[1]) % 31 == 0)


class _Blocks:
    """Unpacked bytes as they come, handed on in blocks that overlap."""

    def __init__(self):
        self.held, self.total = bytearray(), 0

    def put(self, got: bytes) -> Iterator[bytes]:
        self.held += got
        self.total += len(got)
        while len(self.held) >= BLOCK:
            yield bytes(self.held[:BLOCK])
            del self.held[: BLOCK - OVERLAP]

    def rest(self) -> Iterator[bytes]:
        if self.held:
            yield bytes(self.held)


def _member(raw: bytes, at: int, out: _Blocks) -> Generator[bytes, None, tuple[int, bool]]:
    """Unpack the gzip or zlib member that begins at ``at``; returns where it
    ends and whether it ends there as it should."""
    z = zlib.decompressobj(47)
    while at < len(raw):
        piece = raw[at : at + 65536]
        at += len(piece)
        while piece:
            before = z.copy()
            try:
                got = z.decompress(piece, 1 << 20)
            except zlib.error:
                yield from _crawl(before, piece, out)
                return len(raw), False
            yield from out.put(got)
            if z.eof:
                return at - len(z.unused_data), True
            piece = z.unconsumed_tail
            if not piece and len(got) == 1 << 20:
                while got := z.decompress(b"", 1 << 20):
                    yield from out.put(got)
    return len(raw), False


def _crawl(z, piece: bytes, out: _Blocks) -> Iterator[bytes]:
    """Unpack up to a damaged place: ever smaller steps of input, then byte by
    byte of output."""
    at = 0
    for step in (256, 1):
        while at < len(piece):
            before = z.copy()
            try:
                got = z.decompress(piece[at : at + step])
            except zlib.error:
                z = before
                break
            yield from out.put(got)
            at += step
    tail = piece[at : at + 1]
    while True:
        try:
            got = z.decompress(tail, 1)
        except zlib.error:
            break
        if not got and not z.unconsumed_tail:
            break
        yield from out.put(got)
        tail = z.unconsumed_tail


def _unpack(raw: bytes) -> Generator[bytes, None, tuple[int, bool]]:
    """Blocks of the joined content of the members that ``raw`` starts with;
    returns the bytes they take, and whether all of them are whole."""
    out, at, whole = _Blocks(), 0, True
    while whole and _packed(raw[at : at + 3]):
        total = out.total
        end, whole = yield from _member(raw, at, out)
        if out.total == total and not whole:
            yield from out.rest()
            return at, bool(at)  # no member after all
        at = end
    yield from out.rest()
    return at, whole


def _binary(raw: bytes, starts: Sequence[int], ends: Sequence[int]) -> Iterator[_Layer]:
    """Layers of bytes that may be compressed (then every character maps to
    the whole run); what follows the compressed members is read as it is, and
    so are all the bytes where a member is cut or damaged."""
    blocks = _unpack(raw)
    try:
        while True:
            inner = next(blocks)
            lo = starts.value if isinstance(starts, _Same) else min(starts)
            hi = ends.value if isinstance(ends, _Same) else max(ends)
            yield from _binary(inner, _Same(lo, len(inner)), _Same(hi, len(inner)))
    except StopIteration as stop:
        used, whole = stop.value
    if used and whole:
        raw, starts, ends = raw[used:], starts[used:], ends[used:]
    plain, wide = _kinds(raw)
    if plain:
        yield _decoded(raw, starts, ends)
    if wide:
        yield from _wide(raw, starts, ends)


def _percent_bytes(m: re.Match, starts: Sequence[int], ends: Sequence[int]) -> tuple[Sequence[str], Sequence[int], Sequence[int]]:
    below = _decoded(bytes.fromhex(m[0].replace("%", "")), starts[::3], ends[2::3])
    return below.text, below.starts, below.ends


def _replaced(layer: _Layer, escapes: re.Pattern, decode: Callable[..., tuple[Sequence[str], Sequence[int], Sequence[int]]]) -> list[_Layer]:
    """The whole layer with its escapes of one kind decoded in place, so that
    plain neighbours and spaces stay beside them; none if it has none."""
    chars, s, e, at, same = [], [], [], 0, layer.same()
    for m in escapes.finditer(layer.text):
        a, b = m.span()
        text, starts, ends = decode(m, layer.starts[a:b], layer.ends[a:b])
        chars += [layer.text[at:a], *text]
        if not same:
            s += [*layer.starts[at:a], *starts]
            e += [*layer.ends[at:a], *ends]
        at = b
    if not at:
        return []
    if same:
        whole = "".join(chars) + layer.text[at:]
        return [_Layer(whole, _Same(layer.starts.value, len(whole)), _Same(layer.ends.value, len(whole)))]
    return [_Layer("".join(chars) + layer.text[at:], [*s, *layer.starts[at:]], [*e, *layer.ends[at:]])]


def _lines(text: str, run: range) -> list[range]:
    """A run with the full-width lines right below it and their last one."""
    lines = [run]
    while m := _NEXT_LINE.match(text, lines[-1].stop):
        width = len(lines[1]) if len(lines) > 1 else len(m[1])
        if len(m[1]) > width:
            break
        lines.append(range(*m.span(1)))
        if len(m[1]) < width:
            break
    return lines


def _base64(layer: _Layer, places: Sequence[int]) -> Iterator[_Layer]:
    """Layers of the base64 characters at ``places`` of the layer: read at
    the four alignments, as a word may be glued to the front, and from after
    every separator where compressed data starts there."""
    text = layer.text
    run = text[places.start : places.stop] if isinstance(places, range) else "".join([text[i] for i in places])
    body = run.translate(_URL_ALPHABET)

    def decoded(at: int, most: int | None = None) -> bytes:
        part = body[at : None if most is None else at + most]
        part = part[: len(part) - (len(part) % 4 == 1)]
        return base64.b64decode(part + "=" * (-len(part) % 4))

    def layers(at: int, raw: bytes) -> Iterator[_Layer]:
        if layer.same():
            return _binary(raw, _Same(layer.starts.value, len(raw)), _Same(layer.ends.value, len(raw)))
        s = [layer.starts[places[at + i * 8 // 6]] for i in range(len(raw))]
        e = [layer.ends[places[min(at + (i * 8 + 7) // 6, len(body) - 1)]] for i in range(len(raw))]
        return _binary(raw, s, e)

    for at in range(4):
        raw = decoded(at)
        if _readable(raw) or _packed(raw[:3]):
            yield from layers(at, raw)
    for m in _SEPARATOR.finditer(run, 3):
        at = m.end()
        if at > 3 and _packed(decoded(at, 4)):
            # Most such headers are chance and break off at once.
            head = decoded(at, 512)
            if _begins(head):
                yield from layers(at, decoded(at) if len(body) - at > 512 and _goes_on(head) else head)


def _begins(head: bytes) -> bool:
    """True if something unpacks from the front of these bytes."""
    blocks = _unpack(head)
    try:
        while True:
            next(blocks)
    except StopIteration as stop:
        return stop.value[0] > 0


def _goes_on(head: bytes) -> bool:
    """False where compressed data is damaged within these bytes."""
    try:
        zlib.decompressobj(47).decompress(head, 1 << 16)
    except zlib.error:
        return False
    return True


def _hex(layer: _Layer, places: Sequence[int]) -> Iterator[_Layer]:
    """Layers of the hex digits at ``places``, from the first and, as a digit
    may be glued to the front, from the second."""
    for at in range(2):
        pairs = (len(places) - at) // 2
        raw = bytes.fromhex("".join([layer.text[i] for i in places[at : at + 2 * pairs]]))
        if _readable(raw) or _packed(raw[:3]):
            if layer.same():
                s, e = _Same(layer.starts.value, pairs), _Same(layer.ends.value, pairs)
            else:
                s = [layer.starts[places[at + 2 * i]] for i in range(pairs)]
                e = [layer.ends[places[at + 2 * i + 1]] for i in range(pairs)]
            yield from _binary(raw, s, e)


def _character(m: re.Match, starts: Sequence[int], ends: Sequence[int]) -> tuple[Sequence[str], Sequence[int], Sequence[int]]:
    code = int(m[7]) if m[7] else int(next(filter(None, m.groups())), 16)
    if code > 0x10FFFF:  # no character: stays as it is
        return m[0], starts, ends
    return [chr(code)], [starts[0]], [ends[-1]]


def _percent_or_space(m: re.Match, starts: Sequence[int], ends: Sequence[int]) -> tuple[Sequence[str], Sequence[int], Sequence[int]]:
    return (" ", starts, ends) if m[0] == "+" else _percent_bytes(m, starts, ends)


def _layers(layer: _Layer) -> Iterator[_Layer]:
    """Every layer one decoding step below ``layer``."""
    text = layer.text
    escaped = "%" in text and _PERCENT.search(text) is not None
    if escaped:
        yield from _replaced(layer, _PERCENT, _percent_bytes)
    if "+" in text and (escaped or _PLUS.search(text)):
        yield from _replaced(layer, _PERCENT_PLUS, _percent_or_space)
    if "\\" in text or "%u" in text or "&#" in text:
        yield from _replaced(layer, _ESCAPE, _character)
    joined, again = 0, -1
    for m in _BASE64.finditer(text):
        run = range(m.start(), m.start() + len(m[0].rstrip("=")))
        yield from _base64(layer, run)
        if len(run) == len(m[0]) and (run.start >= joined or run.start == again):
            lines = _lines(text, run)
            if len(lines) > 1:
                joined = lines[-1].stop
                # A first run of its own length may be a word before the lines.
                again = lines[1].start if len(run) != len(lines[1]) else -1
                places = [i for x in lines for i in x]
                yield from _base64(layer, places)
                if all(text[i] in _HEX_DIGITS for i in places):
                    yield from _hex(layer, places)
    for m in _HEXRUN.finditer(text):
        yield from _hex(layer, range(*m.span()))


def find_secrets(text: str | None) -> tuple[list[Span], list[Span]]:
    """Spans of the text as it stands, and all spans with those of decoded
    layers; both ordered by start, then kind as listed in ``KINDS``."""
    text = text or ""
    order = lambda x: (x[1], KINDS.index(x[0]), x[2])
    base = sorted(scan(text), key=order)
    spans = set(base)
    seen: set[tuple] = set()
    # Depth first, so that one layer of each depth is held.
    work = [_layers(_Layer(text, range(len(text)), range(1, len(text) + 1)))]
    while work:
        below = next(work[-1], None)
        if below is None:
            work.pop()
            continue
        if not below.text:
            continue
        mark = (hashlib.sha256(below.text.encode("utf-8", "surrogatepass")).digest(), below.starts[0], below.ends[-1])
        if mark not in seen:
            seen.add(mark)
            spans.update((k, *below.place(a, b)) for k, a, b in scan(below.text))
            work.append(_layers(below))
    return base, sorted(spans, key=order)


def join_spans(spans: Sequence[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def merged(spans: Sequence[Span]) -> list[tuple[int, int]]:
    """The union of spans as disjoint ranges."""
    out: list[list[int]] = []
    for _, a, b in sorted(spans, key=lambda x: x[1:]):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def redact(text: str, spans: Sequence[Span], mark: str = "[SECRET]") -> str:
    out, at = [], 0
    for a, b in merged(spans):
        out += [text[at:a], mark]
        at = b
    return "".join(out) + text[at:]


_SPAN = "array<struct<kind:string,start:int,end:int>>"


def secret_spans(text: Column) -> Column:
    """struct(base, spans): arrays of (kind, start, end), code points, end
    exclusive."""

    @F.arrow_udf(f"struct<base:{_SPAN},spans:{_SPAN}>")
    def spans_of(column: pa.Array) -> pa.Array:
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        row = lambda found: [{"kind": k, "start": a, "end": b} for k, a, b in found]
        both = [find_secrets(t) for t in texts(column).to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([row(b) for b, _ in both], span), pa.array([row(s) for _, s in both], span)], ["base", "spans"]
        )

    return spans_of(text)


def redacted_text(text: Column) -> Column:
    """The text with every secret span replaced by ``[SECRET]``; null stays
    null."""

    @F.arrow_udf("string")
    def redacted(column: pa.Array) -> pa.Array:
        return pa.array([None if t is None else redact(t, find_secrets(t)[1]) for t in column.to_pylist()], pa.string())

    return redacted(text)


def scan_secrets(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, ``base`` and ``spans``."""
    found = secret_spans(F.col("_t"))
    return (
        docs.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t"))
        .select("_i", found.alias("_f"))
        .select(F.col("_i").alias(id_col), "_f.base", "_f.spans")
    )
