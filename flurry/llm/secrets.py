"""Secret scan with a recursive decoding worklist.

Every text is scanned as it is; then each layer of URL escapes, Unicode
escapes, base64 and compression found in it is unwrapped, put on a worklist
and scanned again, until nothing new appears. Every decoded byte knows the
place in the original text it came from, so findings are reported there.
"""

from __future__ import annotations

import binascii
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flurry.llm import blocks as B

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
WORDS = (b"password", b"passwd", b"secret", b"token", b"api")
PERCENT = re.compile(rb"%([0-9A-Fa-f]{2})")
ESCAPE = re.compile(rb"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
SURROGATES = re.compile(rb"\\u([Dd][89ABab][0-9A-Fa-f]{2})\\u([Dd][C-Fc-f][0-9A-Fa-f]{2})")
_C = rb"[A-Za-z0-9+/_-]"
_BREAK = rb"(?:[ \t]*+(?:\r?\n|(?:\\r)?\\n)[ \t]*+)"  # a line end, as it is or as an escape, with indentation
LINE = re.compile(_C + rb"{16,}")
RUN = re.compile(rb"(?<!" + _C + rb")(?:" + _C + rb"{16,}+(?:" + _BREAK + _C + rb"++)*+|" + _C + rb"++(?:" + _BREAK + _C + rb"++)++)")
BODY = re.compile(_C + rb"*+(?:" + _BREAK + _C + rb"++)*+")
BREAK = re.compile(_BREAK)
_REVERSED = rb"(?:(?!n\\)" + _C + rb")++"
# a run that reaches the end of the data, in reversed data
BACKWARDS = re.compile(rb"[ \t]*+(?:(?:\n\r?|\r|n\\(?:r\\)?|r\\|\\)[ \t]*+)?" + _REVERSED
                       + rb"(?:[ \t]*+(?:\n\r?|n\\(?:r\\)?)[ \t]*+" + _REVERSED + rb")*+")
STANDARD = bytes.maketrans(b"-_", b"+/")
# headers of gzip and of zlib without a preset dictionary
PACKED = re.compile(rb"\x1f\x8b\x08|" + b"|".join(
    re.escape(bytes([c, f])) for c in range(0x08, 0x80, 0x10) for f in range(256) if (c * 256 + f) % 31 == 0 and not f & 0x20), re.S)
_ASCII = rb"[\t\n\r\x20-\x7e]"
# ASCII in wider characters: (name, pattern, bytes a character, place of the low byte)
WIDE = tuple((name, re.compile(rb"(?:%b%b%b){16,}" % (b"\0" * at, _ASCII, b"\0" * (n - 1 - at))), n, at)
             for name, n, at in (("utf16le", 2, 0), ("utf16be", 2, 1), ("utf32le", 4, 0), ("utf32be", 4, 3)))
# what a layer that holds a pattern or another layer cannot lack
WORTH = re.compile(rb"[A-Za-z0-9+/_.=-]{12}|%[0-9A-Fa-f]{2}|\\[uxrn]|&#|\0[\s\S]\0|" + PACKED.pattern)
WINDOW = 4 << 20       # decompressed bytes scanned at a time
OVERLAP = 1 << 16      # bytes shared by neighbouring windows
CHUNK = 1 << 10        # compressed bytes read at a time

HEX_BYTE = np.ones(256, bool)
HEX_BYTE[list(b"0123456789abcdef")] = False


def scan(data: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, by start, then kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(data) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(data) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(data) if m.end() - m.start() >= 16]
    return sorted(out)


class Layer:
    """Decoded bytes; begin[i], end[i]: the piece of the original text byte i comes from."""

    __slots__ = ("data", "begin", "end", "chain")

    def __init__(self, data: bytes, begin: np.ndarray, end: np.ndarray, chain: tuple[str, ...] = ()):
        self.data, self.begin, self.end, self.chain = data, begin, end, chain

    def place(self, start: int, end: int) -> tuple[int, int]:
        return int(self.begin[start:end].min()), int(self.end[start:end].max())

    def rewritten(self, cuts: list[tuple[int, int, bytes]], how: str) -> Layer:
        """The layer with pieces [start, end) replaced."""
        data, begin, end, at = [], [], [], 0
        for a, z, new in cuts:
            data += [self.data[at:a], new]
            begin += [self.begin[at:a], np.full(len(new), self.begin[a])]
            end += [self.end[at:a], np.full(len(new), self.end[z - 1])]
            at = z
        return Layer(b"".join([*data, self.data[at:]]), np.concatenate([*begin, self.begin[at:]]),
                     np.concatenate([*end, self.end[at:]]), (*self.chain, how))

    def inner(self, start: int, end: int, data: bytes, *how: str) -> Layer:
        """Bytes that the piece [start, end) as a whole stands for."""
        a, z = self.place(start, end)
        return Layer(data, np.full(len(data), a), np.full(len(data), z), (*self.chain, *how))


def _character(code: int) -> bytes | None:
    return chr(code).encode() if code < 0x110000 and not 0xD800 <= code < 0xE000 else None


def _escapes(data: bytes) -> list[tuple[int, int, bytes]]:
    cuts = []
    pairs = {m.start(): m for m in SURROGATES.finditer(data)}
    skip = -1
    for m in ESCAPE.finditer(data):
        if m.start() < skip:
            continue
        if m.start() in pairs:
            p = pairs[m.start()]
            code = 0x10000 + ((int(p[1], 16) & 0x3FF) << 10) + (int(p[2], 16) & 0x3FF)
            cuts.append((p.start(), p.end(), chr(code).encode()))
            skip = p.end()
            continue
        g = next(i for i in range(1, 6) if m[i] is not None)
        new = bytes([int(m[3], 16)]) if g == 3 else _character(int(m[g], 10 if g == 5 else 16))
        if new is not None:
            cuts.append((m.start(), m.end(), new))
    return cuts


class Bytes:
    """Source of the bytes from ``at`` on, then of ``rest``."""

    def __init__(self, data: bytes, at: int = 0, rest=None):
        self.data, self.at, self.rest = data, at, rest

    def read(self, n: int) -> bytes:
        part = self.data[self.at:self.at + n]
        self.at += len(part)
        return part or (self.rest.read(n) if self.rest else b"")

    def fork(self) -> Bytes:
        return Bytes(self.data, self.at, self.rest and self.rest.fork())


class Inflate:
    """Source of the decompressed bytes of a source that starts with a gzip or zlib
    header; gzip members that follow are part of it. A damaged stream ends at its damage.
    """

    def __init__(self, src):
        self.src, self.d, self.left, self.taken, self.state = src, zlib.decompressobj(47), b"", 0, "open"

    def fork(self) -> Inflate:
        new = Inflate(self.src.fork())
        new.d, new.left, new.taken, new.state = self.d.copy() if not self.d.eof else self.d, self.left, self.taken, self.state
        return new

    @property
    def used(self) -> int:
        return self.taken - len(self.left)

    def _more(self) -> bool:
        part = self.src.read(CHUNK)
        self.left += part
        self.taken += len(part)
        return bool(part)

    def read(self, n: int) -> bytes:
        while self.state == "open":
            if self.d.eof:
                while len(self.left) < 3 and self._more():
                    pass
                if self.left[:3] != b"\x1f\x8b\x08":
                    self.state = "ended"
                    break
                self.d = zlib.decompressobj(47)
            last = not self.left and not self._more()
            before = self.d.copy()
            try:
                part = self.d.decompress(self.left, n)
                self.left = self.d.unused_data if self.d.eof else self.d.unconsumed_tail
            except zlib.error:
                part, self.state = self._salvage(before), "damaged"
            if last and not part and not self.d.eof:
                self.state = "short"
            if part:
                return part
        return b""

    def _salvage(self, d) -> bytes:
        """What the bytes before the damage give."""
        out, feed = [], self.left
        try:
            for i in range(len(feed)):
                self.left = feed[i + 1:]
                out.append(d.decompress(feed[i:i + 1]))
        except zlib.error:
            pass
        return b"".join(out)


class Unbase64:
    """Source of the bytes that a base64 run at the start of a source stands for, read from its character ``skip`` on."""

    def __init__(self, src, skip: int):
        self.src, self.skip, self.held, self.chars, self.open = src, skip, b"", b"", True

    def fork(self) -> Unbase64:
        new = Unbase64(self.src.fork(), self.skip)
        new.held, new.chars, new.open = self.held, self.chars, self.open
        return new

    def read(self, n: int) -> bytes:
        while self.open:
            part = self.src.read(n)
            self.held += part
            upto = BODY.match(self.held).end()
            new, self.held = BREAK.sub(b"", self.held[:upto]), self.held[upto:]
            self.open = bool(part) and len(self.held) < CHUNK
            drop = min(self.skip, len(new))
            self.skip -= drop
            self.chars += new[drop:]
            whole = len(self.chars) // 4 * 4 if self.open else len(self.chars)
            now, self.chars = self.chars[:whole], self.chars[whole:]
            if got := _decoded(now):
                return got
        return b""


def _decoded(chars: bytes) -> bytes:
    """Base64 of either alphabet without padding; a single character left over stands for nothing."""
    chars = chars[:-1] if len(chars) % 4 == 1 else chars
    return binascii.a2b_base64(chars.translate(STANDARD) + b"=" * (-len(chars) % 4))


def _windows(src, path: tuple[bytes, ...] = ()) -> Iterator[tuple[bytes, tuple[str, ...]]]:
    """Overlapping windows of a source, with the decodings passed. What goes on
    beyond a window's end is decoded from the source itself, in its own windows.
    """
    tail = b""
    while True:
        parts, size = [], 0
        while size < WINDOW and (part := src.read(WINDOW - size)):
            parts.append(part)
            size += len(part)
        if not size:
            return
        data = tail + b"".join(parts)
        if not tail:
            mark = hashlib.blake2b(data).digest()
            if mark in path:  # a stream that unpacks to itself
                return
            path = (*path, mark)
        yield data, ()
        if size == WINDOW:
            for how, inner in _going_on(data, len(tail), src):
                for got, more in _windows(inner, path):
                    yield got, (how, *more)
        tail = data[-OVERLAP:]


def _going_on(data: bytes, known: int, src) -> Iterator[tuple[str, Inflate | Unbase64]]:
    """Streams and base64 runs that begin in a window after ``known`` and reach its end."""
    for m in PACKED.finditer(data, max(0, known - 2)):
        inner = Inflate(Bytes(data, m.start()))
        while inner.read(WINDOW):
            pass
        if inner.state == "short":
            yield "inflate", Inflate(Bytes(data, m.start(), src.fork()))
    m = BACKWARDS.match(data[::-1])
    at = len(data) - m.end() if m else 0
    if m and at >= known:
        for skip in range(4):
            yield "base64", Unbase64(Bytes(data, at, src.fork()), skip)


def _readings(data: bytes, start: int, end: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(start, end, skip, decoded) of a base64 run: its lines joined and each longer line, at every alignment."""
    pieces = {(start, end), *((m.start(), m.end()) for m in LINE.finditer(data, start, end))}
    for a, z in sorted(pieces):
        chars = BREAK.sub(b"", data[a:z])
        if len(chars) >= 16:
            for skip in range(4):
                got = _decoded(chars[skip:])
                if WORTH.search(got):
                    yield a, z, skip, got


def _unwrap(layer: Layer) -> Iterator[Layer]:
    """Every layer directly inside this one."""
    data = layer.data
    if b"%" in data:
        cuts = [(m.start(), m.end(), bytes([int(m[1], 16)])) for m in PERCENT.finditer(data)]
        if cuts:
            yield layer.rewritten(cuts, "url")
    if b"\\" in data or b"&#" in data:
        cuts = _escapes(data)
        if cuts:
            yield layer.rewritten(cuts, "unicode")
    if b"\0" in data:
        for name, pattern, n, at in WIDE:
            for m in pattern.finditer(data):
                a, z = m.span()
                yield Layer(data[a + at:z:n], layer.begin[a:z:n], layer.end[a + n - 1:z:n], (*layer.chain, name))
    for m in RUN.finditer(data):
        for a, z, skip, got in _readings(data, *m.span()):
            breaks = np.zeros(z - a, bool)
            for x in BREAK.finditer(data, a, z):
                breaks[x.start() - a:x.end() - a] = True
            char = a + np.flatnonzero(~breaks)[skip:]
            byte = np.arange(len(got))
            yield Layer(got, layer.begin[char[byte * 4 // 3]], layer.end[char[byte * 4 // 3 + 1]], (*layer.chain, "base64"))
    done = 0
    for m in PACKED.finditer(data):
        if m.start() < done:
            continue
        src = Inflate(Bytes(data, m.start()))
        while src.read(WINDOW):
            pass
        if src.state == "ended":
            done = m.start() + src.used
        for part, more in _windows(Inflate(Bytes(data, m.start()))):
            if WORTH.search(part):
                yield layer.inner(m.start(), m.start() + src.used, part, "inflate", *more)


def search(data: bytes) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, str]]]:
    """(base spans, spans found in decoded layers with their chain), in byte positions of ``data``."""
    base = scan(data)
    at = np.arange(len(data))
    work, seen = [iter([Layer(data, at, at + 1)])], {hashlib.blake2b(data).digest()}
    known, found = set(base), []
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if layer.chain:
            mark = hashlib.blake2b(layer.data + b"@%d" % (layer.begin[0] if len(layer.begin) else 0)).digest()
            if mark in seen:  # a cycle, or the same layer reached twice
                continue
            seen.add(mark)
            for a, kind, z in scan(layer.data):
                x, y = layer.place(a, z)
                if (x, kind, y) not in known:
                    known.add((x, kind, y))
                    found.append((x, kind, y, ">".join(layer.chain)))
        work.append(_unwrap(layer))
    return base, sorted(found)


def _suspects(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Documents of a block that can hold a base span or an encoded layer."""
    data = raw.tobytes()
    low, out = data.lower(), np.zeros(len(off) - 1, bool)

    def mark(places) -> None:
        if len(places):
            out[np.searchsorted(off, places, "right") - 1] = True

    for hay, word in [*((low, w) for w in WORDS), (data, b"AKIA"), (data, b"\\u"), (data, b"\\x"), (data, b"&#"), (data, b"\0")]:
        mark([m.start() for m in re.finditer(re.escape(word), hay)])
    mark([m.start() for m in PACKED.finditer(data)])
    mark([m.start() for m in PERCENT.finditer(data)])
    start, end, _ = B.spans(raw, off, HEX_BYTE)
    mark(start[end - start >= 16])
    for m in RUN.finditer(data):
        if m.end() - m.start() >= 16:
            first, last = np.searchsorted(off, (m.start(), m.end() - 1), "right") - 1
            if first < last or next(_readings(data, *m.span()), None):
                out[first:last + 1] = True
    return out


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, base and added: arrays of struct(kind, start, end) (added also with its ``chain`` of decodings).

    Positions are code points of the original text, end exclusive; both
    arrays are ordered by start, then kind as in ``KINDS``. A span found in a
    decoded layer is reported at the text its bytes came from.

    Null and empty texts have no spans. Layers are unwrapped to a fixpoint;
    one already seen at the same place is skipped, so cyclic encodings end.
    Base64 is read over line ends and at all four alignments, whatever bytes
    it gives; a byte stands for the characters it was decoded from.
    Decompressed data is scanned in overlapping windows, so memory is bounded
    whatever it expands to; streams and base64 runs that go on beyond a window
    are decoded on from there, URL and Unicode escapes per window. Rows are judged one by one (repeated rows get
    equal results); other columns are not read. An empty table gives an empty
    result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    more = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("chain", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, off in B.blocks(batches, "__text"):
            base, added = [[]] * batch.num_rows, [[]] * batch.num_rows
            for i in np.flatnonzero(_suspects(raw, off)).tolist():
                mine = raw[off[i]:off[i + 1]]
                got, extra = search(mine.tobytes())
                if got or extra:
                    chars = np.concatenate([[0], np.cumsum((mine & 0xC0) != 0x80)])
                    base[i] = [{"kind": KINDS[k], "start": int(chars[a]), "end": int(chars[z])} for a, k, z in got]
                    added[i] = [{"kind": KINDS[k], "start": int(chars[a]), "end": int(chars[z]), "chain": c}
                                for a, k, z, c in extra]
            yield B.as_table(doc_id=B.ids(batch), base=pa.array(base, pa.list_(span)), added=pa.array(added, pa.list_(more)))

    schema = (f"doc_id {kind}, base array<struct<kind:string,start:bigint,end:bigint>>, "
              "added array<struct<kind:string,start:bigint,end:bigint,chain:string>>")
    return docs.select("doc_id", F.col(text).alias("__text")).mapInArrow(run, schema)
