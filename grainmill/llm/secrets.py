"""Secret scan with a recursive decoding worklist.

A text is layer zero. From every layer others follow: its percent, Unicode and numeric character
escapes decoded, its base64 runs opened (and, where the bytes carry a compression magic,
inflated, as often as they do). Consecutive lines are one base64 run; a run that does not open from
its first character is read in all four phases, and archives are tried after each ``/``, ``-`` and
``_`` in it. A layer whose text was seen before is not taken up again (digests are kept, not
texts), so the worklist ends at a fixpoint even if an archive inflates to itself. Every layer is
scanned for the same three kinds of secret and a finding's span is mapped back, layer by layer, to
code points of the original text: text that was copied maps to its own place, decoded text to the
whole escape or run it came from.

Where a decoded character completes another escape with the characters beside it (``%252541``), that
chain is followed to its end in the same step: every further layer then needs twice the escapes of
the one below, so a text of n characters has O(log n) of them and takes O(n log n) steps. No pattern
holds an escape's first character, so what a finding could have in between is a part of the digits
of one that stood in the layer above.

Defined results: null text counts as empty and has no findings; equal findings reached by several
layers count once; repeated rows each get their row; an empty table gives an empty result; extra
columns are ignored by the scan and kept by ``redact``. Opened bytes that are no clean UTF-8 text
are scanned all the same, as Latin-1 or UTF-16 with their control characters, as are all members of
an archive, what follows them, and the readable part of a cut or damaged one. An archive of more
than ``HELD`` bytes is scanned as a stream, in windows that overlap, at constant memory. What a
document's archives inflate to in all ends at ``MAX_INFLATE`` (bombs nest to petabytes); ``n_unopened``
counts the runs where that was met, or with an archive that is not readable to its end.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import urllib.parse
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.common import batches, ship, text_or_empty

KINDS = ("assign", "access", "hex")
HELD, WINDOW, OVERLAP, MAX_INFLATE = 32 << 20, 8 << 20, 64 << 10, 4 << 30

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_WORDS = ("password", "passwd", "secret", "token", "api")

_RUN = r"(?:%[0-9A-Fa-f]{2})+"
_UNICODE = r"\\u([dD][89abAB][0-9a-fA-F]{2})\\u([dD][c-fC-F][0-9a-fA-F]{2})|(?:\\u|%u)([0-9a-fA-F]{4})|\\u\{([0-9a-fA-F]{1,6})\}|\\U([0-9a-fA-F]{8})|\\x([0-9a-fA-F]{2})|&#[xX]([0-9a-fA-F]{1,6});|&#([0-9]{1,7});"
_ESCAPE = re.compile(rf"{_UNICODE}|({_RUN})")
_ONE = re.compile(rf"{_UNICODE}|(%[0-9A-Fa-f]{{2}})")
_WIDE_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2}){28,}")
_LONGEST = 12  # characters of the longest single escape
_QUOTED = re.compile(r"(?:%1[fF]%8[bB]%08|BZh[1-9]1AY%26SY|%[fF][dD]7zXZ%00|%28%[bB]5(?:/|%2[fF])%[fF][dD]|PK%03%04|(?:%5[dD]|\])%00%00%|(?<![0-9A-Za-z])x(?:%01|%5[eE]|%9[cC]|%[dD][aA]|\^))(?:[A-Za-z0-9_.~/+-]|%[0-9A-Fa-f]{2})+")
_LINE = r"[ \t]*(?:\r?\n|\r|(?:\\r)?\\n)[ \t>]*"
_BREAK = re.compile(_LINE)
_BASE64 = re.compile(rf"(?<![\w+/-])(?:[\w+/-]{{16,}}+|[\w+/-]++(?={_LINE}[\w+/-]))(?:{_LINE}[\w+/-]++)*+={{0,2}}", re.A)
_SEGMENT = re.compile(r"[^/_-]*[/_-]*")
_MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9]1AY&SY|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|PK\x03\x04|\x5d\x00\x00[\x00\x01\x02\x04\x08\x10\x20\x40\x80][\x00-\x04]")
_FIRST = re.compile(rb"(?s).")
_WIDE = re.compile(rb"(?:[\t\n\r\x20-\x7e]\x00){14}|(?:\x00[\t\n\r\x20-\x7e]){14}")
_DAMAGE = (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError)
_ZSTD = type(zstandard.ZstdDecompressor().decompressobj())
_LEGIBLE = re.compile(rb"[\t\n\r\x20-\x7e]{14,}")  # the shortest finding, token=12345678
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f￾￿]")


#: Stands for a finding of each kind in a window of a streamed archive.
_SIGNS = ("token=00000000", "AKIA000000000000", "0" * 32)


class TooLarge(Exception):
    """An archive inflates to more than is held at once."""


class Purse:
    """What one document's archives may still inflate to."""

    def __init__(self, left: int = 0):
        self.left = left or MAX_INFLATE

    def pay(self, n: int) -> bool:
        self.left -= n
        return self.left >= 0


def scan(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns, leftmost and non-overlapping within a kind."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _decompressor(head: bytes):
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00" or head[:3] == b"\x5d\x00\x00":
        return lzma.LZMADecompressor()
    if head[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor().decompressobj()
    if head[:4] == b"PK\x03\x04" and len(head) >= 30:
        return zlib.decompressobj(-15) if head[8] == 8 else None
    if len(head) > 2 and head[0] == 0x78 and (head[0] * 256 + head[1]) % 31 == 0:
        return zlib.decompressobj(15)
    return None


def _begin(data: bytes) -> int:
    """Where the compressed bytes begin: behind a zip member's header."""
    return 30 + int.from_bytes(data[26:28], "little") + int.from_bytes(data[28:30], "little") if data[:4] == b"PK\x03\x04" else 0


def _pull(d, piece: bytes) -> bytes:
    return d.decompress(piece) if isinstance(d, _ZSTD) else d.decompress(piece, HELD + 1)


def _stream(data: bytes) -> tuple[bytes, bytes, bool] | None:
    """One compressed stream's bytes, what follows it, and whether it was whole; None if there is none.

    Of a cut or damaged stream come the bytes that can still be read.
    """
    if (d := _decompressor(data[:30])) is None:
        return None
    out, size, step = [], 0, 256
    for at in range(_begin(data), len(data), step):
        before = d.copy() if hasattr(d, "copy") else None
        piece, failed = data[at : at + step], False
        try:
            out.append(_pull(d, piece))
            size += len(out[-1])
        except _DAMAGE:
            failed = True
            for k in range(len(piece) if before is not None else 0):  # up to the damaged byte
                try:
                    out.append(_pull(before, piece[k : k + 1]))
                    size += len(out[-1])
                except _DAMAGE:
                    break
        if size > HELD:
            raise TooLarge
        if failed:
            break
        if d.eof:
            return b"".join(out), d.unused_data + data[at + step :], True
    got = b"".join(out)
    return (got, b"", False) if got or _MAGIC.match(data) else None


def _inflate(data: bytes) -> bytes | None:
    """The bytes one compression layer down, all members joined; None unless every stream is whole."""
    out, size = [], 0
    while data.strip(b"\0"):
        if (got := _stream(data)) is None or not got[2]:
            return None
        out.append(got[0])
        size += len(got[0])
        if size > HELD:
            raise TooLarge
        data = got[1]
    return b"".join(out) if out else None


def _windows(data: bytes, purse: Purse) -> Iterator[bytes | None]:
    """A large stream's bytes in overlapping windows; None where it ends early."""
    d, held = _decompressor(data[:30]), b""
    bounded = not isinstance(d, _ZSTD)
    at, step, rest = _begin(data), 1 << 12, b""
    try:
        while not d.eof and (rest or at < len(data)):
            piece, at = (rest, at) if rest else (data[at : at + step], at + step)
            got = d.decompress(piece, WINDOW) if bounded else d.decompress(piece)
            rest = d.unconsumed_tail if hasattr(d, "unconsumed_tail") else b""
            while True:
                if not purse.pay(len(got)):
                    yield None
                    return
                held += got
                if len(held) >= WINDOW:
                    yield held
                    held = held[-OVERLAP:]
                if hasattr(d, "needs_input") and not d.needs_input and not d.eof:
                    got = d.decompress(b"", WINDOW)
                else:
                    break
        if held:
            yield held
        if not d.eof:
            yield None
    except _DAMAGE:
        yield held
        yield None


def _streamed(data: bytes, purse: Purse) -> tuple[str, int]:
    """A sign for every kind of secret in an archive too large to hold, and whether it was cut."""
    kinds: set[int] = set()
    lost, seen = 0, set()
    for window in _windows(data, purse):
        if window is None:
            lost = 1
            continue
        if (digest := hashlib.blake2b(window, digest_size=16).digest()) in seen:
            continue
        seen.add(digest)
        for text in (window.decode("latin-1"), *_wide(window)):
            _, spans, missed = find(text, purse)
            kinds |= {k for _, k, _ in spans}
            lost |= missed > 0
    return " ".join(_SIGNS[k] for k in sorted(kinds)), lost


def open_bytes(data: bytes, purse: Purse) -> str | None:
    """Text behind some bytes: inflate until nothing is compressed, then plain UTF-8 or None."""
    seen = set()
    while (digest := hashlib.sha256(data).digest()) not in seen:
        seen.add(digest)
        if (inner := _inflate(data)) is None:
            break
        if not purse.pay(len(inner)):
            raise TooLarge
        data = inner
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return None if not text or _CONTROL.search(text) else text


def _deflated(data: bytes) -> bytes | None:
    """Bytes deflated without a header, if they are whole and legible."""
    d = zlib.decompressobj(-15)
    try:
        out = d.decompress(data, HELD)
    except zlib.error:
        return None
    return out if d.eof and not d.unused_data.strip(b"\0") and _LEGIBLE.search(out) else None


def salvage(data: bytes, purse: Purse) -> tuple[list[str], int]:
    """Readings of what is inside bytes, and the count of streams not read to their end.

    Archives are opened wherever their magic stands, inside each other too, and read as far as they
    go. Bytes are read as Latin-1 (the patterns are ASCII), control characters staying between the
    words, and as UTF-16 where they look like it; the bytes given are for the caller to read as
    Latin-1. Bytes without a legible stretch give no reading.
    """
    first, texts, lost, seen, work = data, _wide(data), 0, set(), [data]
    if (inner := _deflated(data)) is not None:
        work.append(inner)
    while work:
        data = work.pop()
        if (digest := hashlib.sha256(data).digest()) in seen:
            continue
        seen.add(digest)
        at, members = 0, []
        while m := (_MAGIC.search(data, at) if at or _decompressor(data[:30]) is None else _FIRST.match(data)):
            at = m.start() + 1
            try:
                if (got := _stream(data[m.start() :])) is None:
                    continue
            except TooLarge:
                sign, cut = _streamed(data[m.start() :], purse)
                texts += [sign] if sign else []
                lost += cut
                continue
            inner, rest, whole = got
            if not purse.pay(len(inner)):
                lost += 1
                continue
            members.append(inner)
            if whole:
                at = len(data) - len(rest)
                if rest[:1] == b"\x78":
                    work.append(rest)
            else:
                lost += len(inner) >= 14 or _MAGIC.match(data, m.start()) is not None
        work += members
        if len(members) > 1:
            work.append(b"".join(members))
        if data is not first:
            texts += _wide(data)
            if _LEGIBLE.search(data):
                texts.append(data.decode("latin-1"))
    return texts, lost


def _wide(data: bytes) -> list[str]:
    """Both alignments of bytes that look like UTF-16."""
    return [(data[k:] + b"\0" * ((len(data) - k) % 2)).decode("utf-16-le", "replace") for k in (0, 1)] if _WIDE.search(data) else []


class Layer:
    """A decoded text and where its decoded pieces come from in the layer above."""

    def __init__(self, above: Layer | None, text: str, pieces: list[tuple[int, int, int, int]]):
        self.above, self.text, self.pieces = above, text, pieces
        self.starts = [p[0] for p in pieces]

    def _up(self, at: int) -> tuple[int, int]:
        """The range in the layer above of the code point ``at``."""
        i = bisect_right(self.starts, at) - 1
        if i < 0:
            return at, at + 1
        _, end, src, src_end = self.pieces[i]
        if at < end:
            return src, src_end
        return at - end + src_end, at - end + src_end + 1

    def origin(self, start: int, end: int) -> tuple[int, int]:
        layer = self
        while layer.above is not None:
            start, end = layer._up(start)[0], layer._up(end - 1)[1]
            layer = layer.above
        return start, end


def _replaced(layer: Layer, swaps: list[tuple[int, int, str]]) -> Layer | None:
    if not swaps:
        return None
    out, pieces, at, size = [], [], 0, 0
    for start, end, new in swaps:
        out.append(layer.text[at:start])
        size += start - at
        if new:
            pieces.append((size, size + len(new), start, end))
        out.append(new)
        size += len(new)
        at = end
    out.append(layer.text[at:])
    return Layer(layer, "".join(out), pieces)


def _value(m: re.Match) -> tuple[int, bool]:
    """Code point or byte of a single escape, and whether it is a byte."""
    if m[1]:
        return 0x10000 + ((int(m[1], 16) - 0xD800) << 10) + int(m[2], 16) - 0xDC00, False
    if m[8]:
        return int(m[8]), False
    if m[9]:
        return int(m[9][1:], 16), True
    return int(m[3] or m[4] or m[5] or m[6] or m[7], 16), False


def _chained(text: str, start: int, end: int, code: int, byte: bool, floor: int) -> tuple[int, int, int, bool]:
    """Follow a decoded character through the escapes that it completes with the text beside it."""
    while code < 0x80:
        c = chr(code)
        if c in "%\\&" and (m := _ONE.match(c + text[end : end + _LONGEST])):
            (code, byte), end = _value(m), end + m.end() - 1
            continue
        if c in "0123456789abcdefABCDEFuUxX{}#;" and start > floor:
            left = text[max(floor, start - _LONGEST + 1) : start]
            if (i := max(left.rfind("%"), left.rfind("\\"), left.rfind("&"))) >= 0 and (m := _ONE.match(left[i:] + c + text[end : end + _LONGEST])) and m.end() > len(left) - i:
                (code, byte), start, end = _value(m), start - (len(left) - i), end + m.end() - (len(left) - i) - 1
                continue
        break
    return start, end, code, byte


def _escapes(layer: Layer, missed: set[tuple[int, int]], purse: Purse) -> list[Layer]:
    """The layer with its escapes decoded, and readings of archives spelt in percent escapes."""
    text = layer.text
    if "%" not in text and "\\" not in text and "&#" not in text:
        return []
    swaps: list[tuple[int, int, str]] = []
    bytes_: list[tuple[int, int, int]] = []  # adjacent ones, for UTF-8
    floor = at = 0

    def flush() -> None:
        if not bytes_:
            return
        data = bytes(b for _, _, b in bytes_)
        try:
            chars, i = data.decode("utf-8"), 0
            for c in chars:
                n = len(c.encode())
                swaps.append((bytes_[i][0], bytes_[i + n - 1][1], c))
                i += n
        except UnicodeDecodeError:
            swaps.extend((a, b, chr(x)) for a, b, x in bytes_)
        bytes_.clear()

    while m := _ESCAPE.search(text, at):
        start, end = m.span()
        if bytes_ and start != floor:
            flush()
        if m[9] and end - start > 3:  # all but the last escape of a run
            data = bytes.fromhex(m[9].replace("%", ""))
            bytes_.extend((start + 3 * i, start + 3 * i + 3, x) for i, x in enumerate(data[:-1]))
            floor, start, code, byte = end - 3, end - 3, data[-1], True
        else:
            code, byte = _value(m)
        start, end, code, byte = _chained(text, start, end, code, byte, floor)
        floor = at = end
        if byte:
            bytes_.append((start, end, code))
        else:
            flush()
            if code < 0x110000 and not 0xD800 <= code < 0xE000:
                swaps.append((start, end, chr(code)))
    flush()
    out = [] if (whole := _replaced(layer, swaps)) is None else [whole]
    if "%" in text:
        for m in _QUOTED.finditer(text):
            out += _salvaged(layer, urllib.parse.unquote_to_bytes(m[0].replace("+", " ")), m.start(), m.end(), missed, purse)
        for m in _WIDE_RUN.finditer(text):
            out += [Layer(layer, t, [(0, len(t), m.start(), m.end())]) for t in _wide(bytes.fromhex(m[0].replace("%", "")))]
    return out


def _salvaged(layer: Layer, data: bytes, start: int, end: int, missed: set[tuple[int, int]], purse: Purse) -> list[Layer]:
    texts, lost = salvage(data, purse)
    if lost:
        missed.add(layer.origin(start, end))
    return [Layer(layer, t, [(0, len(t), start, end)]) for t in texts if t]


class _Run(Layer):
    """Bytes of a base64 run read from its ``phase``-th character on, one code point each.

    A place maps to the segments (``(first character of the run, start, end in the layer above)``,
    cut at line breaks and at ``/``, ``-`` and ``_``) that its byte is spelt in.
    """

    def __init__(self, above: Layer, data: bytes, phase: int, segments: list[tuple[int, int, int]]):
        super().__init__(above, data.decode("latin-1"), [])
        self.phase, self.segments, self.firsts = phase, segments, [s[0] for s in segments]

    def _up(self, at: int) -> tuple[int, int]:
        first, last = self.phase + at * 8 // 6, self.phase + (at * 8 + 7) // 6
        return self.segments[bisect_right(self.firsts, first) - 1][1], self.segments[bisect_right(self.firsts, last) - 1][2]


def _decoded(run: str) -> bytes:
    """The bytes of a run in either alphabet; a last character that ends no byte is left out."""
    run = run[: len(run) - (len(run) % 4 == 1)].replace("-", "+").replace("_", "/")
    return binascii.a2b_base64(run + "=" * (-len(run) % 4))


def _lines(m: re.Match) -> list[tuple[int, int, str]]:
    """``(start, end, characters)`` of a match's lines; the padding belongs to the last."""
    out, at = [], m.start()
    for b in _BREAK.finditer(m[0]):
        out.append((at, m.start() + b.start(), m.string[at : m.start() + b.start()]))
        at = m.start() + b.end()
    return [*out, (at, m.end(), m.string[at : m.end()].rstrip("="))]


def _base64(layer: Layer, missed: set[tuple[int, int]], purse: Purse) -> list[Layer]:
    """The layer with its runs opened, and readings of what does not open whole.

    Consecutive lines make one run. Where it does not open from its first character, its lines are
    tried alone, and all four phases are read for legible bytes and each segment for an archive.
    """
    swaps, loose = [], []
    for m in _BASE64.finditer(layer.text):
        lines = _lines(m)
        run = "".join(r for _, _, r in lines)
        if len(run) < 16:
            continue
        for start, end, part in [(m.start(), m.end(), run)] if len(lines) == 1 else [(m.start(), m.end(), run), *lines]:
            if len(part) < 16 or len(part) % 4 == 1:
                continue
            try:
                text = open_bytes(_decoded(part), purse)
            except TooLarge:  # streamed by _readings
                continue
            if text is not None:
                swaps.append((start, end, text))
                if part is run:
                    break
        else:
            loose += _readings(layer, lines, run, missed, purse)
    return [x for x in (_replaced(layer, swaps), *loose) if x is not None]


def _readings(layer: Layer, lines: list[tuple[int, int, str]], run: str, missed: set[tuple[int, int]], purse: Purse) -> list[Layer]:
    segments, size = [], 0
    for start, end, part in lines:
        cuts = [c.start() for c in _SEGMENT.finditer(part) if c[0]]
        for a, b in zip(cuts, [*cuts[1:], None]):
            segments.append((size + a, start + a, end if b is None else start + b))
        size += len(part)
    out: list[Layer] = []
    for phase in range(4):
        if _LEGIBLE.search(data := _decoded(run[phase:])):
            out.append(_Run(layer, data, phase, segments))
        out += [Layer(layer, t, [(0, len(t), lines[0][0], lines[-1][1])]) for t in _wide(data)]
        begun = {m.start() for m in [_MAGIC.search(data)] if m}
        begun |= {at for first, _, _ in segments if first >= phase and (first - phase) % 4 == 0 and data[(at := (first - phase) // 4 * 3) : at + 1] == b"x"}
        for at in sorted(begun):
            place = bisect_right(segments, (phase + at * 4 // 3, len(layer.text))) - 1
            out += _salvaged(layer, data[at:], segments[place][1], lines[-1][1], missed, purse)
        if phase == 0 and not begun and (inner := _deflated(data)) is not None:
            out += _salvaged(layer, b"\0" + inner, lines[0][0], lines[-1][1], missed, purse)
            out.append(Layer(layer, inner.decode("latin-1"), [(0, len(inner), lines[0][0], lines[-1][1])]))
    return out


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def find(text: str, purse: Purse | None = None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int]:
    """Base spans, all spans (both ``(start, kind, end)``, sorted), runs not read to their end."""
    base = scan(text)
    spans, seen, missed, purse = set(base), {_digest(text)}, set(), purse or Purse()
    work = [Layer(None, text, [])]
    while work:
        layer = work.pop()
        if layer.above is not None:
            for start, kind, end in scan(layer.text):
                a, b = layer.origin(start, end)
                spans.add((a, kind, b))
        for nxt in (*_escapes(layer, missed, purse), *_base64(layer, missed, purse)):
            if (digest := _digest(nxt.text)) not in seen:
                seen.add(digest)
                work.append(nxt)
        layer.text = ""  # places are mapped by the pieces alone
    return base, sorted(spans), len(missed)


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_unopened long"


def _scan_batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches(it):
        rows = []
        for t in b.column(1).to_pylist():
            base, spans, missed = find(t)
            kinds = [k for _, k, _ in base]
            rows.append((kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(spell(base).encode()).hexdigest(), spell(spans), missed))
        cols = list(zip(*rows))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types))], [x.split()[0] for x in _SCHEMA.split(", ")])


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of its base findings, spans of all findings."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(_scan_batches, _SCHEMA)


def redacted(text: str) -> str:
    """The text with every maximal stretch of findings replaced by a mark that names its kinds."""
    spans = find(text)[1]
    if not spans:
        return text
    out, at, i = [], 0, 0
    while i < len(spans):
        start, kind, end = spans[i]
        kinds = {kind}
        while i + 1 < len(spans) and spans[i + 1][0] < end:
            i += 1
            end = max(end, spans[i][2])
            kinds.add(spans[i][1])
        out += [text[at:start], "<secret:" + "+".join(KINDS[k] for k in sorted(kinds)) + ">"]
        at, i = end, i + 1
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """The documents with their secrets replaced; null texts stay null, all rows and columns stay.

    ``n_chars``, if the table has it, is counted anew where the text has changed.
    """
    ship(docs.sparkSession)

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else redacted(t) for t in texts.to_pylist()], pa.string())

    new = "__clean"
    while new in docs.columns:
        new += "_"
    out = docs.withColumn(new, clean("text"))
    cols = []
    for name, kind in docs.dtypes:
        if name == "text":
            cols.append(F.col(new).alias("text"))
        elif name == "n_chars":
            cols.append(F.when(F.col(new) != F.col("text"), F.char_length(new).cast(kind)).otherwise(F.col("n_chars")).alias("n_chars"))
        else:
            cols.append(F.col(f"`{name}`"))
    return out.select(*cols)
