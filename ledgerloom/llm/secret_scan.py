r"""Secret scan with a recursive decoding worklist.

Every text is scanned for secrets of three kinds. Then encoded stretches are looked for: URL escapes,
Unicode and HTML escapes, base64, and what base64 hides when it unpacks as gzip, zlib, bzip2 or xz. Each
stretch is decoded to a layer of its own, which is put on a worklist, scanned in its turn and searched for
further layers, until nothing new appears. A layer with the same text from the same place as one before is not taken
up again: escapes only shorten a layer and all that lies below base64 has one place, so cycles end, and a stretch that is
repeated in the text is reported wherever it stands.
Escapes are undone over the whole layer, because they often cover only part of a secret, and every
character of a layer knows the stretch of the original text that it came from: spans found in a layer are
reported there, as ``layer/kind``.

Runs of base64 are read line by line and over line ends, and at all four alignments, so that what stands before or
behind them (a path, a key, a dash) does no harm. Compressed data may have several members. It is unpacked in pieces of
about ``PIECE`` bytes that end where nothing can go on, so a bomb costs time and as much memory as its longest unbroken
run of base64 or escape characters.

Defined results: a null or empty text has no spans; repeated rows count each for itself; other columns are
kept as they are by ``redact``.
"""

from __future__ import annotations

import binascii
import bisect
import bz2
import hashlib
import html
import itertools
import lzma
import re
import zlib
from collections.abc import Generator, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import map_texts, small_batches

# The base patterns and the least length of what they must catch.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex")
ASSIGN_VALUE = 12

URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+", re.A)
UNICODE = re.compile(r"\\u\{[0-9A-Fa-f]{1,6}\}|(?:\\u[0-9A-Fa-f]{4})+|\\U[0-9A-Fa-f]{8}|(?:\\x[0-9A-Fa-f]{2})+|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};", re.A)
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}", re.A)
# a run over line ends, also written as \n, with up to 64 blanks beside a line end
LINE_END = re.compile(r"(?:[\x20\t]{0,64}(?:\r?\n|(?:\\r)?\\n))+[\x20\t]{0,64}", re.A)
WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]+(?:{LINE_END.pattern}[A-Za-z0-9+/_-]+)+={{0,2}}", re.A)
CODED = re.compile(r"[A-Z0-9+/_-]")      # a run without any of these is taken for a word
JOINT = re.compile(r"[/_-]")
MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9]1AY&SY|\xfd7zXZ\x00")
# every secret and every encoded one is 16 ASCII characters or more, one beside the other
STRETCH = re.compile(rb"[\t\n\r\x20-\x7e]{16,}")
# in unpacked data: a byte that is in no secret and no encoded stretch, or blanks between two words
BREAK = re.compile(rb"""[^A-Za-z0-9+/_.=%\\{}&#;:"'\r\n\t\x20-]|(?<=[^\s:="'])[\x20\t]{1,64}(?=[^\s:="'])""")
SPACES = re.compile(rb"\x20{65,}")
PIECE, FED = 1 << 20, 1 << 16
WORDS_OF_ASSIGN = ("password", "passwd", "secret", "token", "api")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base secrets, by start, then in the order of ``KINDS``."""
    found = []
    lower = text.lower()
    if any(w in lower for w in WORDS_OF_ASSIGN):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


@dataclass
class Layer:
    """A decoded text. ``origin`` maps its characters to the original: runs of (first character in the layer, start in the
    original, and the original's end for a run that was decoded as a whole, or None for one copied as it was)."""

    name: str
    text: str
    origin: list[tuple[int, int, int | None]]

    def __post_init__(self):
        self.firsts = [first for first, _, _ in self.origin]

    def span(self, start: int, end: int) -> tuple[int, int]:
        """Where a stretch stands in the original. Runs are in its order, so the first and the last one tell."""
        first, low, whole = self.origin[bisect.bisect_right(self.firsts, start) - 1]
        if whole is None:
            low += start - first
        first, at, high = self.origin[bisect.bisect_left(self.firsts, end) - 1]
        return low, at + end - first if high is None else high


def merged(origin: list[tuple[int, int, int | None]]) -> list[tuple[int, int, int | None]]:
    """The same origin in as few runs as possible."""
    out = origin[:1]
    for first, at, whole in origin[1:]:
        before = out[-1]
        if whole != before[2] or at != (before[1] if whole is not None else before[1] + first - before[0]):
            out.append((first, at, whole))
    return out


def undone(layer: Layer, pattern: re.Pattern, decode, name: str) -> Layer | None:
    """The layer with every match of an escape pattern replaced by what it stands for."""
    out, origin, size, last = [], [], 0, 0
    for m in pattern.finditer(layer.text):
        plain = decode(m.group())
        if plain is None:
            continue
        if m.start() > last:
            origin += pieces(layer, last, m.start(), size)
            out.append(layer.text[last:m.start()])
            size += m.start() - last
        if plain:
            origin.append((size, *layer.span(m.start(), m.end())))
        out.append(plain)
        size += len(plain)
        last = m.end()
    if not last:
        return None
    origin += pieces(layer, last, len(layer.text), size)
    out.append(layer.text[last:])
    return Layer(name, "".join(out), merged(origin))


def pieces(layer: Layer, start: int, end: int, size: int) -> list[tuple[int, int, int | None]]:
    """The origin of a stretch, as runs whose first characters are counted from ``size``."""
    if start >= end:
        return []
    low, high = bisect.bisect_right(layer.firsts, start) - 1, bisect.bisect_left(layer.firsts, end)
    first, at, whole = layer.origin[low]
    out = [(size, at + start - first if whole is None else at, whole)]
    shift = size - start
    out += [(first + shift, at, whole) for first, at, whole in layer.origin[low + 1:high]]
    return out


def url(s: str) -> str | None:
    try:
        return bytes.fromhex(s.replace("%", "")).decode()
    except (ValueError, UnicodeDecodeError):
        return None


def unescape(s: str) -> str | None:
    if s.startswith("&#"):
        return html.unescape(s)
    try:
        if s.startswith("\\x"):
            return bytes.fromhex(s.replace("\\x", "")).decode()
        if s.startswith("\\u{"):
            return chr(int(s[3:-1], 16))
        if s.startswith("\\U"):
            return chr(int(s[2:], 16))
        return bytes.fromhex(s.replace("\\u", "")).decode("utf-16-be")
    except (ValueError, OverflowError, UnicodeDecodeError):
        return None


def opener(data: bytes):
    """A decompressor for data that begins like a compressed one, or None."""
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    # method 8, window of 32 KB at most, no dictionary, check bits
    if len(data) > 1 and data[0] & 15 == 8 and data[0] >> 4 < 8 and not data[1] & 32 and (data[0] << 8 | data[1]) % 31 == 0:
        return zlib.decompressobj()
    return None


def unpacked(data: bytes) -> Generator[bytes, None, int]:
    """Compressed data piece by piece, one member or stream after the other; nothing if it isn't compressed.
    Returns the number of bytes that were read."""
    at = 0
    while (unpacker := opener(data[at:at + 6])) is not None:
        rest, at = data[at:at + FED], at + FED
        try:
            while not unpacker.eof:
                piece = unpacker.decompress(rest, PIECE)
                rest = getattr(unpacker, "unconsumed_tail", b"")
                if piece:
                    yield piece
                if not unpacker.eof and not rest and getattr(unpacker, "needs_input", True):
                    if at >= len(data) and not piece:
                        return len(data)
                    rest, at = data[at:at + FED], at + FED
        except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError):
            return len(data)
        at = min(at, len(data)) - len(unpacker.unused_data)
        while data[at:at + 1] == b"\0":      # members may be padded
            at += 1
    return at


def packed_size(data: bytes) -> int:
    pieces_of = unpacked(data)
    while True:
        try:
            next(pieces_of)
        except StopIteration as done:
            return done.value


def whole_runs(data: Iterator[bytes]) -> Iterator[str]:
    """Unpacked data as texts of about ``PIECE`` bytes, cut only where no secret and no encoded stretch can go on."""
    held, looked = bytearray(), 0
    for piece in data:
        held += SPACES.sub(b" " * 64, piece)      # places inside don't matter, as all that is unpacked has one origin
        if len(held) < PIECE:
            continue
        at = 0
        for low in (max(len(held) - 4096, looked), looked):
            for m in BREAK.finditer(held, low):
                at = m.start()
            if at:
                break
        if at:
            yield held[:at].decode(errors="replace")
            del held[:at]
        looked = max(len(held) - 70, 1)
    if held:
        yield held.decode(errors="replace")


def as_text(data: bytes) -> str | None:
    """Bytes as text, if they are: valid UTF-8 almost without control characters."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    odd = sum(c < " " and c not in "\t\n\r" or c == "\x7f" for c in text)
    return text if text and odd * 20 <= len(text) else None


def from_base64(run: str, starts: list[int]) -> Iterator[tuple[str, int, int, str]]:
    """(layer name, start, end, text) of what a run of base64 characters hides, at every alignment: text, stretches of text
    after a prefix or before a suffix, and compressed data from the beginning, the given ``starts``, or behind a joint."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    places = [[0], [], [], []]
    for s in itertools.chain(starts, (m.end() for m in JOINT.finditer(run))):
        places[s % 4].append((s - s % 4) // 4 * 3)
    for shift in range(min(4, len(body))):
        size = (len(body) - shift) // 4 * 4 + (0, 0, 2, 3)[(len(body) - shift) % 4]
        if size < 2:
            continue
        data = binascii.a2b_base64(body[shift:shift + size] + "=" * (-size % 4))
        packed = set(places[shift])
        packed.update(m.start() for m in MAGIC.finditer(data) if m.start() % 3 == 0)
        whole = True
        for s in sorted(packed):
            if opener(data[s:s + 6]) is None:
                continue
            read = s + packed_size(data[s:])
            end = len(run) if read == len(data) else shift + -(-read // 3) * 4
            for text in whole_runs(unpacked(data[s:])):
                whole = whole and s > 0
                yield "packed", shift + s // 3 * 4, min(end, len(run)), text
        if shift == 0 and whole and (text := as_text(data)):
            yield "base64", 0, len(run), text
            continue
        for m in STRETCH.finditer(data):
            end = len(run) if m.end() == len(data) else shift + -(-m.end() * 4 // 3)
            yield "base64", shift + m.start() * 4 // 3, end, m.group().decode()


def base64_layers(layer: Layer) -> Iterator[Layer]:
    for m in BASE64.finditer(layer.text):
        run = m.group()
        if CODED.search(run, 1):
            for name, a, b, plain in from_base64(run, []):
                yield Layer(name, plain, [(0, *layer.span(m.start() + a, m.start() + b))])
    if "\n" not in layer.text and "\\n" not in layer.text:
        return
    for m in WRAPPED.finditer(layer.text):
        lines, places, last = [], [], 0
        for x in [*LINE_END.finditer(m.group()), None]:
            end = x.start() if x else len(m.group())
            lines.append(m.group()[last:end])
            places.append(m.start() + last)
            last = x.end() if x else end
        run = "".join(lines)
        if len(run) < 16 or not CODED.search(run, 1):
            continue
        first = list(itertools.accumulate(map(len, lines[:-1]), initial=0))

        def place(i: int) -> int:
            line = bisect.bisect_right(first, i) - 1
            return places[line] + i - first[line]

        for name, a, b, plain in from_base64(run, first):
            yield Layer(name, plain, [(0, *layer.span(place(a), place(b - 1) + 1))])


def below(layer: Layer) -> Iterator[Layer]:
    """The layers right below one."""
    if "%" in layer.text and (found := undone(layer, URL, url, "url")):
        yield found
    if ("\\" in layer.text or "&#" in layer.text) and (found := undone(layer, UNICODE, unescape, "unicode")):
        yield found
    yield from base64_layers(layer)


def layers(text: str) -> Iterator[Layer]:
    """All layers below a text, each once for every place it comes from, depth first until nothing new appears."""
    todo, seen = [below(Layer("", text, [(0, 0, None)]))], set()
    while todo:
        found = next(todo[-1], None)
        if found is None:
            todo.pop()
            continue
        key = (hashlib.blake2b(found.text.encode(errors="surrogatepass"), digest_size=16).digest(), tuple(found.origin))
        if key not in seen:
            seen.add(key)
            yield found
            todo.append(below(found))


def all_spans(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base, further) spans in the original text. A further span stands in a layer and in no base span of its kind."""
    base = base_spans(text)
    have, more = set(base), set()
    for layer in layers(text):
        for start, end, kind in base_spans(layer.text):
            at = layer.span(start, end)
            if (*at, kind) not in have:
                more.add((*at, f"{layer.name}/{kind}"))
    return base, sorted(more)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id and ``base`` and ``more``, lists of (start, end, kind) in code points."""

    def per_batch(batch: pa.RecordBatch):
        found = [all_spans(t or "") for t in batch.column(1).to_pylist()]
        as_rows = lambda spans: [{"start": a, "end": b, "kind": k} for a, b, k in spans]
        yield {"doc_id": batch.column(0), "base": [as_rows(b) for b, _ in found], "more": [as_rows(m) for _, m in found]}

    kind = docs.schema[doc_id].dataType.simpleString()
    spans = "array<struct<start: long, end: long, kind: string>>"
    return map_texts(docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")), per_batch, f"doc_id {kind}, base {spans}, more {spans}")


def redacted(text: str, mark: str) -> str:
    base, more = all_spans(text)
    out, last = [], 0
    for start, end, _ in sorted(base + more):
        if start >= last:
            out += [text[last:start], mark]
        last = max(last, end)
    return "".join(out) + text[last:]


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs`` with every secret replaced by ``mark``; overlapping spans get one mark. A null text stays null."""
    small_batches(docs.sparkSession)
    schema = docs.schema
    has_length = length in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            old = batch.column(at).to_pylist()
            new = [t if t is None else redacted(t, mark) for t in old]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if has_length:
                n = batch.schema.get_field_index(length)
                sizes = [was if a == b else len(b) for a, b, was in zip(old, new, columns[n].to_pylist())]
                columns[n] = pa.array(sizes, batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, schema)
