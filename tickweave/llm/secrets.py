"""Secret scans with a worklist of decoded layers.

Every whole text is searched for assignments of credentials, access keys and long hexadecimal strings. Then it is unwrapped:
percent-encoding and Unicode escapes are decoded over the whole layer, base64 runs, also ones wrapped over lines, and the
compressed data in them (gzip, zlib, bzip2, xz, zstandard; all members, compressed any number of times up to ``MAX_DEPTH``)
one by one. Bytes that are no UTF-8 are read as Latin-1, which leaves every character of a secret as it is. Each new layer joins the worklist and is searched and unwrapped again, until no new
layer appears; a layer seen before is not entered twice, so cycles end. What is found in a layer is mapped back to the
characters of the original text that it was decoded from.

Defined results: null and empty texts have no secrets; repeated rows give repeated rows; extra columns do not matter. The
content of compressed data above ``MAX_LAYER`` bytes is streamed and searched in overlapping stretches that are cut outside of
encoded runs. What is not decoded in one piece is counted in ``n_oversize``: encoded runs above twice ``MAX_LAYER`` within such
content, and data compressed more than ``MAX_DEPTH`` times; redaction takes out the whole run of the text that holds such data.
Decoded bytes that are not mostly printable are layers only if they hold a secret or something to decode.

Compressed content is read as a stream, and blocks of one byte that no secret and no encoding uses are shortened as they come,
so that data compressed over and over, of zeros say, cost what inflating them costs. Other content costs time in proportion to
its size, however often it was compressed to get into the text.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import gzip
import hashlib
import io
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

KINDS = ("assign", "access", "hex")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# What counts as a secret.
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2})+")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
LINE = re.compile(r"[A-Za-z0-9+/_-]++={0,2}")
LINES = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:\r?\n[A-Za-z0-9+/_-]++)+={0,2}")
MIN_BASE64 = 16
MAX_LAYER, MAX_DEPTH, BLOCK = 1 << 26, 64, 1 << 16
# 1 for the bytes at which no encoded run goes on
OUTSIDE = bytes(0 if chr(c).isascii() and chr(c).isalnum() or chr(c) in "+/_-=%\\\r\n" else 1 for c in range(256))
# bytes in no secret and no encoded run: a long run of one of them says no more than a short one
IDLE = frozenset(c for c in range(128) if OUTSIDE[c] and chr(c) not in "\"' :.")
READABLE = np.array([chr(c).isprintable() or chr(c) in "\n\r\t" for c in range(256)])
FAULTS = (zlib.error, OSError, lzma.LZMAError, zstandard.ZstdError, ValueError)


def find(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of the secrets in one layer, leftmost and non-overlapping for each kind."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


class Layer:
    """A decoded text with, for each of its characters, the stretch of the original text that it comes from."""

    __slots__ = ("text", "start", "end")

    def __init__(self, text: str, start: np.ndarray, end: np.ndarray):
        self.text, self.start, self.end = text, start, end


def _chars(data: bytes) -> tuple[str, np.ndarray, bool]:
    """The text that bytes hold, for each character the number of its first byte, and whether it is UTF-8, not Latin-1."""
    raw = np.frombuffer(data, np.uint8)
    try:
        return data.decode("utf-8"), np.flatnonzero((raw & 0xC0) != 0x80), True
    except UnicodeDecodeError:
        return data.decode("latin-1"), np.arange(len(data)), False


def _text(data: bytes) -> str:
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return data.decode("latin-1")


def _readable(text: str) -> bool:
    good = 0
    for at in range(0, len(text), 16 * BLOCK):
        codes = np.frombuffer(text[at : at + 16 * BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds, counts = np.unique(codes[codes > 255], return_counts=True)
        good += int(READABLE[codes[codes < 256]].sum()) + sum(n for c, n in zip(kinds.tolist(), counts.tolist(), strict=True) if chr(c).isprintable())
    return bool(text) and good >= 0.95 * len(text)


def _holds(text: str) -> bool:
    """Whether there is a secret or something to decode."""
    return any(p.search(text) for p in (PERCENT, ESCAPE, BASE64, LINES)) or bool(find(text))


def _replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every match of the pattern decoded, or None if nothing changes."""
    parts, starts, ends, at = [], [], [], 0
    for m in pattern.finditer(layer.text):
        text, first, last = decode(m[0])
        parts += [layer.text[at : m.start()], text]
        starts += [layer.start[at : m.start()], layer.start[m.start() + first]]
        ends += [layer.end[at : m.start()], layer.end[m.start() + last - 1]]
        at = m.end()
    if not parts:
        return None
    return Layer("".join([*parts, layer.text[at:]]), np.concatenate([*starts, layer.start[at:]]), np.concatenate([*ends, layer.end[at:]]))


def _percent(run: str):
    text, first, _ = _chars(bytes.fromhex(run.replace("%", "")))
    return text, first * 3, np.append(first[1:], len(run) // 3) * 3


def _escapes(run: str):
    units, first, at = [], [], 0
    while at < len(run):
        width = 6 if run[at + 1] == "u" else 4
        units.append(int(run[at + 2 : at + width], 16))
        first.append(at)
        at += width
    text, where, k = [], [], 0
    while k < len(units):
        u = units[k]
        if 0xD800 <= u < 0xDC00 and k + 1 < len(units) and 0xDC00 <= units[k + 1] < 0xE000:  # a pair of halves
            text.append(chr(0x10000 + ((u - 0xD800) << 10) + units[k + 1] - 0xDC00))
            where.append(first[k])
            k += 2
            continue
        text.append("�" if 0xD800 <= u < 0xE000 else chr(u))
        where.append(first[k])
        k += 1
    first = np.array(where)
    return "".join(text), first, np.append(first[1:], len(run))


class _Blocks(io.RawIOBase):
    """Blocks of bytes as a file."""

    def __init__(self, blocks: Iterator[bytes]):
        self._blocks, self._rest = blocks, b""

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while not self._rest:
            if (block := next(self._blocks, None)) is None:
                return 0
            self._rest = block
        n = min(len(into), len(self._rest))
        into[:n], self._rest = self._rest[:n], self._rest[n:]
        return n


def _inflated(source: io.BufferedReader, faults: list[str]) -> Iterator[bytes]:
    """The content of a compressed file, all members, up to its end or a fault; nothing if it isn't compressed."""
    head = source.peek(6)[:6]
    try:
        if head.startswith(b"\x1f\x8b"):
            opened = gzip.GzipFile(fileobj=source)
        elif head.startswith(b"BZh"):
            opened = bz2.BZ2File(source)
        elif head.startswith(b"\xfd7zXZ"):
            opened = lzma.LZMAFile(source)
        elif head.startswith(b"\x28\xb5\x2f\xfd"):
            opened = zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True)
        elif len(head) > 1 and head[0] & 15 == 8 and (head[0] * 256 + head[1]) % 31 == 0:
            one = zlib.decompressobj()
            while not one.eof and (raw := one.unconsumed_tail or source.read(BLOCK)):
                yield one.decompress(raw, BLOCK)
            yield one.flush()
            return
        else:
            return
        while block := opened.read1(BLOCK):
            yield block
    except EOFError:  # cut short: what came before counts
        pass
    except FAULTS as e:
        faults.append(str(e))


def _shortened(blocks: Iterator[bytes]) -> Iterator[bytes]:
    """Blocks without those that only go on with one idle byte, of which one block came before."""
    last = b""
    for block in blocks:
        if block[0] in IDLE and block.count(block[:1]) == len(block):
            if last == block[:1]:
                continue
            last = block[:1]
        else:
            last = b""
        yield block


def _windows(blocks: Iterator[bytes]) -> Iterator[tuple[bytes, bool]]:
    """Content in one piece, or if it is large in overlapping stretches; True if an encoded run had to be cut."""
    held, limit, overlap = bytearray(), MAX_LAYER, MAX_LAYER >> 4
    for block in blocks:
        held += block
        if len(held) <= limit:
            continue
        cut = held.translate(OUTSIDE).rfind(1) + 1
        if cut <= overlap and limit == MAX_LAYER:  # wait for the end of the run
            limit = 2 * MAX_LAYER
            continue
        forced = cut <= overlap
        cut = len(held) if forced else cut
        yield bytes(held[:cut]), forced
        del held[: cut - overlap]
        limit = MAX_LAYER
    if held:
        yield bytes(held), False


def _contents(data: bytes, cut: list[str]) -> Iterator[str]:
    """The texts in compressed bytes, at every depth of compression. Deeper ones are streamed anew: bounded memory."""
    met = {data}
    for depth in range(1, MAX_DEPTH + 2):
        source, faults = io.BufferedReader(io.BytesIO(data)), []
        for _ in range(depth):
            source = io.BufferedReader(_Blocks(_inflated(source, faults)), BLOCK)
        if not source.peek(1):
            return
        if depth > MAX_DEPTH:
            cut.append("depth")
            return
        for number, (window, forced) in enumerate(_windows(_shortened(iter(lambda: source.read1(BLOCK), b"")))):  # noqa: B023
            cut += ["run"] * forced
            if not number and window in met:  # compressed data that holds itself
                return
            if not number and len(window) <= BLOCK:
                met.add(window)
            text = _text(window)
            if _holds(text) or (not faults and _readable(text)):
                yield text


def _wrapped(text: str) -> Iterator[list[tuple[int, int]]]:
    """Lines that may be one base64 run: all that meet at single line breaks, and stretches of lines of one width, each with
    and without the shorter line before and after."""
    for m in LINES.finditer(text) if "\n" in text else ():
        lines = [x.span() for x in LINE.finditer(text, *m.span())]
        picks, k, n = {(0, len(lines))}, 0, len(lines)
        while k < n:
            width, j = lines[k][1] - lines[k][0], k + 1
            while j < n and lines[j][1] - lines[j][0] == width:
                j += 1
            if width >= MIN_BASE64:
                picks |= {(a, b) for a in (k, max(0, k - 1)) for b in (j, min(n, j + 1)) if b - a > 1}
            k = j
        yield from (lines[a:b] for a, b in sorted(picks))


def _from_base64(layer: Layer, run: str, where: slice | np.ndarray, told: list[tuple[int, int]]) -> Iterator[Layer]:
    """The layers in one base64 run, whose characters are those at ``where``."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        body = body[:-1]
    try:
        data = base64.b64decode(body + "=" * (-len(body) % 4))
    except (binascii.Error, ValueError):
        return
    text, first, utf8 = _chars(data)
    s, e = layer.start[where], layer.end[where]
    plain, cut = utf8 and _readable(text), []
    for content in _contents(data, cut) if not plain else ():  # where a character stems from cannot be told: all of the run
        n = len(content)
        yield Layer(content, np.broadcast_to(s[0], n), np.broadcast_to(e[-1], n))
    told += [(int(s.min()), int(e.max()))] * len(cut)
    if plain or _holds(text):
        last = np.append(first[1:], len(data)) - 1
        yield Layer(text, s[first * 4 // 3], e[np.minimum(last * 4 // 3 + 1, len(e) - 1)])


def _unwrapped(layer: Layer, told: list[tuple[int, int]]) -> Iterator[Layer]:
    """The layers directly below one; ``told`` grows by where what could not be decoded in one piece lies in the text."""
    if "%" in layer.text and (out := _replaced(layer, PERCENT, _percent)) is not None:
        yield out
    if "\\" in layer.text and (out := _replaced(layer, ESCAPE, _escapes)) is not None:
        yield out
    for m in BASE64.finditer(layer.text):
        yield from _from_base64(layer, m[0], slice(*m.span()), told)
    for lines in _wrapped(layer.text):
        run = "".join(layer.text[a:b] for a, b in lines)
        if len(run) >= MIN_BASE64:
            yield from _from_base64(layer, run, np.concatenate([np.arange(a, b) for a, b in lines]), told)


def scan_text(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], int, int]:
    """Base spans, all spans (both by start, then kind), number of decoded layers, number of runs not decoded in one piece."""
    base, spans, layers, told = _worked(text or "")
    return base, spans, layers, len(told)


def _worked(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], int, list[tuple[int, int]]]:
    order = lambda x: (x[1], KINDS.index(x[0]), x[2])
    base = sorted(find(text), key=order)
    if not any(p.search(text) for p in (PERCENT, ESCAPE, BASE64, LINES)):
        return base, base, 0, []
    spans, seen, told = set(base), set(), []
    place = np.arange(len(text) + 1)
    work = [_unwrapped(Layer(text, place[:-1], place[1:]), told)]
    while work:  # a layer's work comes before its sisters are decoded, so that few are held at a time
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        key = hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), int(layer.start[0]) if len(layer.start) else 0
        if key in seen:
            continue
        seen.add(key)
        spans.update((kind, int(layer.start[a:b].min()), int(layer.end[a:b].max())) for kind, a, b in find(layer.text))
        work.append(_unwrapped(layer, told))
    return base, sorted(spans, key=order), len(seen), told


def _told(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_FOUND = T.StructType([T.StructField(k, T.StringType()) for k in ("base", "spans")] + [T.StructField(k, T.LongType()) for k in ("n_assign", "n_access", "n_hex", "n_layers", "n_oversize")])


@F.pandas_udf(_FOUND)
def _scan(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for t in texts:
        base, spans, layers, oversize = scan_text(t)
        rows.append((_told(base), _told(spans), *[sum(s[0] == k for s in base) for k in KINDS], layers, oversize))
    return pd.DataFrame(rows, columns=["base", "spans", "n_assign", "n_access", "n_hex", "n_layers", "n_oversize"])


@F.pandas_udf(T.StringType())
def _redact(texts: pd.Series, mark: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else redacted(t, m) for t, m in zip(texts, mark, strict=True)], dtype=object)


def redacted(text: str, mark: str) -> str:
    """The text with every stretch that spans cover, or that could not be decoded, replaced by the mark; overlapping ones share one."""
    parts, at = [], 0
    _, spans, _, told = _worked(text)
    for a, b in sorted({*told, *(s[1:] for s in spans)}):
        if a >= at:
            parts += [text[at:a], mark]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def scan_secrets(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, base, spans, n_assign, n_access, n_hex, n_layers, n_oversize``; spans are ``kind:start:end``, comma-joined."""
    out = df.select(F.col(doc_id).alias("doc_id"), _scan(F.col(text).cast("string")).alias("s"))
    return out.select("doc_id", "s.*")


def redact_secrets(df: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The same rows and columns, with the secrets of the text column replaced by ``mark``."""
    return df.withColumn(text, _redact(F.col(text).cast("string"), F.lit(mark)))
