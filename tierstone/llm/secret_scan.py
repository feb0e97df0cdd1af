"""Find secrets in texts, also where they are wrapped in layers of encoding.

A worklist starts with the text itself. Each layer is scanned; then its escapes (percent escapes, Unicode escapes,
character references) are resolved into a layer of their own, and each run of base64, once decoded and, if it is
compressed, inflated, is one more layer. Layers go back on the list until nothing new appears. A layer that was seen
before at the same place is not entered again, so data that unpacks to itself ends the search. Each character of a
layer knows the part of the original text it came from, so what is found in any layer is reported as a span of the
original.
"""

from __future__ import annotations

import binascii
import bz2
import codecs
import lzma
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column
from pyspark.sql import functions as F

from tierstone.llm.batches import texts_of

#: Kinds in the order in which they are listed where they start at the same place.
KINDS = ("assign", "access", "hex")
#: Bytes of a compressed layer that are held at once; one that inflates to more is read in overlapping pieces, and the
#: row says so.
INFLATED = 64_000_000
#: Bytes that two pieces share at most, and that an unpacker returns at once.
SHARED, STEP = 1_000_000, 1_000_000
_CONTINUED = bytes(range(0x80, 0xC0))
#: A run of base64 is decoded from so many characters on.
LEAST_BASE64 = 16

_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ESCAPE = re.compile(
    r"(?P<url>(?:%[0-9A-Fa-f]{2})+)|(?P<uni>(?:[\\%]u[0-9A-Fa-f]{4})+)|\\u\{(?P<braced>[0-9A-Fa-f]{1,6})\}"
    r"|\\U(?P<wide>[0-9A-Fa-f]{8})"
    r"|\\x(?P<byte>[0-9A-Fa-f]{2})|&#(?:(?P<dec>[0-9]{1,7})|[xX](?P<hex>[0-9A-Fa-f]{1,6}));"
)
_BASE64 = re.compile(
    r"(?:[A-Za-z0-9+/]{60,76}\r?\n)+[A-Za-z0-9+/]+={0,2}|[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST_BASE64
)

FINDINGS = "array<struct<kind:string,start:long,stop:long,layer:int>>"
REPORT = f"struct<findings:{FINDINGS},layers:int,cut_layers:int>"
_FINDING = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("layer", pa.int32())])
_REPORT = pa.struct([("findings", pa.list_(_FINDING)), ("layers", pa.int32()), ("cut_layers", pa.int32())])


def find_plain(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, index of the kind) of what stands openly in a text."""
    low = text.lower()
    if any(k in low for k in _KEYS):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                yield m.start(), m.end(), 0
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= 20:
                yield m.start(), m.end(), 1
    for m in _HEX.finditer(text):
        yield m.start(), m.end(), 2


@dataclass
class Layer:
    """A text with, for each character, its span in the original and whether decoding made it."""

    text: str
    starts: np.ndarray
    stops: np.ndarray
    made: np.ndarray
    depth: int


def _pair_surrogates(text: str) -> str:
    return text.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")


def _decoded(m: re.Match[str]) -> list[tuple[str, int, int]]:
    """Characters of an escape with the span of each, relative to the match; empty if it stands for nothing."""
    if m["url"]:
        raw = bytes.fromhex(m["url"].replace("%", ""))
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text, sizes = raw.decode("latin-1"), [1] * len(raw)
        else:
            sizes = [len(c.encode()) for c in text]
        step = 3
    elif m["uni"]:
        text = _pair_surrogates("".join(chr(int(m["uni"][i : i + 4], 16)) for i in range(2, len(m["uni"]), 6)))
        sizes, step = [1 + (ord(c) > 0xFFFF) for c in text], 6
    else:
        code = int(m["braced"] or m["wide"] or m["byte"] or m["hex"] or "0", 16) if not m["dec"] else int(m["dec"])
        if code > 0x10FFFF or 0xD800 <= code < 0xE000:
            return []
        return [(chr(code), 0, m.end() - m.start())]
    ends = np.cumsum(sizes) * step
    return [(c, int(e) - n * step, int(e)) for c, n, e in zip(text, sizes, ends, strict=True)]


def _escaped(text: str) -> bool:
    return ("%" in text or "\\" in text or "&#" in text) and _ESCAPE.search(text) is not None


def _unescaped(layer: Layer) -> Layer | None:
    """The layer with its escapes resolved; None if it has none."""
    text, parts, at = layer.text, [], 0
    if not _escaped(text):
        return None
    starts, stops, made = [], [], []
    for m in _ESCAPE.finditer(text):
        chars = _decoded(m)
        if not chars:
            continue
        s = m.start()
        parts += [text[at:s], "".join(c for c, _, _ in chars)]
        starts += [layer.starts[at:s], layer.starts[[s + a for _, a, _ in chars]]]
        stops += [layer.stops[at:s], layer.stops[[s + b - 1 for _, _, b in chars]]]
        made += [layer.made[at:s], np.ones(len(chars), bool)]
        at = m.end()
    if not parts:
        return None
    parts.append(text[at:])
    return Layer(
        "".join(parts), np.concatenate([*starts, layer.starts[at:]]), np.concatenate([*stops, layer.stops[at:]]),
        np.concatenate([*made, layer.made[at:]]), layer.depth + 1,
    )


_ZSTD = b"\x28\xb5\x2f\xfd"
_BROKEN = (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError)


def _packing(raw: bytes) -> Callable | None:
    """What makes an unpacker for data that starts so."""
    if raw[:2] == b"\x1f\x8b" or (raw[:1] == b"\x78" and len(raw) > 2 and (raw[0] * 256 + raw[1]) % 31 == 0):
        return lambda: zlib.decompressobj(47)
    if raw[:3] == b"BZh":
        return bz2.BZ2Decompressor
    if raw[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor
    if raw[:4] == _ZSTD:
        return lambda: zstandard.ZstdDecompressor().decompressobj()
    return None


def _headed(source: Iterator[bytes]) -> tuple[bytes, Iterator[bytes]]:
    """The first bytes, enough to tell a packing, and the rest."""
    head = b""
    while len(head) < 6 and (more := next(source, b"")):
        head += more
    return head, source


def _opened(source: Iterator[bytes]) -> Iterator[bytes]:
    """Unpacked bytes of all members that are joined, then what follows them as it is; an error only in the first."""
    held, source = _headed(source)
    first = True
    while held and (make := _packing(held)):
        unpack = make()
        whole = isinstance(unpack, (bz2.BZ2Decompressor, lzma.LZMADecompressor))
        small = held[:4] == _ZSTD
        try:
            while not unpack.eof:
                if small:  # takes no bound on what it returns, so it gets little at once
                    out, held = unpack.decompress(held[:64]), held[64:]
                else:
                    out = unpack.decompress(held, STEP)
                    held = b"" if whole else unpack.unconsumed_tail
                if out:
                    yield out
                if not unpack.eof and not held and not out and not (held := next(source, b"")):
                    return
        except _BROKEN:
            if first:
                raise
            return
        head, source = _headed(chain([unpack.unused_data + held], source))
        held, first = head, False
    if held.strip(b"\0"):
        yield held
        yield from source


def _inflated(raw: bytes) -> tuple[bytes | None, bool]:
    """Unpacked bytes, if the first bytes name a packing and it holds, up to INFLATED; whether there are more."""
    if _packing(raw) is None:
        return None, False
    out = bytearray()
    try:
        for more in _opened(iter([raw])):
            out += more
            if len(out) > INFLATED:
                return bytes(out[:INFLATED]), True
    except _BROKEN:
        return None, False
    return bytes(out), False


def _pieces(raw: bytes) -> Iterator[bytes]:
    """All that packed data holds, through packings inside it too, in overlapping pieces of INFLATED bytes."""
    size, shared = INFLATED & ~1, min(SHARED, INFLATED // 4) & ~1
    chunks: Iterator[bytes] = iter([raw])
    held, fresh = bytearray(), False
    try:
        head, chunks = _headed(chunks)
        while _packing(head):
            head, chunks = _headed(_opened(chain([head], chunks)))
        for more in chain([head], chunks):
            held += more
            fresh = True
            while len(held) > size:
                yield bytes(held[:size])
                del held[: size - shared]
    except _BROKEN:
        pass
    if fresh and held:
        yield bytes(held)


def _plain(text: str) -> bool:
    odd = sum(not c.isprintable() and not c.isspace() for c in text[:4096])
    return bool(text) and odd * 20 <= min(len(text), 4096)


def _readings(raw: bytes, part: bool = False) -> Iterator[tuple[str, str, bool]]:
    """(text, encoding, is it text as a whole) of what bytes may say; data that is no text only where it holds something.

    Of a ``part`` of longer data the first and the last character may be incomplete.
    """
    try:
        if part:
            raw_ = raw.lstrip(_CONTINUED) if raw[:1] and raw[0] & 0xC0 == 0x80 else raw
            text = codecs.getincrementaldecoder("utf-8")().decode(raw_)
        else:
            text = raw.decode()
        others = [(text, "utf-8")]
        if _plain(text):
            yield text, "utf-8", True
            return
    except UnicodeDecodeError:
        others = [(raw.decode("latin-1"), "latin-1")]
    if b"\0" in raw or raw[:2] in (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE):
        for code, bom, zero in (("utf-16-le", codecs.BOM_UTF16_LE, 1), ("utf-16-be", codecs.BOM_UTF16_BE, 0)):
            text = raw.decode(code, "replace")
            if (raw[:2] == bom or raw[zero::2].count(0) * 4 >= len(raw)) and _plain(text):
                yield text, code, True
                return
            others.append((text, code))
    for text, code in others:
        if _escaped(text) or _BASE64.search(text) or next(find_plain(text), None):
            yield text, code, False


def _contents(token: str) -> Iterator[tuple[str, str | None, bool, bool, bool]]:
    """What a run of base64 holds: (text, its encoding or None if it was packed, is it text, is it a first piece, are there more)."""
    core = token.rstrip("=")
    if "\n" in core:
        core = core.replace("\r", "").replace("\n", "")
    if len(core) % 4 == 1:
        return
    try:
        raw = binascii.a2b_base64(core.replace("-", "+").replace("_", "/") + "=" * (-len(core) % 4))
    except binascii.Error:
        return
    packed, cut = _inflated(raw)
    seen = {raw}
    while packed is not None and packed not in seen and not cut:
        seen.add(packed)
        raw = packed
        packed, cut = _inflated(raw)
    if not cut:
        for text, code, plain in _readings(raw):
            yield text, None if len(seen) > 1 else code, plain, True, False
        return
    first = True
    for piece in _pieces(raw):
        for text, _, plain in _readings(piece, part=True):
            yield text, None, plain, first, first
            first = False


def _runs(text: str) -> Iterator[tuple[int, str, str, str | None, bool, bool]]:
    """Runs of base64 that hold something: (first character, run, text, its encoding, is it a first piece, are there more)."""
    for m in _BASE64.finditer(text):
        plain = False
        for content, code, whole, first, cut in _contents(m[0]):
            plain = plain or whole
            yield m.start(), m[0], content, code, first, cut
        if plain or "\n" not in m[0]:
            continue
        for line in re.finditer(r"[^\r\n]{%d,}" % LEAST_BASE64, m[0]):
            for content, code, _, first, cut in _contents(line[0]):
                yield m.start() + line.start(), line[0], content, code, first, cut


def _sizes(text: str, code: str) -> np.ndarray:
    """Bytes of each character."""
    if code == "latin-1":
        return np.ones(len(text), np.int64)
    if code == "utf-8":
        return np.fromiter((len(c.encode()) for c in text), np.int64, len(text))
    return np.fromiter((2 + 2 * (c > "\uffff") for c in text), np.int64, len(text))


def _unpacked(layer: Layer, first: int, token: str, content: str, code: str | None) -> Layer:
    """The layer that a run of base64 holds."""
    n = len(content)
    made = np.ones(n, bool)
    if code is None:
        start, stop = layer.starts[first], layer.stops[first + len(token) - 1]
        return Layer(content, np.broadcast_to(start, n), np.broadcast_to(stop, n), made, layer.depth + 1)
    at = np.array([i for i, c in enumerate(token, first) if c not in "\r\n="])
    sizes = _sizes(content, code)
    ends = np.cumsum(sizes)
    starts = layer.starts[at[np.minimum((ends - sizes) * 4 // 3, len(at) - 1)]]
    stops = layer.stops[at[np.minimum(-(-ends * 4 // 3), len(at)) - 1]]
    return Layer(content, starts, stops, made, layer.depth + 1)


def _inside(layer: Layer) -> Iterator[tuple[Layer, bool, bool]]:
    """(layer, does it count, are there more pieces of it) of the layers that one holds, one at a time."""
    inner = _unescaped(layer)
    if inner and inner.text:
        yield inner, True, False
    for *run, first, cut in _runs(layer.text):
        yield _unpacked(layer, *run), first, cut


def scan_text(text: str) -> tuple[list[tuple[int, int, int, int]], int, int]:
    """Findings (start, stop, kind, layer), layers opened, layers read in pieces; layer 0 is the text itself."""
    found = {x: 0 for x in find_plain(text)}
    if not _escaped(text) and not _BASE64.search(text):
        return [(*x, 0) for x in sorted(found)], 0, 0
    n = len(text)
    work = [_inside(Layer(text, np.arange(n), np.arange(1, n + 1), np.zeros(n, bool), 0))]
    seen, opened, cut_layers = {(_digest(text), 0, n)}, 0, 0
    while work:
        child, counts, cut = next(work[-1], (None, False, False))
        if child is None:
            work.pop()
            continue
        cut_layers += cut
        key = _digest(child.text), int(child.starts[0]), int(child.stops[-1])
        if key in seen:
            continue
        seen.add(key)
        opened += counts
        work.append(_inside(child))
        for s, e, k in find_plain(child.text):
            if child.made[s:e].any():
                span = int(child.starts[s:e].min()), int(child.stops[s:e].max()), k
                found[span] = min(found.get(span, child.depth), child.depth)
    return [(*x, d) for x, d in sorted(found.items())], opened, cut_layers


def _digest(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))


def _scan(column: pa.Array) -> pa.Array:
    rows = []
    for text in texts_of(column):
        found, opened, cut = scan_text(text)
        rows.append({
            "findings": [{"kind": KINDS[k], "start": s, "stop": e, "layer": d} for s, e, k, d in found],
            "layers": opened, "cut_layers": cut,
        })
    return pa.array(rows, _REPORT)


def secrets_in(text: Column) -> Column:
    """What is found in a text: struct of ``findings``, ``layers`` opened and ``cut_layers``.

    A finding has its kind, its span in the original text (code points, stop exclusive) and the depth of the layer
    it was found in, 0 for the text itself; findings are ordered by start, stop and kind. A null or empty text has
    none. Overlapping findings of several kinds or layers all stand. A layer whose inflation passes INFLATED bytes is
    searched in overlapping pieces and counted in ``cut_layers``. Data that is neither UTF-8 nor UTF-16 text is read
    as Latin-1 and is a layer only if it holds a secret, an escape or base64.
    """
    return F.arrow_udf(_scan, REPORT)(text)


MASK = "[SECRET]"


def _redacted(column: pa.Array) -> pa.Array:
    out = []
    for text in column.to_pylist():
        spans = scan_text(text)[0] if text else []
        at, parts = 0, []
        for s, e, _, _ in spans:
            if s >= at:
                parts += [text[at:s], MASK]
            at = max(at, e)
        out.append("".join([*parts, text[at:]]) if spans else text)
    return pa.array(out, pa.string())


def without_secrets(text: Column) -> Column:
    """The text with each finding, wrapped ones included, replaced by MASK; overlapping findings by one. Null stays null."""
    return F.arrow_udf(_redacted, "string")(text)
