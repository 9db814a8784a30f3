"""Secret scans through nested encodings.

Every text is scanned as it stands; then a worklist unwraps URL escapes, character escapes, base64 and
compressed content, rescans each layer and maps what it finds back to the characters of the original text,
until no layer yields a new one. Compressed content that can't be unwrapped to its end is told apart from content
without secrets: what it gave before it broke off is scanned, and the text is marked as not read whole.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import partial
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_column, text_or_empty

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# The whole match is one run of a class, so a minimum length in the pattern finds the same runs.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_ASSIGN_CHARS = 12

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|(?:\\x[0-9A-Fa-f]{2})+|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|&(?:quot|apos|amp|lt|gt);")
_NAMED = {"quot": '"', "apos": "'", "amp": "&", "lt": "<", "gt": ">"}
#: The shortest secret has 16 characters, which base64 writes in 22.
_LEAST_BASE64 = 22
#: Runs of base64 characters, wrapped lines joined, from the start of a run only.
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[ \t]*+(?:\r?\n|\\r|\\n)++[ \t>]*+[A-Za-z0-9+/_-]{16,}+)*+(?:[ \t]*+(?:\r?\n|\\r|\\n)++[ \t>]*+[A-Za-z0-9+/_-]++)?={0,2}")
_RUN = re.compile(r"[A-Za-z0-9+/_-]+")
#: Compressed layers are unwrapped in windows of so many bytes that overlap, so that a few bytes can't fill the memory.
MAX_LAYER_BYTES = 1 << 24
OVERLAP = 1 << 20
#: First bytes of gzip, zlib, bzip2, xz and zstd.
_PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]1AY&SY|\xfd7zXZ\x00|\x28\xb5\x2f\xfd", re.S)


def scan(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the secrets that stand in ``text``, leftmost and non-overlapping within a kind."""
    found = []
    folded = text.lower()
    if any(k in folded for k in _KEYWORDS):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= _ASSIGN_CHARS]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return found


class Layer:
    """A decoded text whose characters know the span of the original text they came from.

    ``pieces`` are (place in this layer, start, end, step): step 1 copies characters one to one, 0 stands for
    the whole span, any other number is a list of span borders.
    """

    def __init__(self, text: str, pieces: list[tuple[int, int, int, bool]], under: Layer | None):
        self.text, self.pieces, self.under = text, pieces, under
        self.starts = [p[0] for p in pieces]

    def origin(self, lo: int, hi: int) -> tuple[int, int]:
        """Span of the original text behind characters lo to hi of this layer."""
        if self.under is None:
            return lo, hi
        a, b = self._place(lo)[0], self._place(hi - 1)[1]
        return self.under.origin(a, b)

    def _place(self, at: int) -> tuple[int, int]:
        place, start, end, copied = self.pieces[bisect_right(self.starts, at) - 1]
        return (start + at - place, start + at - place + 1) if copied else (start, end)


class Decoded(Layer):
    """A layer of bytes that base64 wrote, four characters for three; ``runs`` are (place among those characters, place in the layer under).

    ``written`` gives the bytes of a part of its text; their number before every ``STEP`` characters is kept, so that a
    place costs no more than that.
    """

    STEP = 1024

    def __init__(self, text: str, runs: list[tuple[int, int]], under: Layer, written: Callable[[str], bytes]):
        super().__init__(text, [], under)
        self.runs, self.places, self.written, self.before = runs, [r[0] for r in runs], written, None

    def _byte(self, at: int) -> int:
        if self.before is None:
            sizes = (len(self.written(self.text[i : i + self.STEP])) for i in range(0, len(self.text), self.STEP))
            self.before = list(accumulate(sizes, initial=0))
        step = at // self.STEP
        return self.before[step] + len(self.written(self.text[step * self.STEP : at]))

    def _under(self, at: int) -> int:
        place, start = self.runs[bisect_right(self.places, at) - 1]
        return start + at - place

    def _place(self, at: int) -> tuple[int, int]:
        byte, n = self._byte(at), len(self.written(self.text[at]))
        return self._under(byte * 4 // 3), self._under(((byte + n) * 4 + 2) // 3 - 1) + 1


def _text(raw: bytes) -> str:
    """Bytes that are no UTF-8 stay as one character each."""
    return raw.decode("utf-8", "surrogateescape")


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogateescape")


def _readings(raw: bytes) -> Iterator[tuple[str, Callable[[str], bytes]]]:
    """Texts that bytes may be, each with what writes a part of it: UTF-8, and UTF-16 where a quarter of the bytes or more are zero."""
    yield _text(raw), _bytes
    if 4 * raw.count(0) >= len(raw) > 0:
        for kind in ("utf-16-le", "utf-16-be"):
            yield raw[: len(raw) // 2 * 2].decode(kind, "surrogatepass" if _paired(raw, kind) else "replace"), partial(str.encode, encoding=kind, errors="surrogatepass")


def _paired(raw: bytes, kind: str) -> bool:
    try:
        raw[: len(raw) // 2 * 2].decode(kind, "surrogatepass")
    except UnicodeDecodeError:
        return False
    return True


def _replaced(layer: Layer, found: list[tuple[int, int, str]]) -> Layer:
    """The layer with each (start, end, decoded text) put in its place."""
    out, pieces, at, size = [], [], 0, 0
    for start, end, text in found:
        if start > at:
            pieces.append((size, at, start, True))
            out.append(layer.text[at:start])
            size += start - at
        if text:
            pieces.append((size, start, end, False))
            out.append(text)
            size += len(text)
        at = end
    if at < len(layer.text):
        pieces.append((size, at, len(layer.text), True))
        out.append(layer.text[at:])
    return Layer("".join(out), pieces, layer)


def _url(layer: Layer) -> Iterator[Layer]:
    if "%" in layer.text:
        found = []
        for m in _URL.finditer(layer.text):
            raw, at = bytes.fromhex(m[0].replace("%", "")), m.start()
            for c in _text(raw):
                n = 3 * len(_bytes(c))
                found.append((at, at + n, c))
                at += n
        if found:
            yield _replaced(layer, found)


def _unescape(text: str) -> str | None:
    try:
        if text.startswith("&#"):
            return chr(int(text[3:-1], 16) if text[2] in "xX" else int(text[2:-1]))
        if text.startswith("&"):
            return _NAMED[text[1:-1]]
        if text.startswith("\\u{"):
            return chr(int(text[3:-1], 16))
        if text.startswith("\\U"):
            return chr(int(text[2:], 16))
        if text.startswith("\\x"):
            raw = bytes.fromhex(text.replace("\\x", ""))
            try:
                return raw.decode("utf-8")
            except UnicodeDecodeError:
                return raw.decode("latin-1")
        return bytes.fromhex(text.replace("\\u", "")).decode("utf-16-be")
    except (ValueError, OverflowError):
        return None


def _escapes(layer: Layer) -> Iterator[Layer]:
    if "\\" in layer.text or "&" in layer.text:
        found = []
        for m in _ESCAPE.finditer(layer.text):
            text = _unescape(m[0])
            if text is None:
                continue
            unit = {"u": 6, "x": 4}.get(m[0][1], 0) if m[0][0] == "\\" and "{" not in m[0] else 0
            if unit and len(text) * unit == len(m[0]):
                found += [(m.start() + i * unit, m.start() + (i + 1) * unit, c) for i, c in enumerate(text)]
            else:
                found.append((m.start(), m.end(), text))
        if found:
            yield _replaced(layer, found)


def _parts(raw: bytes, start: int = 0, size: int = 1 << 16) -> Iterator[bytes]:
    for at in range(start, len(raw), size):
        yield raw[at : at + size]


class _Zstd:
    """A decompressor with the interface of the standard library's; small steps keep what they give small."""

    def __init__(self):
        import zstandard  # a worker without it fails the job: skipped content would look like content without secrets

        self.inner, self.eof, self.unused_data, self.failure = zstandard.ZstdDecompressor().decompressobj(), False, b"", zstandard.ZstdError

    def decompress(self, data: bytes, _most: int) -> bytes:
        out = []
        for at in range(0, len(data), 256):
            try:
                out.append(self.inner.decompress(data[at : at + 256]))
            except self.failure as e:
                raise ValueError("broken zstd frame") from e
            if self.inner.eof:
                self.eof, self.unused_data = True, self.inner.unused_data + data[at + 256 :]
                break
        return b"".join(out)


def _decompressor(start: bytes):
    if start[:4] == b"\x28\xb5\x2f\xfd":
        return _Zstd()
    if start[:2] == b"\x1f\x8b" or start[:1] == b"\x78":
        return zlib.decompressobj(47)
    if start[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor() if start[:6] == b"\xfd7zXZ\x00" else None


#: What decompressors raise on content that is broken or none of theirs; nothing else is taken for that.
_FAILS = (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError)
#: The two bytes of zlib's header stand in noise too, so that it counts as broken content only after so many bytes of content.
_LEAST_ZLIB = 64


def _drained(unpack, data: bytes, parts: Iterator[bytes], most: Callable[[], int]) -> Iterator[bytes | None]:
    """What a decompressor gives for ``data`` and the parts behind it, to the end of its member or of the parts; None at an error."""
    while not unpack.eof:
        try:
            out = unpack.decompress(data, most())
        except _FAILS:
            yield None
            return
        data = getattr(unpack, "unconsumed_tail", b"")
        if out:
            yield out
        elif not data and getattr(unpack, "needs_input", True) and not unpack.eof:
            data = next(parts, None)
            if data is None:
                return


def _before_error(raw: bytes, given: int) -> bytes:
    """What the member at the start of ``raw`` gives behind its first ``given`` bytes, up to its error: a call that fails hands out nothing."""
    out, got = bytearray(), 0
    for part in _drained(_decompressor(raw[:6]), b"", _parts(raw, size=1), lambda: max(1, given - got)):
        if part is None:
            break
        out += part[max(0, given - got) :]
        got += len(part)
    return bytes(out)


def _inflated(parts: Iterator[bytes], broken: Callable[[], None] | None = None) -> Iterator[bytes]:
    """Decompressed parts of the members that a stream begins with, until they end or one is broken or cut off, which calls ``broken``.

    Of a broken member all that it gives before its error is handed out where its first ``OVERLAP`` bytes hold the error.
    """
    data = b""
    while True:
        while len(data) < 6 and (more := next(parts, None)) is not None:
            data += more
        unpack = _decompressor(data)
        if unpack is None:
            return
        read, given, failed = bytearray(data), 0, False

        def fed(read=read):
            for part in parts:
                if len(read) <= OVERLAP:
                    read.extend(part)
                yield part

        for out in _drained(unpack, data, fed(), lambda: OVERLAP):
            if out is None:
                failed = True
                out = _before_error(bytes(read), given) if len(read) <= OVERLAP else b""
            if out:
                given += len(out)
                yield out
        if failed or not unpack.eof:
            if broken is not None and (data[:1] != b"\x78" or given >= _LEAST_ZLIB):
                broken()
            return
        data = unpack.unused_data.lstrip(b"\0")


#: What an encoded run is written with; a window that would end inside such a run goes on by ``OVERLAP`` at most.
_INSIDE = re.compile(rb"[A-Za-z0-9+/_=%\\&;#{}.\r\n-]*\Z")
_BASE64_END = re.compile(rb"[A-Za-z0-9+/_=\r\n-]*\Z")
_OUTSIDE = re.compile(rb"[^A-Za-z0-9+/_=\r\n-]")


def _windows(parts: Iterator[bytes]) -> Iterator[tuple[int, bytes, bool]]:
    """(place in the stream, window, whether it is the last): all of it, in windows of about ``MAX_LAYER_BYTES`` that overlap by ``OVERLAP``."""
    held, size, start = [], 0, 0
    for part in parts:
        held.append(part)
        size += len(part)
        if size >= MAX_LAYER_BYTES:
            inside = len(_INSIDE.search(part[-256:])[0]) == min(256, len(part))
            if not inside or size >= MAX_LAYER_BYTES + OVERLAP:
                whole = b"".join(held)
                yield start, whole, False
                held = [whole[-min(OVERLAP, MAX_LAYER_BYTES // 2) :]]
                start += len(whole) - len(held[0])
                size = len(held[0])
    if held:
        yield start, b"".join(held), True


def _after(stream: Callable[[], Iterator[bytes]], skip: int) -> Iterator[bytes]:
    """A stream from place ``skip``."""
    for part in stream():
        if skip < len(part):
            yield part[skip:] if skip else part
        skip = max(0, skip - len(part))


def _content(window: bytes, at: int, last: bool, broken: Callable[[], None]) -> tuple[bool, bool]:
    """Whether compressed content stands at a place, and whether it goes on behind the window; ``broken`` is called where it gives nothing for an error."""
    ended, failed = [], []

    def parts():
        yield from _parts(window, at)
        ended.append(True)

    found = sum(len(part) for part in _inflated(parts(), lambda: failed.append(True))) > 0
    if failed and not found and (last or not ended):
        broken()
    return found, bool(ended)


def _unpacked(stream: Callable[[], Iterator[bytes]], skip: int, broken: Callable[[], None]) -> Iterator[bytes]:
    return _inflated(_after(stream, skip), broken)


def _run_decoded(stream: Callable[[], Iterator[bytes]], skip: int, shift: int) -> Iterator[bytes]:
    """What base64 wrote in the run that begins at place ``skip``, but for its first ``shift`` characters, to the run's end."""
    rest, ended = b"", False
    for part in _after(stream, skip):
        if end := _OUTSIDE.search(part):
            part, ended = part[: end.start()], True
        rest += part.translate(bytes.maketrans(b"-_", b"+/"), b"\r\n=")
        if shift:
            drop = min(shift, len(rest))
            rest, shift = rest[drop:], shift - drop
        whole = len(rest) // 4 * 4
        if whole:
            yield base64.b64decode(rest[:whole])
            rest = rest[whole:]
        if ended:
            break
    if len(rest) > 1:
        yield base64.b64decode(rest + b"=" * (-len(rest) % 4))


def _unwrapped(raw: bytes, broken: Callable[[], None]) -> Iterator[str]:
    """Texts of the compressed content that stands anywhere in ``raw``, and of what is compressed in it, of any depth.

    A base64 run that is longer than a window is decoded from its start as a stream of its own, in each of the four
    alignments, so that no window has to hold it.
    """
    seen: set[bytes] = set()
    todo = [partial(_unpacked, partial(_parts, raw), m.start(), broken) for m in _PACKED.finditer(raw)]
    while todo:
        stream, running = todo.pop(), False
        for start, window, last in _windows(stream()):
            mark = hashlib.blake2b(window, digest_size=16).digest()
            fresh = mark not in seen  # content can unpack to itself
            if fresh:
                seen.add(mark)
                for text, _ in _readings(window):
                    yield text
                for m in _PACKED.finditer(window):
                    found, more = _content(window, m.start(), last, broken)
                    if found:
                        # what goes on in later windows is unpacked from the stream's start again
                        todo.append(partial(_unpacked, stream, start + m.start(), broken) if more and not last else partial(_unpacked, partial(_parts, window), m.start(), broken))
            run = len(window) - len(_BASE64_END.search(window)[0])
            if not last and not (running and not run) and run < len(window) - OVERLAP:
                todo += [partial(_run_decoded, stream, start + run, shift) for shift in range(4)]
            running = not last and run < len(window) - OVERLAP


def _base64(layer: Layer, broken: Callable[[], None]) -> Iterator[Layer]:
    for m in _BASE64.finditer(layer.text):
        if m.end() - m.start() < _LEAST_BASE64:
            continue
        parts, runs, size = [], [], 0
        for run in _RUN.finditer(m[0].replace("\\n", "\\ ").replace("\\r", "\\ ")):
            runs.append((size, m.start() + run.start()))
            parts.append(run[0])
            size += len(run[0])
        whole = "".join(parts).replace("-", "+").replace("_", "/")
        for shift in range(4):  # what stands before the token in its run moves it
            token = whole[shift:]
            if len(token) % 4 == 1:
                token = token[:-1]
            raw = base64.b64decode(token + "=" * (-len(token) % 4))
            for text, written in _readings(raw):
                yield Decoded(text, [(place - shift, start) for place, start in runs], layer, written)
            for text in _unwrapped(raw, broken):
                yield Layer(text, [(0, m.start(), m.end(), False)], layer)


def find_secrets(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, base spans and those that decoding adds), each sorted by start, then kind, then end."""
    return scan_layers(text)[:2]


def scan_layers(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]], bool]:
    """The spans of ``find_secrets``, and whether all compressed content was read to its end: where not, spans may be missing."""
    order = {k: i for i, k in enumerate(KINDS)}
    sort = lambda spans: sorted(spans, key=lambda s: (s[0], order[s[2]], s[1]))
    base = scan(text)
    spans, seen = set(base), {(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), 0, len(text))}
    broken: list[bool] = []
    unpacked = partial(_base64, broken=lambda: broken.append(True))
    decoded = lambda layer: (deeper for decode in (_url, _escapes, unpacked) for deeper in decode(layer))
    todo = [decoded(Layer(text, [], None))]
    while todo:
        deeper = next(todo[-1], None)
        if deeper is None:
            todo.pop()
        elif deeper.text:
            mark = (hashlib.blake2b(deeper.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), *deeper.origin(0, len(deeper.text)))
            if mark not in seen:  # else a cycle, or another way to the same layer
                seen.add(mark)
                spans.update((*deeper.origin(lo, hi), kind) for lo, hi, kind in scan(deeper.text))
                todo.append(decoded(deeper))
    return sort(base), sort(spans), not broken


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans, whole) of every row's whole text: arrays of kind, start, end in code points; null counts as empty.

    ``whole`` is false where compressed content is broken, cut off or needs more memory than its decompressor takes, so
    that spans may be missing. Repeated rows give a row each, an empty table none.
    """

    def run(texts):
        import pyarrow as pa

        pack = lambda spans: [{"kind": k, "start": a, "end": b} for a, b, k in spans]
        spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        found = [scan_layers(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([*[pa.array([pack(x[i]) for x in found], spans) for i in (0, 1)], pa.array([x[2] for x in found], pa.bool_())], ["base", "spans", "whole"])

    return docs.select(F.col(id_col).alias("id"), arrow_column(run, f"base {_SPANS}, spans {_SPANS}, whole boolean", text_or_empty(text_col)).alias("s")).select("id", "s.base", "s.spans", "s.whole")


def op5(spark: SparkSession, docs: DataFrame) -> DataFrame:
    written = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    out = secret_spans(docs)
    return out.select(F.col("id").alias("doc_id"), *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"), "whole")
