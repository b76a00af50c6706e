"""Secret scans with a recursive decoding worklist.

The base kinds are found in the text itself. Then layers are unwrapped from a worklist: percent-encoding, Unicode escapes,
base64 and compressed bytes, each layer scanned again and unwrapped further until nothing new comes. A layer that was seen
before at the same place is not taken up again, so the worklist ends. Each layer carries, for its characters, the span
of the original text that they come from.

Codes that wrap codes (%25 and the like) are unwrapped one level a round for a few rounds and then to their end in one pass, so a
deep nest takes time in proportion to its length. Decoded bytes are scanned in their readable stretches, whatever lies between.
Compressed layers are read in chunks, of any length. A chunk is cut only where no secret, code or run of base64 lines can lie over
the cut, so a layer within it is whole; only a single run of more than HELD bytes inside a compressed layer is cut, with overlap.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tidewire.llm.common import by_text

#: The base kinds, in their order among spans of one start: pattern, group that is measured, least length.
KINDS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]{16,}"), 0, 16),
}
ORDER = {k: i for i, k in enumerate(KINDS)}
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Lines of base64 letters, wrapped at a width; a last line may be shorter.
_LINES = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]++)+={0,2}")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
_IS_LETTER = np.isin(np.arange(256), [ord(c) for c in _LETTERS])
_BREAK = re.compile(r"\r?\n[\x20\t]*")
#: Compressed bytes as percent codes or hexadecimal escapes: runs with plain characters between, and one byte of them.
_PERCENT_BYTES = re.compile(r"%[0-9A-Fa-f]{2}(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~!*'();:@&=+$,/?#\[\]-])*")
_HEX_BYTES = re.compile(r"\\x[0-9A-Fa-f]{2}(?:\\x[0-9A-Fa-f]{2}|[\x20-\x5b\x5d-\x7e])*")
_BYTE = re.compile(r"%([0-9A-Fa-f]{2})|\\x([0-9A-Fa-f]{2})|.", re.S)
_MAGIC = re.compile(rb"\x1f\x8b|\x78[\x01\x5e\x9c\xda]|BZh|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
_HIDDEN = re.compile(r"%[0-9A-Fa-f]{2}|\\[uUx]|&#|[A-Za-z0-9+/_-]{16}")
#: Readable stretches of bytes: UTF-8 without control characters; no secret is shorter than this.
_STRETCH = re.compile(rb"(?:[\t\n\x0b\x0c\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){16,}")
_LETTER_BYTES = "".join(sorted(_LETTERS)).encode()
#: Bytes of a chunk of a compressed layer; of its text held at most for a place to cut that no run lies over; and of the beginning
#: by which a compressed stream is known again.
CHUNK, HELD, HEAD = 4 << 20, 64 << 20, 4096
#: Rounds in which wrapped codes are unwrapped one level; beyond, to their end.
ROUNDS = 2

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans (kind, start, end) in code points, leftmost and non-overlapping within a kind, by start, then kind."""
    out = [(k, m.start(), m.end()) for k, (p, g, least) in KINDS.items() for m in p.finditer(text) if m.end(g) - m.start(g) >= least]
    return sorted(out, key=lambda x: (x[1], ORDER[x[0]], x[2]))


class Layer:
    """A text and the original span of each of its characters: arrays of starts and ends, or one span for all."""

    def __init__(self, text: str, starts=None, ends=None, whole: tuple[int, int] | None = None, rounds: int = 0):
        self.text, self.starts, self.ends, self.whole, self.rounds = text, starts, ends, whole, rounds

    def span(self, a: int, b: int) -> tuple[int, int]:
        if self.whole:
            return self.whole
        return (a, b) if self.starts is None else (int(self.starts[a]), int(self.ends[b - 1]))

    def key(self) -> tuple:
        return (hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), self.whole, None if self.starts is None else hashlib.blake2b(self.starts.tobytes(), digest_size=8).digest())

    def replaced(self, subs: list[tuple[int, int, str, list[tuple[int, int]]]]) -> Layer:
        """With each substitution (start, end, text, the layer span of each new character) made."""
        out, at = [], 0
        for a, b, s, _ in subs:
            out += [self.text[at:a], s]
            at = b
        text = "".join([*out, self.text[at:]])
        if self.whole:
            return Layer(text, whole=self.whole, rounds=self.rounds + 1)
        old_s = np.arange(len(self.text)) if self.starts is None else self.starts
        old_e = np.arange(1, len(self.text) + 1) if self.ends is None else self.ends
        starts, ends, at, run = [], [], 0, []
        for a, b, _, spans in [*subs, (len(self.text), 0, "", [])]:
            if a > at and run:  # substitutions that follow each other are looked up together
                place = np.array(run, np.int64)
                starts.append(old_s[place[:, 0]])
                ends.append(old_e[place[:, 1] - 1])
                run = []
            if a > at:
                starts.append(old_s[at:a])
                ends.append(old_e[at:a])
            run += spans
            at = b or at
        if run:
            place = np.array(run, np.int64)
            starts.append(old_s[place[:, 0]])
            ends.append(old_e[place[:, 1] - 1])
        return Layer(text, np.concatenate([old_s[:0], *starts]), np.concatenate([old_e[:0], *ends]), rounds=self.rounds + 1)


def _parts(raw: bytes):
    """The valid UTF-8 characters in bytes: (first byte, end, character)."""
    at = 0
    while at < len(raw):
        n = 1 if raw[at] < 0x80 else 2 if raw[at] < 0xE0 else 3 if raw[at] < 0xF0 else 4
        try:
            yield at, at + n, raw[at : at + n].decode()
            at += n
        except UnicodeDecodeError:
            at += 1


def percent(layer: Layer) -> Layer | None:
    subs = []
    for m in _PERCENT.finditer(layer.text):
        for a, b, c in _parts(bytes.fromhex(m[0].replace("%", ""))):
            subs.append((m.start() + 3 * a, m.start() + 3 * b, c, [(m.start() + 3 * a, m.start() + 3 * b)]))
    return layer.replaced(subs) if subs else None


def escapes(layer: Layer) -> Layer | None:
    subs = []
    for m in _ESCAPE.finditer(layer.text):
        code = int(m[m.lastindex], 10 if m.lastindex == 6 else 16)
        if code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF:
            subs.append((m.start(), m.end(), chr(code), [(m.start(), m.end())]))
    return layer.replaced(subs) if subs else None


_TAIL = re.compile(r"(?:\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#x[0-9A-Fa-f]{1,6};|&#[0-9]{1,7};)\Z")


#: A percent sign however often it is wrapped, or any other character.
_WRAPPED = re.compile("%(?:25)+|.", re.S)
#: Compressed bytes hold some that are no plain ASCII.
_BINARY = re.compile(r"(?:%|\\x)[0189A-Fa-f][0-9A-Fa-f]")


def settled(layer: Layer) -> Layer | None:
    """Percent codes of ASCII characters and escapes unwrapped until none is left, in one pass.

    Characters go onto a stack; a code that ends at its top is replaced by its character, which may end another one.
    """
    out: list[str] = []
    spans: list[tuple[int, int]] = []
    changed = False
    for token in _WRAPPED.finditer(layer.text):
        out.append(token[0][0])
        spans.append(token.span())
        changed |= token.end() - token.start() > 1
        while True:
            n, new = 0, ""
            if len(out) > 2 and out[-3] == "%" and (out[-2] + out[-1]).isalnum():
                try:
                    code = int(out[-2] + out[-1], 16)
                    n, new = (3, chr(code)) if code < 128 else (0, "")
                except ValueError:
                    n = 0
            if not n and (out[-1] in "};" or out[-1] in "0123456789abcdefABCDEF" and ("\\" in out[-10:-1])):
                m = _TAIL.search("".join(out[-12:]))
                e = _ESCAPE.fullmatch(m[0]) if m else None
                code = int(e[e.lastindex], 10 if e.lastindex == 6 else 16) if e else 0xD800
                if code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF:
                    n, new = len(m[0]), chr(code)
            if not n:
                break
            spans[-n:] = [(spans[-n][0], spans[-1][1])]
            out[-n:] = [new]
            changed = True
    if not changed:
        return None
    if layer.whole:
        return Layer("".join(out), whole=layer.whole, rounds=layer.rounds + 1)
    old_s = np.arange(len(layer.text)) if layer.starts is None else layer.starts
    old_e = np.arange(1, len(layer.text) + 1) if layer.ends is None else layer.ends
    at = np.array(spans, np.int64).reshape(-1, 2)
    return Layer("".join(out), old_s[at[:, 0]], old_e[at[:, 1] - 1], rounds=layer.rounds + 1)


class Unpacking:
    """Bytes that come in pieces, through any number of compressions.

    One decompressor for each level, in a list: what a level gives goes to the next by a stack of pieces, not by nested calls, so
    depth meets no limit. A level opens where the innermost output begins with a compressed stream whose beginning was not seen
    before (streams can hold themselves). Streams of one level that follow each other are one output. A level that has ended
    keeps no state, and pieces are of a chunk, so levels smaller than that are open one at a time.
    """

    def __init__(self):
        self.levels, self.seen, self.head, self.plain = [], set(), b"", False

    def feed(self, piece: bytes):
        """What comes out for one more piece."""
        yield from self._run([(0, piece)])

    def finish(self):
        """What comes out once no piece follows: a beginning too short to be judged before is judged now."""
        while self.head:
            yield from self._run(self._judged())

    def _judged(self) -> list:
        head, self.head = self.head, b""
        key = hashlib.blake2b(head[:HEAD], digest_size=16).digest()
        if _MAGIC.match(head) and key not in self.seen:
            self.seen.add(key)
            self.levels.append(None)
            return [(len(self.levels) - 1, head)]
        self.plain = True
        return [(len(self.levels), head)]

    def _run(self, work: list):
        while work:
            k, piece = work.pop()
            if k == len(self.levels):
                if self.plain:
                    if self.levels:
                        yield piece
                    continue
                self.head += piece
                if len(self.head) >= HEAD:
                    work += self._judged()
                continue
            if self.levels[k] is None and len(piece):
                self.levels[k] = _opener(bytes(piece[:8])) or False
            d = self.levels[k]
            if not d:  # nothing more, or what follows a level's streams and is none
                continue
            try:
                out, rest = _step(d, piece)
                if d.eof:
                    rest, self.levels[k] = (d.unused_data or b"") + bytes(rest), None
            except _BROKEN:
                out, rest, self.levels[k] = b"", b"", False
            if len(rest) or len(out) >= CHUNK or getattr(d, "needs_input", True) is False:
                work.append((k, rest))
            if out:
                work.append((k + 1, out))


_ZLIB = type(zlib.decompressobj())
_BROKEN = (OSError, EOFError, zlib.error, lzma.LZMAError, zstandard.ZstdError, ValueError)


def _opener(head: bytes):
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if head[:1] == b"\x78" and len(head) > 1 and (head[0] << 8 | head[1]) % 31 == 0:
        return zlib.decompressobj(15)
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    if head[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor(max_window_size=1 << 31).decompressobj()
    return None


def _step(d, raw: bytes) -> tuple[bytes, bytes]:
    """Some output of at most about a chunk, and the input left."""
    if isinstance(d, _ZLIB):
        out = d.decompress(raw, CHUNK)
        return out, d.unconsumed_tail
    if hasattr(d, "needs_input"):  # bz2, lzma
        return d.decompress(raw, CHUNK), b""
    return d.decompress(raw[:1024]), memoryview(raw)[1024:]  # zstd


def unpacked(raw: bytes | memoryview):
    """The readable texts in bytes, through any number of compressions, in parts."""
    if not _MAGIC.match(bytes(raw[:8])):
        if text := as_text(bytes(raw)):
            yield text
        return
    unpacking, held, tried = Unpacking(), b"", 0
    for at in range(0, len(raw), CHUNK):
        for chunk in unpacking.feed(bytes(raw[at : at + CHUNK])):
            held += chunk
            if len(held) < CHUNK:
                continue
            cut = _seam(held, tried)
            if not cut and len(held) < HELD:
                tried = len(held)
                continue
            if text := as_text(held[:cut] if cut else held):
                yield text
            held, tried = held[cut:] if cut else held[-HELD // 4 :], 0
    held += b"".join(unpacking.finish())
    if text := as_text(held):
        yield text


def _seam(held: bytes, since: int) -> int:
    """The last place from since on that lies in no secret, code or run of base64 lines, whatever follows; 0 if there is none.

    That is behind a control character, or behind a line that ends in fewer than 16 base64 letters after other characters: such
    a line neither begins a run of wrapped lines nor goes on with one.
    """
    best = max(held.rfind(bytes([c]), since) for c in (*range(9), *range(14, 32))) + 1
    end = len(held)
    while (at := held.rfind(b"\n", max(since, best), end)) >= 0:
        line = held[held.rfind(b"\n", 0, at) + 1 : at].rstrip(b"\r")
        before = line.rstrip(_LETTER_BYTES)
        if len(before) == len(line) or (len(line) - len(before) < 16 and before.strip(b" \t")):
            return at + 1
        end = at
    return best


def as_text(raw: bytes) -> str | None:
    """The readable stretches of bytes, apart from each other, or none."""
    got = [m[0].decode() for m in _STRETCH.finditer(raw)]
    return "\0".join(got) if got else None


def packed_runs(layer: Layer):
    """A layer for each compressed text whose bytes stand as percent codes or \\x escapes, plain characters between them too."""
    for p in (_PERCENT_BYTES, _HEX_BYTES):
        for m in p.finditer(layer.text):
            if not _BINARY.search(m[0]):
                continue
            raw, ends = bytearray(), []
            for x in _BYTE.finditer(m[0]):
                code = x[1] or x[2]
                raw += bytes([int(code, 16)]) if code else b" " if p is _PERCENT_BYTES and x[0] == "+" else x[0].encode("latin-1")
                ends.append(x.end())
            whole = memoryview(bytes(raw))
            for start in _MAGIC.finditer(whole):
                at = start.start()
                if not _begins(whole[at:]):
                    continue
                used = _used(whole[at:])
                for text in unpacked(whole[at : at + used]):
                    yield Layer(text, whole=layer.span(m.start() + (ends[at - 1] if at else 0), m.start() + ends[at + used - 1]))


def _begins(raw: memoryview) -> bool:
    """Whether bytes begin a compressed stream, by its first bytes alone."""
    d = _opener(bytes(raw[:8]))
    if d is None:
        return False
    try:
        if isinstance(d, _ZLIB) or hasattr(d, "needs_input"):
            return bool(d.decompress(bytes(raw[:1024]), 1)) or len(raw) > 1024 or d.eof
        d.decompress(bytes(raw[:64]))
        return True
    except _BROKEN:
        return False


def _used(raw: memoryview) -> int:
    """How many bytes the first compressed stream takes, of bytes that go on after it; all of them if it does not end."""
    d, rest, at = _opener(bytes(raw[:8])), b"", 0
    try:
        while at < len(raw) or rest:
            if not rest:
                rest = bytes(raw[at : at + 1024])
                at += len(rest)
            _, rest = _step(d, rest)
            while not rest and not d.eof and getattr(d, "needs_input", True) is False:
                d.decompress(b"", CHUNK)
            if d.eof:
                return at - len(rest) - len(d.unused_data or b"")
    except _BROKEN:
        return len(raw)
    return len(raw)


def _decoded(run: str) -> bytes | None:
    s = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(s) % 4 == 1:
        return None
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _starts(raw: bytes):
    """(first byte, end) of what decoded bytes may hold: a compressed stream up to their end, and readable stretches."""
    for m in _MAGIC.finditer(raw):
        if _begins(memoryview(raw)[m.start() :]):
            yield m.start(), len(raw)
    for m in _STRETCH.finditer(raw):
        yield m.start(), m.end()


def blocks(layer: Layer):
    """A layer for each text that a run of base64 letters holds, also over several lines, from any of its four offsets and from
    each line's start, whatever stands before it in the run."""
    for p in (_BASE64, _LINES):
        for m in p.finditer(layer.text):
            lines = _BREAK.split(m[0])
            for n in {len(lines), len(lines) - 1} - {0}:  # the last line may be a word that follows
                run = "".join(lines[:n]).rstrip("=")
                place = range(len(m[0])) if len(lines) == 1 or layer.whole else np.flatnonzero(_IS_LETTER[np.frombuffer(m[0].encode(), np.uint8)])
                end = m.end() if n == len(lines) else m.start() + int(place[len(run) - 1]) + 1
                for r in range(4):
                    raw = _decoded(run[r : len(run) - ((len(run) - r) % 4 == 1)])
                    if raw is None:
                        continue
                    for a, b in _starts(raw):
                        first, last = m.start() + int(place[r + a // 3 * 4 + a % 3]), end if b == len(raw) else m.start() + int(place[r + (b * 4 + 2) // 3 - 1]) + 1
                        for text in unpacked(memoryview(raw)[a:b]):
                            yield Layer(text, whole=layer.span(first, last))


def _within(layer: Layer):
    """The layers one step below, one at a time."""
    for step in (settled,) if layer.rounds >= ROUNDS else (percent, escapes):
        if (inner := step(layer)) is not None:
            yield inner
    yield from packed_runs(layer)
    yield from blocks(layer)


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """The base spans, and all spans with those of the decoded layers, each once."""
    base = base_spans(text)
    if not _HIDDEN.search(text):
        return base, base
    found, work, seen = set(base), [iter([Layer(text)])], set()
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if (key := layer.key()) in seen:
            continue
        seen.add(key)
        if len(seen) > 1:
            found.update((k, *layer.span(a, b)) for k, a, b in base_spans(layer.text))
        if _HIDDEN.search(layer.text):
            work.append(_within(layer))
    return base, sorted(found, key=lambda x: (x[1], ORDER[x[0]], x[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and spans (kind:start:end, joined by commas) and the counts n_assign, n_access, n_hex of base, for every row.

    A null or empty text has none. Ids (null too) and repeated rows pass as they are; other columns are not read.
    """

    def each(_, texts):
        seen: dict[bytes, tuple] = {}
        for x in texts:
            if x not in seen:
                seen[x] = scan(x.decode())
        got = [seen[x] for x in texts]
        counts = {f"n_{k}": pa.array([sum(s[0] == k for s in b) for b, _ in got], pa.int64()) for k in KINDS}
        return counts | {"base": pa.array([joined(b) for b, _ in got], pa.string()), "spans": pa.array([joined(s) for _, s in got], pa.string())}

    return by_text(docs, each, ", ".join(f"n_{k} long" for k in KINDS) + ", base string, spans string", id_col, text_col)


def masked(text: str, mark: str = "[SECRET]") -> tuple[str, int]:
    """The text with each maximal run of found spans replaced by mark, and the number of runs."""
    out, at, n, end = [], 0, 0, -1
    for _, a, b in scan(text)[1]:
        if a >= end:
            out += [text[at:a], mark]
            n += 1
        at = end = max(end, b)
    return "".join([*out, text[at:]]), n
