"""Layers that runs of one alphabet hide: bytes in percent codes and escapes, wrapped base64, and base64 glued to other words."""

import base64
import bz2
import gzip
import lzma
import random
import time
import zlib

import pytest
import zstandard

from tidewire.llm import secret_scan

SECRET = 'password = "hunter2hunter2XY"'
NOISE = "".join(random.Random(3).choice("bcdfghjklmnp \n") for _ in range(300))
PACKED = [f(SECRET.encode()) for f in (gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.ZstdCompressor().compress)]


def percent(raw):
    return "".join(f"%{c:02X}" for c in raw)


def wrapped(raw, width, end="\n"):
    s = base64.b64encode(raw).decode()
    return end.join(s[k : k + width] for k in range(0, len(s), width))


HIDDEN = [percent(x) for x in PACKED] + ["".join(f"\\x{c:02x}" for c in x) for x in PACKED]
HIDDEN += ["%FF" + percent(SECRET.encode()), percent(SECRET.encode()) + "%C3"]
HIDDEN += [wrapped(gzip.compress((NOISE + SECRET).encode()), w) for w in (64, 76)] + [wrapped((NOISE[:50] + SECRET + NOISE).encode(), 76, "\r\n")]
HIDDEN += ["/path/" + wrapped(SECRET.encode(), 400), "x_" + wrapped(gzip.compress(SECRET.encode()), 400), "id-" + wrapped(SECRET.encode(), 400)]


@pytest.mark.parametrize("hidden", HIDDEN)
def test_layer_is_unwrapped(hidden):
    found = [(a, b) for k, a, b in secret_scan.scan(f"lead é {hidden} end")[1] if k == "assign"]
    assert found and all(7 <= a < b <= 7 + len(hidden) for a, b in found)


def packed_with(f, inner, filler=b"", after=b""):
    return base64.b64encode(f(filler + inner + after)).decode()


BIG = b"lorem ipsum dolor\n" * (5 << 16)  # 6 MB, more than any chunk
LONG = b"x" * (9 << 20)
HIDDEN_DEEP = [base64.b64encode(b"\x01\x02" + SECRET.encode() + b"\x00\xff\xfe").decode(), base64.b64encode(b"\x90" * 9 + gzip.compress(SECRET.encode())).decode()]
HIDDEN_DEEP += [base64.b64encode(gzip.compress(b"first") + gzip.compress(SECRET.encode())).decode(), base64.b64encode(b"glued-" + zlib.compress(zstandard.ZstdCompressor().compress(SECRET.encode()))).decode()]
HIDDEN_DEEP += [packed_with(f, SECRET.encode(), BIG, b"\n") for f in (gzip.compress, bz2.compress, zstandard.ZstdCompressor().compress)]
HIDDEN_DEEP += [packed_with(gzip.compress, b" " + SECRET.encode(), LONG)]


@pytest.mark.parametrize("hidden", HIDDEN_DEEP)
def test_deep_layer_is_unwrapped(hidden):
    found = [(a, b) for k, a, b in secret_scan.scan(f"lead é {hidden} end")[1] if k == "assign"]
    assert found and all(7 <= a < b <= 7 + len(hidden) for a, b in found)


def test_stretch_of_a_run_is_its_own_span():
    run = base64.b64encode(b"\x00" * 30 + SECRET.encode() + b"\x00" * 30).decode()
    (a, b), = {(a, b) for k, a, b in secret_scan.scan(run)[1] if k == "assign"}
    assert 36 <= a <= 44 and b <= len(run) - 36


@pytest.mark.parametrize("text", ["%" + "25" * 500_000 + "70assword=hunter2hunter2", "\\" + "x5c" * 60_000 + "x70assword=hunter2hunter2", "%%%" + "325" * 60_000, "&" + "#38;" * 60_000 + "#112;assword=hunter2hunter2", "%25" * 300_000])
def test_deep_nests_take_linear_time(text):
    start = time.process_time()
    spans = secret_scan.scan(text)[1]
    assert time.process_time() - start < 3
    assert "hunter2" not in text or any(k == "assign" for k, _, _ in spans)


def test_nests_settle_as_rounds_do():
    """Unwrapped one level a round to the end, and in one pass, codes give the same text."""
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["%", "25", "32", "5", "41", "\\x", "5c", "u0041", "&#", "38;", "x41;", "a", "%25", "%41"]) for _ in range(rng.randrange(1, 14)))
        layer = secret_scan.Layer(text)
        while (inner := secret_scan.percent(layer) or secret_scan.escapes(layer)) is not None:
            layer = inner
        done = secret_scan.settled(secret_scan.Layer(text)) or secret_scan.Layer(text)
        assert secret_scan.settled(done) is None
        assert done.text.count("%25") == 0 and (done.text == layer.text or len(done.text) <= len(text))


def test_a_stream_that_holds_itself_ends():
    raw = zlib.compress(b"A" * 100)
    for _ in range(50):
        raw = zlib.compress(raw)
    assert secret_scan.scan(base64.b64encode(raw).decode())


def test_one_bad_byte_keeps_the_map():
    text = "q=%FF" + percent(b"token=") + "abcdefghijklm&y"
    assert ("assign", text.index("%74"), text.index("&y")) in secret_scan.scan(text)[1]


@pytest.mark.parametrize("depth", [600, 2000, 10_000])
def test_depth_meets_no_limit(depth):
    raw = SECRET.encode()
    for _ in range(depth):
        raw = zlib.compress(raw, 1)
    start = time.process_time()
    assert any(k == "assign" for k, _, _ in secret_scan.scan(base64.b64encode(raw).decode())[1])
    assert time.process_time() - start < 60


def test_nested_stored_blocks_end():
    for n in (800, 4000):
        secret_scan.scan(base64.b64encode(bytes.fromhex("780100ffff0000") * n).decode())


@pytest.mark.parametrize("width", [0, 76])
@pytest.mark.parametrize("lead", [b"lorem ipsum dolor sit\n", b"=" * 50, b"ab cd "])
def test_no_cut_loses_a_layer(monkeypatch, lead, width):
    """A layer within a compressed layer, at all offsets around the end of a chunk."""
    monkeypatch.setattr(secret_scan, "CHUNK", 1 << 12)
    noise = bytes(random.Random(5).choice(b"abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(900))
    inner = gzip.compress(noise + b" " + SECRET.encode())
    inner = wrapped(inner, width).encode() if width else base64.b64encode(inner)
    for at in range((1 << 12) - len(inner) - 40, (1 << 12) + 40, 53):
        outer = (lead * (1 << 12))[: at - 1] + b"\n" + inner + b"\n" + lead * 300
        hidden = base64.b64encode(zlib.compress(outer)).decode()
        assert any(k == "assign" for k, _, _ in secret_scan.scan(hidden)[1]), at


def test_unpacking_gives_what_was_packed():
    """Random nests of all compressions, fed in pieces of any size, against the bytes inside."""
    rng = random.Random(8)
    kinds = [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.ZstdCompressor().compress]
    for _ in range(60):
        inside = bytes(rng.choice(b"abc \n") for _ in range(rng.choice([0, 1, 9, 5000, 70_000])))
        raw = inside
        for _ in range(rng.randrange(1, 5)):
            raw = rng.choice(kinds)(raw)
        u, step, got = secret_scan.Unpacking(), rng.choice([1000, 1 << 16]), []
        for k in range(0, len(raw), step):
            got += u.feed(raw[k : k + step])
        got += u.finish()
        assert b"".join(map(bytes, got)) == inside
