import base64
import gzip
import re
import sys
import zlib
from pathlib import Path
from urllib.parse import quote

import duckdb
import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import edge

from tidewire.llm import media, quality, secret_scan

SECRET = 'password = "hunter2hunter2XY"'
KEY = "AKIA" + "ABCDEFGH12345678"


def plain_base(text):
    kinds = [
        ("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
        ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]+", 0, 16),
    ]
    out = [(m.start(), n, k, m.end()) for n, (k, p, g, least) in enumerate(kinds) for m in re.finditer(p, text) if len(m[g]) >= least]
    return [(k, a, b) for a, _, k, b in sorted(out)]


CASES = ["", "x", SECRET, f"é {KEY} 😀 token:abcdefghijkl", "password: secret: abcdefghijklmnop", "api_key=short", "0123456789abcdef" * 3, "PASSWD='" + "a" * 12 + "'", "ſecret=abcdefghijklmno", "secret = token = abcdefghijklmnop"]


@pytest.mark.parametrize("text", CASES)
def test_base(text):
    assert secret_scan.scan(text)[0] == plain_base(text)
    assert set(plain_base(text)) <= set(secret_scan.scan(text)[1])


def test_documents_base(rows):
    assert all(secret_scan.scan(t)[0] == plain_base(t) for t in rows.values())


def b64(x):
    return base64.b64encode(x if isinstance(x, bytes) else x.encode()).decode()


@pytest.mark.parametrize(
    "hidden",
    [quote(SECRET), quote(quote(SECRET, safe=""), safe=""), b64(SECRET), b64(b64(SECRET)), b64(gzip.compress(SECRET.encode())), b64(zlib.compress(b64(SECRET).encode())), "".join(f"\\u{ord(c):04x}" for c in SECRET), b64(quote(SECRET, safe="")), "".join(f"&#{ord(c)};" for c in SECRET), base64.urlsafe_b64encode(SECRET.encode()).decode()],
)
def test_layers(hidden):
    text = f"lead é {hidden} end"
    _, spans = secret_scan.scan(text)
    found = [(a, b) for k, a, b in spans if k == "assign"]
    assert found and all(7 <= a < b <= 7 + len(hidden) for a, b in found)
    assert SECRET not in secret_scan.masked(text)[0] and secret_scan.masked(text)[0].endswith(" end")


def test_percent_spans_map_back():
    text = "x=1&q=token%3Dabcdefghij%6Blm&y"
    _, spans = secret_scan.scan(text)
    assert ("assign", text.index("token"), text.index("&y")) in spans


def test_cycles_end():
    assert secret_scan.scan("%2525252525" * 50)
    assert secret_scan.scan("%25" * 3000)


def test_scan_table(spark):
    got = secret_scan.scan_documents(edge.frame(spark)).collect()
    assert len(got) == len(edge.ROWS)
    assert secret_scan.scan_documents(edge.empty(spark)).count() == 0


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in quality.score_documents(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    known = duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall()
    held = [(got[i].predicted, y) for i, y in known if got[i].held_out]
    assert np.mean([p == y for p, y in held]) >= 0.95


def test_quality_ignores_held_out_labels(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality", "toxic")
    a, b = ({r.doc_id: r.score for r in quality.score_documents(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1), (5, 0), (10, 0), (None, 1), (11, None)], "doc_id long, quality int")
    got = quality.score_documents(edge.frame(spark), labels).collect()
    assert len(got) == len(edge.ROWS) and all(r.score is not None for r in got)
    assert quality.keep_good(edge.frame(spark), labels).columns == edge.frame(spark).columns
    none = quality.score_documents(edge.frame(spark), labels.limit(0)).collect()
    assert {r.score for r in none} == {1.0}
    assert quality.score_documents(edge.empty(spark), labels).count() == 0


def picture(seed, h=90, w=110):
    rng = np.random.default_rng(seed)
    img = np.full((h, w), 255, np.uint8)
    for _ in range(60):
        y, x, a, b = rng.integers(0, h - 8), rng.integers(0, w - 8), rng.integers(3, 20), rng.integers(3, 20)
        img[y : y + a, x : x + b] = rng.integers(0, 220)
    return img


def test_media_copies(spark):
    base = picture(1)
    edited = base.copy()
    edited[5:25, 5:30] = 128
    light = np.clip(base.astype(int) // 2 + 100, 0, 255).astype(np.uint8)
    rows = [(1, base), (2, base[10:, 12:]), (3, edited), (4, light), (5, picture(2)), (6, picture(3)), (7, base), (8, np.rot90(base))]
    table = [(i, media.png(x)) for i, x in rows] + [(9, None), (10, b""), (11, b"\x89PNG\r\n\x1a\nbroken"), (None, media.png(base)), (12, b"P5 4 4 255 " + bytes(16))]
    got = {r.id: r.component_id for r in media.image_copies(spark.createDataFrame(table, "id long, image binary")).collect()}
    assert {i for i, c in got.items() if c == 1} >= {1, 2, 3, 4, 7, 8, None}
    assert {i: got[i] for i in (5, 6, 9, 10, 11, 12)} == {i: i for i in (5, 6, 9, 10, 11, 12)}
    assert media.image_copies(spark.createDataFrame([], "id long, image binary")).count() == 0


def test_png_round_trip():
    img = picture(4)
    assert (np.rint(media.decode(media.png(img)) * 255) == img).all()


@pytest.mark.parametrize("kind", [1, 2, 3, 4])
def test_png_filters(kind):
    img, n = np.random.default_rng(kind).integers(0, 256, (5, 7, 3)), 3
    raw = bytearray()
    flat = img.reshape(5, -1)
    for y in range(5):
        raw.append(kind)
        for x in range(21):
            a, b, c = int(flat[y, x - n]) if x >= n else 0, int(flat[y - 1, x]) if y else 0, int(flat[y - 1, x - n]) if y and x >= n else 0
            p = a + b - c
            guess = {1: a, 2: b, 3: (a + b) // 2, 4: min((a, b, c), key=lambda v: abs(p - v))}[kind]
            raw.append((int(flat[y, x]) - guess) & 255)
    assert (media._unfiltered(np.frombuffer(bytes(raw), np.uint8), 7, 5, 3) == img).all()
