"""The operators against plain versions, on the small documents table and on the awkward one."""

import base64
import hashlib
import re
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import edge

from tidewire.llm import bpe, exact_dedup, line_dedup, packing, queries, simhash, substring_dedup, suffix_dedup

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
LAST = (1 << 63) - 1


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def pairs(rows):
    """(id or LAST, text), for plain versions."""
    return [(LAST if i is None else i, t or "") for i, t in rows]


def back(i):
    return None if i == LAST else i


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


@pytest.fixture(scope="module")
def small(spark, sf, rows):
    return spark.read.parquet(f"{sf}/documents.parquet"), list(rows.items())


def both(spark, small):
    return [small, (edge.frame(spark), edge.ROWS)]


def plain_exact(rows):
    groups = defaultdict(list)
    for i, t in pairs(rows):
        groups[t.translate({ord(c): None for c in SPACES})].append((-len(t), i))
    out = []
    for key, own in groups.items():
        best = min(own)
        taken = False
        for n, i in own:
            kept = (n, i) == best and not taken
            taken |= kept
            out.append((back(i), back(best[1]), len(own), kept, sha(key)))
    return out


@pytest.mark.parametrize("counters", [2, 1024])
def test_exact(spark, small, counters):
    for df, rows in both(spark, small):
        got = exact_dedup.exact_duplicates(df, counters=counters).collect()
        assert ordered((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in got) == ordered(plain_exact(rows))
    kept = exact_dedup.drop_exact_duplicates(edge.frame(spark), counters=counters)
    assert kept.columns == edge.frame(spark).columns
    assert kept.count() == sum(x[3] for x in plain_exact(edge.ROWS))
    assert exact_dedup.exact_duplicates(edge.empty(spark)).count() == 0


def test_misra_gries_keeps_frequent():
    counts = {bytes([i]): i for i in range(1, 30)}
    assert set(exact_dedup.shrink(counts, 4)) == {bytes([i]) for i in (26, 27, 28, 29)}


def plain_lines(rows, least=10):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACES))

    held = defaultdict(set)
    for i, t in pairs(rows):
        for x in t.split("\n"):
            held[key(x)].add(i)
    out = []
    for i, t in pairs(rows):
        lines = t.split("\n")
        kept = [x for x in lines if len(key(x)) < least or len(held[key(x)]) < 2 or min(held[key(x)]) == i]
        out.append((back(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_lines(spark, small, monkeypatch):
    for probes, shard in ((1 << 20, 1 << 18), (8, 16)):
        monkeypatch.setattr(line_dedup, "PROBES", probes)
        monkeypatch.setattr(line_dedup, "SHARD_LINES", shard)
        for df, rows in both(spark, small):
            got = line_dedup.deduplicate_lines(df)
            assert ordered((r.doc_id, int(r.lines_before), r.lines_dropped, r.text) for r in got.collect()) == ordered(plain_lines(rows))
            assert set(df.columns) <= set(got.columns)
    assert line_dedup.deduplicate_lines(edge.empty(spark)).count() == 0


def test_perfect_hash():
    from tidewire.llm.perfect_hash import PerfectHash

    keys = np.random.default_rng(1).integers(0, 1 << 63, (5000, 2)).astype(np.uint64)
    h = PerfectHash(keys)
    assert sorted(h(keys).tolist()) == list(range(5000))
    assert len(PerfectHash(keys[:0])(keys)) == 5000
    again = PerfectHash.unpacked(h.packed())
    assert (again(keys) == h(keys)).all() and again.n == 5000 and len(h.packed()) < 5000
    assert PerfectHash.unpacked(PerfectHash(keys[:0]).packed()).n == 0


def plain_windows(rows, size=20):
    docs = sorted(set(pairs(rows)), key=lambda p: (p[0], p[1].encode()))
    seen, out = set(), {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            own = tuple(w[k : k + size])
            if own in seen:
                gone[k : k + size] = [True] * size
            seen.add(own)
        out[i, t] = (back(i), len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return [out[p] for p in pairs(rows)]


def test_windows(spark, small, monkeypatch):
    for block, shard in ((12 << 20, 1 << 21), (4096, 1000)):
        monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", block)
        monkeypatch.setattr(substring_dedup, "SHARD_WINDOWS", shard)
        for df, rows in both(spark, small):
            got = substring_dedup.deduplicate_windows(df).collect()
            assert ordered((r.doc_id, r.n_words, r.n_removed, r.text) for r in got) == ordered(plain_windows(rows))
    assert substring_dedup.deduplicate_windows(edge.empty(spark)).count() == 0


def test_sorted_numbers_round_trip():
    for x in ([], [0], [5, 5, 9], sorted(np.random.default_rng(2).integers(0, 1 << 62, 999).tolist())):
        a = np.array(x, np.uint64)
        assert substring_dedup.unpack_sorted(substring_dedup.pack_sorted(a)).tolist() == x
        assert substring_dedup.unpack(substring_dedup.pack(a[::-1])).tolist() == x[::-1]


def plain_bytes(rows, size=50):
    least = {}
    for i, t in pairs(rows):
        b = t.encode()
        for k in range(len(b) - size + 1):
            s = b[k : k + size]
            least[s] = min(i, least.get(s, i))
    out = []
    for i, t in pairs(rows):
        b = t.encode()
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - size + 1):
            if least[b[k : k + size]] < i:
                gone[k : k + size] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((back(i), len(b), int(gone.sum()), spans, bytes(x for x, g in zip(b, gone[:-1].tolist(), strict=True) if not g)))
    return out


def test_bytes(spark, small, monkeypatch):
    for block, records, at_once, per_pass, ranges in ((12 << 20, 1 << 17, 1 << 18, 1 << 20, 1 << 16), (60_000, 500, 2000, 9000, 3)):
        monkeypatch.setattr(suffix_dedup, "RANGES", ranges)
        monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
        monkeypatch.setattr(suffix_dedup, "BUCKET_RECORDS", records)
        monkeypatch.setattr(suffix_dedup, "STRINGS", at_once)
        monkeypatch.setattr(suffix_dedup, "PASS_BYTES", per_pass)
        for df, rows in both(spark, small):
            got = suffix_dedup.deduplicate_bytes(df).collect()
            assert ordered((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.content)) for r in got) == ordered(plain_bytes(rows))
    assert suffix_dedup.deduplicate_bytes(edge.empty(spark)).count() == 0


@pytest.mark.parametrize("ranges, shared", [(40, True), (12, False)])
def test_bytes_of_hot_tokens_and_strings(spark, monkeypatch, ranges, shared):
    """A lead that most texts have spreads over many buckets, and a passage that most have over several, and none is lost."""
    for name, value in (("RANGES", ranges), ("BLOCK_BYTES", 9000), ("BUCKET_RECORDS", 60), ("STRINGS", 700), ("PASS_BYTES", 3000)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rng = np.random.default_rng(8)
    words = ["".join(map(chr, rng.integers(97, 123, 30))) for _ in range(400)]
    lead, passage = "a lead of more than twenty-four bytes", "a passage of over fifty bytes that is the same wherever it stands, whole"

    def word():
        return words[int(len(words) * rng.random() ** 3)]

    rows = [(k, f"{word()}{lead if k % 3 else passage}{word()}") for k in rng.permutation(900).tolist()]
    df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string").repartition(3)
    docs = df.select(F.col("doc_id").alias("id"), "text")
    splitters = suffix_dedup.sampled_splitters(docs, sum(len(t) for _, t in rows), ranges, 50, 24)
    assert len(splitters.hot) and (len(splitters.shared) > 0) == shared
    block = pa.table({"id": [i for i, _ in rows], "text": [t for _, t in rows]})
    own = suffix_dedup.Block(block)
    to, at, first, last, _ = splitters.deal(own, 5, own.anchors(50, 24), 50, 24, 4)
    assert (last - first + 1).sum() == sum(len(t) - 49 for _, t in rows)
    hot = np.isin(suffix_dedup.leading(own.bytes, at, 24), splitters.hot[:1])
    assert len(np.unique(to[hot])) >= min(8, ranges)
    got = suffix_dedup.deduplicate_bytes(df).collect()
    assert ordered((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.content)) for r in got) == ordered(plain_bytes(rows))


@pytest.mark.parametrize("small_range", [16, 1024])
def test_multikey_sort(monkeypatch, small_range):
    monkeypatch.setattr(suffix_dedup, "SMALL", small_range)
    rng = np.random.default_rng(3)
    rows = rng.integers(0, 3, (500, 4)).astype(np.uint64)
    order, new = suffix_dedup.multikey_sort(rows)
    got = [tuple(r) for r in rows[order].tolist()]
    assert got == sorted(map(tuple, rows.tolist()))
    assert new.tolist() == [k == 0 or got[k] != got[k - 1] for k in range(len(got))]


def plain_print(text, size=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    if not w:
        return 0
    shingles = [" ".join(w[k : k + size]) for k in range(len(w) - size + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(ids, prints):
    """Union of all pairs at most 2 bits apart: the smallest id of each row's group."""
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for k in range(len(ids)):
        least[find(k)] = min(ids[k], least.get(find(k), ids[k]))
    return [least[find(k)] for k in range(len(ids))]


def test_simhash(spark, small):
    for df, rows in both(spark, small):
        own = pairs(rows)
        prints = [plain_print(t) for _, t in own]
        groups = plain_groups([i for i, _ in own], prints)
        got = simhash.simhash_groups(df).collect()
        want = [(back(i), p, back(g)) for (i, _), p, g in zip(own, prints, groups, strict=True)]
        assert ordered((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == ordered(want)
    assert simhash.simhash_groups(edge.empty(spark)).count() == 0
    kept = simhash.one_of_each(edge.frame(spark))
    assert kept.columns == edge.frame(spark).columns
    assert [r.doc_id for r in kept.where("doc_id IN (11, 12)").collect()] == [11]


def test_simhash_links_of_made_prints(spark):
    """Chains and stars of prints one and two bits apart, and crowds three apart."""
    rng = np.random.default_rng(4)
    prints = set()
    for base in rng.integers(0, 1 << 63, 20).tolist():
        at = base
        for _ in range(30):
            prints.add(at)
            for b in rng.choice(64, int(rng.integers(1, 4)), replace=False).tolist():
                at ^= 1 << b
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = simhash.links(spark.createDataFrame([(0, p) for p in signed], "table int, fp long")).collect()
    where = {p: k for k, p in enumerate(signed)}
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in got:
        assert ((r.src ^ r.dst) & ((1 << 64) - 1)).bit_count() <= 2
        root[find(where[r.src])] = find(where[r.dst])
    want = plain_groups(list(range(len(prints))), prints)
    mine = [min(j for j in range(len(prints)) if find(j) == find(k)) for k in range(len(prints))]
    assert mine == want


def ranks():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def test_bpe(spark, small):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(), special_tokens={})
    for df, rows in both(spark, small):
        encoded = bpe.encode_documents(df)
        want = [(i, np.array(enc.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows]
        assert ordered((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in encoded.collect()) == ordered(want)
        assert ordered((r.doc_id, bytes(r.decoded)) for r in bpe.decode_documents(encoded).collect()) == ordered((i, d) for i, _, d in want)
    assert bpe.encode_documents(edge.empty(spark)).count() == 0


@pytest.mark.parametrize("text", ["it's 3 o'clock\n\n  don't\t stop " * 900, "a1b2c3" * 9000, "x" * 70_000, "  \n\n    word \x1c\x85 " * 4000, "été 漢字かな 😀👍🏽 " * 3000])
def test_bpe_pieces(text):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(), special_tokens={})
    assert "".join(bpe.pieces(text, 500)) == text
    assert [t for p in bpe.pieces(text, 500) for t in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def check_packing(got, rows, capacity=4096):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = defaultdict(list)
    for i, t in rows:
        docs[i].append(np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4"))
    want = defaultdict(int)
    for i, own in docs.items():
        for ids in own:
            for at in range(0, len(ids), capacity):
                want[i, at, zlib.crc32(ids[at : at + capacity].tobytes()), len(ids)] += 1
    sequences = defaultdict(list)
    for r in got:
        want[r.doc_id, r.start, r.ids_crc32, r.doc_tokens] -= 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert not any(want.values())
    waste = 0
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
        waste += packing.padding(at, capacity)
    return waste, sum(len(x) for own in docs.values() for x in own)


def test_packing(spark, small):
    for df, rows in both(spark, small):
        waste, total = check_packing(packing.pack(df).collect(), rows)
        assert waste <= max(4096, 0.02 * total)
    assert packing.pack(edge.empty(spark)).count() == 0
    got = packing.pack(edge.frame(spark), with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got)


def test_plan_fills_windows():
    rng = np.random.default_rng(5)
    histogram = {int(k): int(v) for k, v in zip(*np.unique(rng.integers(1, 4096, 20_000), return_counts=True), strict=True)}
    places, n = packing.plan(histogram)
    total = sum(k * v for k, v in histogram.items())
    assert n <= 1.01 * total / 4096
    assert packing.plan({}) == ([], 0)


def test_word_cache():
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["", " ", "Hello, World's 123 x y\x1cz", "<|endoftext|> a <|startoftext|>b", "é ́x \nİI ΣΑΣ ﬁ", "don't'll 'S", "\r\n\t tab\x0bvt\x0c漢字 😀"]
    got = packing.WordCache(public_tokenizers.path("word_bpe_49k.json")).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_largest_id_and_no_id(spark):
    """The largest id stays what it is beside rows without one, in every operator."""
    long = " ".join(f"w{k}" for k in range(60)) + "\na line that two rows hold"
    rows = [(LAST, long), (None, long), (None, long + " more"), (None, "another one"), (7, "short"), (LAST - 1, "x\na line that two rows hold")]
    df, want = edge.frame(spark, rows), sorted((i for i, _ in rows), key=str)
    got = {
        "exact": exact_dedup.exact_duplicates(df), "bytes": suffix_dedup.deduplicate_bytes(df), "windows": substring_dedup.deduplicate_windows(df), "lines": line_dedup.deduplicate_lines(df),
        "simhash": simhash.simhash_groups(df), "bpe": bpe.encode_documents(df),
    }
    for name, out in got.items():
        assert sorted((r.doc_id for r in out.select("doc_id").collect()), key=str) == want, name
    assert {r.doc_id for r in packing.pack(df).collect()} == set(want)
    assert {(r.doc_id, r.keep_id, r.kept) for r in got["exact"].collect() if r.doc_id in (LAST, None) and r.group_size == 2} == {(LAST, LAST, True), (None, LAST, False)}
    lines = got["lines"].where("lines_dropped > 0").select("doc_id").collect()
    assert LAST - 1 not in {r.doc_id for r in lines} and LAST in {r.doc_id for r in lines}
    assert [c for c in got["lines"].columns if not c.startswith("lines_")] == [c for c in df.columns if not c.startswith("lines_")]


def test_queries_have_their_columns(spark, sf):
    want = {
        "op1_exact_dedup": "doc_id keep_id group_size kept text_sha256", "op2_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256", "op3_quality": "doc_id held_out score predicted",
        "op4_substring_dedup": "doc_id n_words n_removed kept_sha256", "op5_secret_scans": "doc_id n_assign n_access n_hex base_sha256 spans",
        "op6_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset", "op7_simhash": "doc_id fingerprint component_id", "op8_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
        "op9_media": "page_id n_features component_id", "op10_line_dedup": "doc_id n_lines n_dropped kept_sha256",
        "op11_vector_codes": "vec_id code error label_error codebooks_sha256", "op12_lm_score": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op13_filter_audit": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
    }
    assert set(queries.QUERIES) == set(want)
    for name, cols in want.items():
        if name not in ("op2_suffix_dedup", "op4_substring_dedup"):  # held against SQL
            assert queries.QUERIES[name](spark, sf).columns == cols.split(), name
