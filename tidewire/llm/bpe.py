"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame

from tidewire.llm.common import by_text

#: Texts above this many characters are split before encoding.
LONG_CHARS = 1 << 16
#: A cut between these two characters never lies within a match of the pattern: no match goes on from a letter or a digit to
#: white space, from a letter to a digit or back, and the pattern's one look-ahead is about white space alone.
SAFE = regex.compile(r"(?<=\p{L})(?=[\x20\n])|(?<=\p{N})(?=[\x20\n])|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """One per process; the rank file lies at the same path on every machine."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = LONG_CHARS) -> list[str]:
    """Cut a long text at safe boundaries into pieces of about ``size``; a run without one stays whole."""
    out, at = [], 0
    while len(text) - at > size:
        cut = SAFE.search(text, at + size)
        if not cut:
            break
        out.append(text[at : cut.start()])
        at = cut.start()
    return [*out, text[at:]]


def encode(text: str, enc: tiktoken.Encoding) -> np.ndarray:
    parts = [np.array(enc.encode_ordinary(x), "<u4") for x in pieces(text)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit), n_tokens and the bytes that the ids decode to, for every row.

    Null and empty texts have no ids. Ids and repeated rows pass as they are; other columns are not read.
    """
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

    def each(_, texts):
        enc = encoding(path, pattern)
        ids = [encode(x.decode(), enc) for x in texts]
        return {"n_tokens": pa.array([len(x) for x in ids], pa.int64()), "ids": pa.array([x.tobytes() for x in ids], pa.binary()), "decoded": pa.array([enc.decode_bytes(x.tolist()) for x in ids], pa.binary())}

    return by_text(docs, each, "n_tokens long, ids binary, decoded binary", id_col, text_col)


def decode_documents(encoded: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id and the raw bytes of a column ids (as above; null: none). Bytes that are no valid UTF-8 stay as they are."""
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

    def run(batches):
        enc = encoding(path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([enc.decode_bytes(np.frombuffer(x or b"", "<u4").tolist()) for x in batch.column(1).to_pylist()], pa.binary())], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")
