"""Byte-level BPE with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

#: Texts beyond this many characters are encoded in pieces.
PIECE = 1 << 16
#: Between a character that is no white space and a single space before another one, no match of the pattern crosses.
SAFE = re.compile(r"(?<=\S)(?= \S)")


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE):
    """The text cut at safe boundaries only; a stretch without one stays whole."""
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def ids_of(text: str, codec: tiktoken.Encoding) -> np.ndarray:
    if len(text) <= PIECE:
        return np.array(codec.encode_ordinary(text), dtype="<u4")
    return np.concatenate([np.array(codec.encode_ordinary(p), dtype="<u4") for p in pieces(text)])


def encode(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id and ids, the token ids of the whole text as little-endian unsigned 32-bit integers.

    Special tokens do not exist: their strings are ordinary text. NULL and empty texts have no ids. Every row gives a
    row, repeated ones too; other columns are left out.
    """

    def run(batches):
        codec = encoding(rank_file, pattern)
        for batch in batches:
            ids = [ids_of(text or "", codec).tobytes() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """encoded with a column decoded: the bytes of its ids. Bytes, since ids may end inside a character."""

    def run(batches):
        codec = encoding(rank_file, pattern)
        for batch in batches:
            bytes_of = [codec.decode_bytes(np.frombuffer(ids or b"", "<u4").tolist()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bytes_of, pa.binary())], ["doc_id", "ids", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")
