"""Token ids on disk as wavelet matrices: one compressed file a shard, with access, counting and lookup."""

from __future__ import annotations

import re
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Ids of a shard at most, unless one document alone has more.
SHARD_IDS = 1 << 21
#: Bits between two stored ranks.
BLOCK = 512
MAGIC = b"WVM1"
#: Chunks kept with their ids; some 200 bytes each.
MEMORY = 1_000_000
#: New chunks that go to the library as one text.
JOINED = 1 << 13
#: White space besides the single space and the line feed.
OTHER_SPACE = "\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: A single space between characters that are no white space: no merge crosses it.
SAFE = re.compile(r"(?<=\S) (?=\S)")


class WaveletMatrix:
    """A sequence of integers below 2**planes as bit planes, most significant first.

    Each plane is stored as packed bits with the number of ones before every BLOCK bits, so rank takes one lookup and
    one count in a block, and access, counting and lookup of occurrences take one rank a plane.
    """

    def __init__(self, length: int, planes: list[np.ndarray], zeros: list[int]):
        self.length, self.planes, self.zeros = length, planes, zeros
        self.ranks = [self._ranks(p) for p in planes]

    @staticmethod
    def _ranks(packed: np.ndarray) -> np.ndarray:
        ones = np.bitwise_count(np.pad(packed, (0, -len(packed) % (BLOCK // 8)))).reshape(-1, BLOCK // 8)
        return np.concatenate([[0], np.cumsum(ones.sum(axis=1, dtype=np.int64))])

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        now, planes, zeros = ids, [], []
        for k in range(bits - 1, -1, -1):
            ones = (now & now.dtype.type(1 << k)) != 0
            planes.append(np.packbits(ones, bitorder="little"))
            # Places first: numpy takes by place faster than by a mask that changes from value to value.
            low, high = np.flatnonzero(~ones), np.flatnonzero(ones)
            zeros.append(len(low))
            now = np.concatenate([now.take(low), now.take(high)])
        return cls(len(ids), planes, zeros)

    def sequence(self) -> np.ndarray:
        """All values in order, read plane by plane from the least significant."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        now = np.zeros(self.length, kind)
        for k, (packed, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros), strict=True)):
            ones = np.unpackbits(packed, count=self.length, bitorder="little").view(bool)
            before = np.empty(self.length, kind)
            before[np.flatnonzero(~ones)] = now[:zeros]
            before[np.flatnonzero(ones)] = now[zeros:] | kind(1 << k)
            now = before
        return now

    def _rank1(self, plane: int, at: int) -> int:
        first = at // BLOCK * (BLOCK // 8)
        inside = np.unpackbits(self.planes[plane][first : (at + 7) // 8], bitorder="little")[: at - first * 8]
        return int(self.ranks[plane][at // BLOCK] + inside.sum())

    def access(self, at: int) -> int:
        value = 0
        for plane in range(len(self.planes)):
            ones = self._rank1(plane, at)
            bit = self._rank1(plane, at + 1) - ones
            value = value << 1 | bit
            at = self.zeros[plane] + ones if bit else at - ones
        return value

    def _range(self, value: int, start: int, end: int) -> tuple[int, int]:
        for plane in range(len(self.planes)):
            a, b = self._rank1(plane, start), self._rank1(plane, end)
            if value >> (len(self.planes) - 1 - plane) & 1:
                start, end = self.zeros[plane] + a, self.zeros[plane] + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, value: int, start: int = 0, end: int | None = None) -> int:
        """How often value occurs in [start, end)."""
        if value >> len(self.planes):
            return 0
        low, high = self._range(value, start, self.length if end is None else end)
        return high - low

    def _select(self, plane: int, bit: int, nth: int) -> int:
        """Place of the nth set (or unset) bit, from 0: the block by its stored rank, then a look inside."""
        ranks = self.ranks[plane] if bit else np.arange(len(self.ranks[plane])) * BLOCK - self.ranks[plane]
        block = int(np.searchsorted(ranks, nth, side="right")) - 1
        first = block * (BLOCK // 8)
        inside = np.unpackbits(self.planes[plane][first : first + BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(inside == bit)[nth - int(ranks[block])])

    def select(self, value: int, nth: int) -> int:
        """Place of the nth occurrence of value, from 0."""
        low, high = self._range(value, 0, self.length) if not value >> len(self.planes) else (0, 0)
        if not 0 <= nth < high - low:
            raise IndexError(f"{value} occurs {high - low} times")
        at = low + nth
        for plane in reversed(range(len(self.planes))):
            bit = value >> (len(self.planes) - 1 - plane) & 1
            at = self._select(plane, bit, at - self.zeros[plane] if bit else at)
        return at

    def to_bytes(self) -> bytes:
        head = MAGIC + struct.pack("<QB", self.length, len(self.planes)) + struct.pack(f"<{len(self.zeros)}Q", *self.zeros)
        return zstandard.ZstdCompressor(level=1).compress(head + b"".join(p.tobytes() for p in self.planes))

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        plain = zstandard.ZstdDecompressor().decompress(data)
        if plain[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        length, bits = struct.unpack_from("<QB", plain, 4)
        zeros = list(struct.unpack_from(f"<{bits}Q", plain, 13))
        width, at = (length + 7) // 8, 13 + 8 * bits
        return cls(length, [np.frombuffer(plain, np.uint8, width, at + k * width) for k in range(bits)], zeros)


def chunks(text: str) -> list[str]:
    """The text cut at single spaces between other characters, without those spaces.

    str.split is several times as fast as the pattern, and the same where no white space is next to a space.
    """
    mixed = "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " "
    if mixed or any(s in text for s in OTHER_SPACE):
        return SAFE.split(text)
    return text.split(" ")


class _Memory:
    """Chunks with their ids. What was not used since the memory was last full is forgotten when it is full again."""

    def __init__(self):
        self.now: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def unknown(self, chunks: set[str]) -> list[str]:
        """The chunks that have to be learnt; those known from before are taken along."""
        if len(self.now) > MEMORY // 2:
            self.now, self.before = {}, self.now
        rest = chunks.difference(self.now)
        old = {c: self.before[c] for c in rest if c in self.before}
        self.now.update(old)
        return list(rest.difference(old))


class Encoder:
    """ids of whole texts by the tokenizers library, which is asked once for each different chunk.

    A text is cut at single spaces between other characters; there, no piece of byte-level BPE goes across, so the
    chunks' ids in a row are the text's. New chunks go to the library as one long text, whose ids are told apart by the
    bytes they stand for; if ever one crossed a cut, the chunks would be encoded one by one. Texts that hold the string
    of an added token are encoded whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Byte-level tokens are written with one character a byte.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.sizes[list(vocabulary.values())] = [len(token) for token in vocabulary]
        self.after_space, self.at_start = _Memory(), _Memory()

    def _one_by_one(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, texts: list[str]) -> list[bytes]:
        """ids of texts that each start with a space and hold no white space at either end besides."""
        whole = "".join(texts)
        ids = np.array(self.tokenizer.encode_batch_fast([whole], add_special_tokens=False)[0].ids, "<u4")
        sizes = map(len, texts) if whole.isascii() else [len(text.encode()) for text in texts]
        ends = np.cumsum(np.fromiter(sizes, np.int64, len(texts)))
        ids_end = np.cumsum(self.sizes[np.minimum(ids, len(self.sizes) - 1)])
        upto = np.searchsorted(ids_end, ends)
        if not len(ids) or upto[-1] != len(ids) - 1 or not np.array_equal(ids_end[upto], ends):
            return self._one_by_one(texts)
        raw, cuts = ids.tobytes(), (4 * (upto + 1)).tolist()
        return [raw[i:j] for i, j in zip([0, *cuts], cuts)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        parts = [None if any(a in text for a in self.added) else chunks(text) for text in texts]
        usual = [p for p in parts if p]
        # Only a text's last chunk can end in white space; such a one must not stand before another.
        needed = set().union(*[p[1:] for p in usual])
        odd = {p[-1] for p in usual if p[-1][-1:].isspace()}
        fresh = self.after_space.unknown(needed)
        plain = [c for c in fresh if c not in odd]
        for at in range(0, len(plain), JOINED):
            some = plain[at : at + JOINED]
            self.after_space.now.update(zip(some, self._joined([" " + c for c in some]), strict=True))
        last = [c for c in fresh if c in odd]
        self.after_space.now.update(zip(last, self._one_by_one([" " + c for c in last]), strict=True))
        first = self.at_start.unknown({p[0] for p in usual})
        self.at_start.now.update(zip(first, self._one_by_one(first), strict=True))
        known, begun = self.after_space.now.__getitem__, self.at_start.now.__getitem__
        return [
            begun(p[0]) + b"".join(map(known, p[1:]))
            if p
            else np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            for text, p in zip(texts, parts, strict=True)
        ]


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """One a Python worker, so that what it knows serves later tasks too."""
    return Encoder(path)


def write_shards(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int, bits: int = 16, files: int | None = None) -> None:
    """Encode whole texts in ascending doc_id order, end_id after each, and write one file of ids a shard.

    A file is a Parquet row group of one row: part and number (order of the shards), doc_ids, lengths and matrix, the
    compressed wavelet matrix. Spark's commit makes the files safe against lost tasks. Ranges of doc_id go to parts;
    a part starts another shard after SHARD_IDS ids, so memory is bounded by that and the longest document. NULL and
    empty texts have end_id alone. Rows of one doc_id follow one another by a hash of their text; NULL doc_ids come first. Other
    columns are left out.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    kind_arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]

    def run(batches):
        encoder, part, number = _encoder(tokenizer_file), TaskContext.get().partitionId(), 0
        doc_ids, bodies, held = [], [], 0

        def shard():
            ids = np.frombuffer(b"".join(bodies), "<u4")
            matrix = WaveletMatrix.build(ids.astype(np.uint16 if bits <= 16 else np.uint32), bits)
            lengths = [len(b) // 4 for b in bodies]
            columns = [
                pa.array([part], pa.int32()),
                pa.array([number], pa.int32()),
                pa.array([len(ids)], pa.int64()),
                pa.array([doc_ids], pa.list_(kind_arrow)),
                pa.array([lengths], pa.list_(pa.int64())),
                pa.array([matrix.to_bytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["part", "number", "n_ids", "doc_ids", "lengths", "matrix"])

        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                texts = [t or "" for t in some.column(1).to_pylist()]
                for doc_id, body in zip(some.column(0).to_pylist(), encoder(texts), strict=True):
                    if held and held + len(body) // 4 + 1 > SHARD_IDS:
                        yield shard()
                        doc_ids, bodies, held, number = [], [], 0, number + 1
                    doc_ids.append(doc_id)
                    bodies.append(body + end)
                    held += len(body) // 4 + 1
        if doc_ids:
            yield shard()

    schema = f"part int, number int, n_ids bigint, doc_ids array<{kind}>, lengths array<bigint>, matrix binary"
    source = docs.select("doc_id", "text")
    by = "doc_id", F.xxhash64("text")
    spread = source.repartitionByRange(files, *by) if files else source.repartitionByRange(*by)
    shards = spread.sortWithinPartitions(*by).mapInArrow(run, schema)
    shards.write.option("maxRecordsPerFile", 1).option("compression", "uncompressed").parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The shard table with base, the ids in all shards before it."""
    shards = spark.read.parquet(folder)
    sizes = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_base"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("part", "number", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("shard_base"))
    bases = starts.join(parts, "part").select("part", "number", (F.col("part_base") + F.col("shard_base")).alias("base"))
    return shards.join(bases, ["part", "number"])


def documents_of(shards: DataFrame) -> DataFrame:
    """doc_id, start (ids before the document), n_tokens and ids_crc32 of each document, from the matrices."""
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = WaveletMatrix.from_bytes(row["matrix"]).sequence().astype("<u4")
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                raw = memoryview(ids.tobytes())
                sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), row["lengths"], strict=True)]
                doc_ids = pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type)
                starts = row["base"] + ends - lengths
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(starts), pa.array(lengths), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    read = shards.select("doc_ids", "lengths", "matrix", "base")
    return read.mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """part, number and occurrences of a token per shard, by rank alone."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n = WaveletMatrix.from_bytes(row["matrix"]).count(token)
                yield pa.RecordBatch.from_pylist([{"part": row["part"], "number": row["number"], "occurrences": n}], schema=out)

    out = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("occurrences", pa.int64())])
    return shards.select("part", "number", "matrix").mapInArrow(run, "part int, number int, occurrences bigint")
