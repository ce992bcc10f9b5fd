import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from coffer.llm import wavelet
from coffer.llm.wavelet import Encoder, WaveletMatrix

FILE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["a  b c\n d", "\tx  y", " a b ", "", "   ", "é b c", "a<|endoftext|>b c", "x\x1c y z", "it's 12\n\nno", "日本 語", "a  b", "Word " * 3000]


def test_matrix_operations():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 50257, 3000).astype(np.uint16)
    ids[::7] = 13
    matrix = WaveletMatrix.from_bytes(WaveletMatrix.build(ids, 16).to_bytes())
    assert (matrix.sequence() == ids).all()
    assert all(matrix.access(i) == ids[i] for i in range(0, 3000, 41))
    places = np.flatnonzero(ids == 13)
    assert matrix.count(13) == len(places) and matrix.count(13, 5, 777) == (ids[5:777] == 13).sum()
    assert all(matrix.select(13, k) == places[k] for k in range(0, len(places), 11))
    assert matrix.count(50300) == 0 and matrix.count(1 << 20) == 0
    with pytest.raises(IndexError):
        matrix.select(13, len(places))
    assert len(WaveletMatrix.from_bytes(WaveletMatrix.build(ids[:0], 16).to_bytes()).sequence()) == 0


def test_encoder_equals_the_library():
    plain, encoder = Tokenizer.from_file(FILE), Encoder(FILE)
    for texts in (TEXTS, TEXTS[::-1]):
        got = [np.frombuffer(b, "<u4").tolist() for b in encoder(texts)]
        assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_written_and_read(spark, tmp_path):
    rows = [(100 - i, t, 1) for i, t in enumerate(TEXTS)] + [(5, None, 1), (None, "no id", 1), (7, "twice", 1), (7, "twice", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    wavelet.write_shards(df, str(tmp_path / "ids"), FILE, end_id=2, files=3)
    shards = wavelet.read_shards(spark, str(tmp_path / "ids"))
    got = sorted(wavelet.documents_of(shards).collect(), key=lambda r: r["start"])
    plain, at = Tokenizer.from_file(FILE), 0
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for r, (doc_id, text, _) in zip(got, ordered, strict=True):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        assert tuple(r) == (doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert sum(r["occurrences"] for r in wavelet.occurrences(shards, 2).collect()) == len(rows)


def test_empty(spark, tmp_path):
    wavelet.write_shards(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "ids"), FILE, end_id=2)
    assert wavelet.documents_of(wavelet.read_shards(spark, str(tmp_path / "ids"))).collect() == []
