import random

import numpy as np
import public_tokenizers

from coffer.llm import bpe

FILE, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def test_pieces_encode_like_the_whole():
    rng = random.Random(4)
    codec = bpe.encoding(FILE, PATTERN)
    parts = [" ", "  ", "\n", " \n", "a", "don't", "été", "12", "!?", " ", "日本", "'s", "\x1c"]
    for _ in range(200):
        text = "".join(rng.choices(parts, k=60))
        assert "".join(bpe.pieces(text, 7)) == text
        assert [i for p in bpe.pieces(text, 7) for i in codec.encode_ordinary(p)] == codec.encode_ordinary(text)
    long = "word été 12. " * 20000
    assert bpe.ids_of(long, codec).tolist() == codec.encode_ordinary(long)
    assert bpe.ids_of("x" * 200000, codec).tolist() == codec.encode_ordinary("x" * 200000)


def test_round_trip(spark):
    texts = [None, "", "<|endoftext|> plain", "naïve café", "a  b\n\n c"]
    df = spark.createDataFrame([(i, t, b"") for i, t in enumerate(texts)] * 2, "doc_id long, text string, ids binary")
    rows = bpe.decode(bpe.encode(df, FILE, PATTERN), FILE, PATTERN).collect()
    codec = bpe.encoding(FILE, PATTERN)
    assert len(rows) == 10
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert bytes(r["decoded"]) == text.encode()
        assert np.frombuffer(r["ids"], "<u4").tolist() == codec.encode_ordinary(text)
    assert bpe.encode(df.limit(0), FILE, PATTERN).collect() == []
