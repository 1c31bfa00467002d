"""Byte-level BPE against the tiktoken library, with exact round trips."""

import base64
import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import tiktoken

from conftest import SF_SMALL
from occurlens.llm import bpe
from occurlens.llm.queries import BPE_RANKS, QUERIES

PATTERN = public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string"


def reference():
    with open(BPE_RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_encode_equals_library():
    enc, vocab, rng = reference(), bpe.vocabulary(BPE_RANKS, PATTERN), random.Random(3)
    texts = ["", " ", "a", "it's we'll\n\n  x", "a" * 3000, "ab" * 700, "<|endoftext|>", "né ñ 漢字 👩‍👩‍👧 ​", "\t\t  \n 1234567890" * 9,
             "=" * 500 + "-" * 33]
    texts += ["".join(rng.choice("aeinrst .,1#é漢\n'") for _ in range(rng.randint(1, 200))) for _ in range(200)]
    for text, ids in zip(texts, vocab.encode(texts)):
        assert ids == packed(enc.encode_ordinary(text)), text
        assert vocab.decode(ids) == text.encode()
    assert vocab.encode([None]) == [b""]


def test_long_text_in_runs(monkeypatch):
    vocab = bpe.vocabulary(BPE_RANKS, PATTERN)
    text = "The quick brown fox; it's 12 o'clock.\n" * 200
    whole = vocab.encode([text])
    monkeypatch.setattr(bpe, "LONG_TEXT", 100)
    monkeypatch.setattr(bpe, "PIECES_AT_ONCE", 7)
    assert vocab.encode([text]) == whole


def test_query_whole_table(spark):
    enc = reference()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op7_bpe"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = enc.encode_ordinary(d.text or "")
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed(ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_edges(spark):
    rows = spark.createDataFrame([(None, None), (1, ""), (1, "hi"), (1, "hi")], SCHEMA).selectExpr("*", "'x' as ids", "1 as row")
    out = bpe.encode(rows, BPE_RANKS, PATTERN).collect()
    assert sorted(len(r.ids) for r in out) == [0, 0, 4, 4] and out[0].row.ids == "x"
    assert bpe.digest(rows.limit(0), BPE_RANKS, PATTERN).count() == 0
    assert [r.ids for r in bpe.tokens(rows, BPE_RANKS, PATTERN).orderBy("n_tokens").collect()][0] == []


def test_long_pieces_equal_the_library_and_the_short_way():
    """Unbroken pieces: random letters, few letters (many ties and overlaps), repeats; one of 1 MB."""
    import time

    vocab, library = bpe.vocabulary(BPE_RANKS, PATTERN), reference()
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    for n in (2, 3, 50, 700, 5000):
        for alphabet in (letters, "ab", "aeth", "esting", "é漢a", "a"):
            text = "".join(rng.choice(alphabet) for _ in range(n))
            raw = text.encode()
            want = vocab.merge([raw], 1 << max(1, (len(raw) - 1).bit_length())) if len(raw) < 9000 else None
            got = vocab.merge_long(raw)
            assert want is None or got == want[0], (n, alphabet)
    for text in ("".join(rng.choice(letters) for _ in range(30000)), "the" * 9000 + "internationalization" * 500, "ha" * 20000):
        assert vocab.encode([text])[0] == np.array(library.encode_ordinary(text), "<u4").tobytes()
    big = "".join(rng.choice(letters) for _ in range(1 << 20))
    begin = time.perf_counter()
    ids = vocab.encode([big])[0]
    assert vocab.decode(ids) == big.encode() and time.perf_counter() - begin < 60
    assert ids == np.array(library.encode_ordinary(big), "<u4").tobytes()
