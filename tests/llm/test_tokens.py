import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from larder.llm import bpe, queries, token_counts

BPE, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))

TEXTS = [
    None, "", " ", "  ", "a", "Hello world", " leading", "trailing  ", "tabs\tand\n\nlines \n x",
    "don't we'll I'd 'tis", "1234 56,78 <|endoftext|>x<|endoftext|>", "<|endoftext|", "naïve éê ß",
    "日本語のテキスト", "emoji 👍🏽 \U0001F9D1‍\U0001F680", "  x　", "՘ ꟎",
    "▁a ▁ b▁▁c", "<s> </s> <unk> <0x0A>", "\x00\x1c\x85", "a" * 5000, "ab" * 3000 + " " * 700,
    "=-" * 900 + "!" * 1000, "thththererehehin" * 400, "\r\n\r\n", "x́" * 50]


def scrambled(seed: int, length: int) -> str:
    pick = random.Random(seed)
    return "".join(pick.choice(["the", "er", "in", " ", "  ", "\n", "é", "1", "'s", "#", "▁", "ing",
                                "\t", "Q", "zz", "-", "日", " "]) for _ in range(length))


ALL = TEXTS + [scrambled(i, 200) for i in range(60)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None if i % 9 == 4 else i, t, "x", 7) for i, t in enumerate(ALL)] + [(1, "again", "y", 8)] * 3
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, piece int").repartition(3)


def test_ids_and_texts_equal_the_library(docs):
    library = Tokenizer.from_file(BPE)
    got = bpe.decoded(bpe.encoded(docs, BPE), BPE).collect()
    want = [library.encode(r.text or "", add_special_tokens=False).ids for r in docs.collect()]
    assert sorted(map(tuple, want)) == sorted(tuple(r.ids) for r in got)
    for row in got:
        assert row.text == library.decode(row.ids, skip_special_tokens=False)
    both = bpe.encoded(docs, BPE, read_back=True).collect()
    assert sorted((tuple(r.ids), r.text) for r in both) == sorted((tuple(r.ids), r.text) for r in got)
    assert bpe.encoded(docs.limit(0), BPE, read_back=True).count() == 0


def test_any_ids_decode_like_the_library():
    library, own, pick = Tokenizer.from_file(BPE), bpe.Tokenizer(BPE), random.Random(5)
    import numpy as np
    for _ in range(300):
        ids = np.array([pick.randrange(50257) for _ in range(20)] + [pick.randrange(256)] * 2)
        assert own.decode(ids, step=3) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_segments_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "SEGMENT", 7)
    library, own = Tokenizer.from_file(BPE), bpe.Tokenizer(BPE)
    for text in filter(None, ALL):
        assert [i for part in own.encode(text) for i in part] == library.encode(
            text, add_special_tokens=False).ids


def test_the_window_stays_bounded():
    merges, pick = bpe.Merges(BPE), random.Random(3)
    for letters in ("ab", "etaoin", "=-", "a", "éx"):
        encoder, window, ids = bpe.Encoder(merges), 0, []
        text = "".join(pick.choice(letters) for _ in range(20_000)).encode()
        for i in range(0, len(text), 100):
            ids += encoder.push(text[i:i + 100])
            window = max(window, len(encoder.window))
        assert window <= 3 * merges.lookahead + 100
        ids += encoder.finish()
        assert b"".join(map(merges.bytes_of.__getitem__, ids)) == text


def test_op4_query(spark, sf_dir):
    library = Tokenizer.from_file(BPE)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op4_bpe(spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id] == (len(ids), digest(",".join(map(str, ids))), digest(
            library.decode(ids, skip_special_tokens=False)))


@pytest.mark.parametrize("head", [0, 5, 100_000])
def test_counts_equal_the_library(docs, head):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = token_counts.counted(docs, PIECES, head).collect()
    want = [(len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in docs.collect()]
    assert sorted(want) == sorted((r.n_bytes, r.n_tokens) for r in got)
    ids = lambda rows: sorted(str(r.doc_id) for r in rows)
    assert ids(got) == ids(docs.select("doc_id").collect())
    assert token_counts.counted(docs.where(F.lit(False)), PIECES, head).count() == 0


def test_op9_query(spark, sf_dir):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r.doc_id: tuple(r)[1:] for r in queries.op9_token_counts(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        n = len(library.encode(r.text or ""))
        assert got.pop(r.doc_id) == (len((r.text or "").encode()), n, n > 4096)
    assert not got
