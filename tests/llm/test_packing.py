"""Packing: the ids, the pieces and the sequences."""

import re
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from epiloom.llm import packing as P

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["", " ", "\n\n  x", "a  b\t c", "it's I'LL", "日本語 テキスト", "🙂🙂 é́ ﬀ", "<|endoftext|>", "\x00\x01", "x" * 3000, " " * 3000, "1234567 89", "K ſ ı"]


def ids_of(texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_ids_equal_those_of_tokenizers(spark):
    texts = ODD + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    encode = P.encoder(RANKS, public_tokenizers.PATTERN)
    assert [encode(t).tolist() for t in texts] == ids_of(texts)


def test_long_texts_are_cut_where_no_token_is(monkeypatch):
    monkeypatch.setattr(P, "_CHUNK", 50)
    text = " ".join(f"word{i} 12 ab, it's\n x" for i in range(200))
    assert P.encoder.__wrapped__(RANKS, public_tokenizers.PATTERN)(text).tolist() == ids_of([text])[0]


@pytest.mark.parametrize("n", [1, 2, 3, 682, 683, 1023, 1024, 1025, 1500, 2047, 2048, 2049, 10_000])
def test_cut(n):
    pieces = list(P.cut(n))
    assert sum(length for _, length in pieces) == n and [s for s, _ in pieces] == list(np.cumsum([0] + [x for _, x in pieces])[:-1])
    for _, length in pieces[:-1]:
        assert 2048 // (2048 // length) == length  # fills its slot


def test_best_fit():
    rng = random.Random(1)
    lengths = [rng.randrange(1, 2048) for _ in range(500)]
    places = P.best_fit(lengths)
    used = defaultdict(list)
    for (number, offset), length in zip(places, lengths, strict=True):
        used[number].append((offset, length))
    for held in used.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(used) <= 1.1 * sum(lengths) / 2048 + 1


def test_pack(spark):
    texts = [*ODD, None, *(("w " * k) for k in (10, 700, 1400, 5000)), *["same text"] * 50]
    docs = spark.createDataFrame([(i if i != 3 else None, t, 7) for i, t in enumerate(texts)], "doc_id bigint, text string, offset int")
    rows = P.pack(docs.repartition(5), RANKS, public_tokenizers.PATTERN).collect()
    ids = {i if i != 3 else None: [*x, 1] for i, x in enumerate(ids_of([t or "" for t in texts]))}
    sequences, covered = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(np.array(own[r.start : r.start + r.length], "<u4").tobytes())
        sequences[r.sequence_id].append((r.offset, r.length))
        covered[r.doc_id].append((r.start, r.length))
    for held, total in [*((s, 2048) for s in sequences.values()), *((c, None) for c in covered.values())]:
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert total is None or at <= total
    assert {d: sum(n for _, n in c) for d, c in covered.items()} == {d: len(x) for d, x in ids.items()}
    assert P.pack(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


MARKED = ["end of text <|endoftext|> next", "<|endoftext|>", "a  <|endoftext|>  b", "x<|endoftext|><|endoftext|>\n\n y", "<|endoftext|", "<|ENDOFTEXT|>", " <|endoftext|>é"]


def test_special_text_gets_its_id(monkeypatch):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert P.ADDED == tuple((x.content, i) for i, x in t.get_added_tokens_decoder().items())
    texts = [*MARKED, *ODD]
    want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert 50256 in want[0]
    encode = P.encoder(RANKS, public_tokenizers.PATTERN, P.ADDED)
    assert [encode(x).tolist() for x in texts] == want
    monkeypatch.setattr(P, "_CHUNK", 20)
    long = " ".join(f"word{i} a b<|endoftext|>c d <|endoftext|> e" for i in range(100))
    assert P.encoder.__wrapped__(RANKS, public_tokenizers.PATTERN, P.ADDED)(long).tolist() == t.encode(long, add_special_tokens=False).ids


def test_op3_uses_the_special_ids(spark, tmp_path):
    from epiloom.llm.packing_queries import op3

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    spark.createDataFrame(list(enumerate(MARKED)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in op3(spark, str(tmp_path)).collect() if r.start == 0}
    for i, text in enumerate(MARKED):
        ids = [*t.encode(text, add_special_tokens=False).ids, 1]
        assert rows[i].doc_tokens == len(ids)
        assert rows[i].ids_crc32 == zlib.crc32(np.array(ids[: rows[i].length], "<u4").tobytes())


@pytest.mark.parametrize("white", [" ", "\n", "\t", " \n", "\u3000", "\u00a0 "])
@pytest.mark.parametrize("after", ["", "word", ".", "7", "<|endoftext|>", " <|endoftext|> x"])
def test_long_runs_of_white_space(monkeypatch, white, after):
    """Cut out above ten characters here, so that many places of the cut are compared."""
    monkeypatch.setattr(P, "_WHITE", re.compile(P._WHITE.pattern.replace(str(P._LONG_RUN), "10")))
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = P.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, P.ADDED)
    for n in (9, 10, 11, 12, 300):
        text = "a" + white * n + after + white * n + after
        assert encode(text).tolist() == t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("white", [" ", "\n"])
def test_two_million_of_white_space(white):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = P.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, P.ADDED)
    text = "a" + white * 2_000_000 + "b"
    assert encode(text).tolist() == t.encode(text, add_special_tokens=False).ids
