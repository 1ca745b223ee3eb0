"""Token counts and packing against the tokenizer libraries."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from panelcast.llm import packing as P
from panelcast.llm.common import tokenizer_path
from panelcast.llm.token_counts import Counter, token_counts

DOCS = "/root/testdata/sf0.001/documents.parquet"
AWKWARD = [None, "", " ", "\n", "  \n\n a", "a  b", "▁", "▁▁ x", "<s> </s><unk><0x41>", "é́ 漢字😀\t　x\x00", "a" * 4000, "=-" * 900,
           "haha" * 1000 + " x", "    " * 300, "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "can't I'LL, it's. ... !!! a*$. b",
           "ΣΟΣ K \x1c\x85 ﬁ", "x" * 30_000, "wort " * 60_000]


def awkward():
    rng = random.Random(3)
    al = "ab  ▁\n\n xyzthe ing<s></s>é漢字😀\t　aaaa\x00.,'SREVLD1 "
    return AWKWARD + ["".join(rng.choice(al) for _ in range(rng.randint(0, 60))) for _ in range(400)]


@pytest.fixture(scope="module")
def piece_model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def word_model():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


def table_of(spark, texts):
    return spark.createDataFrame([(i, t, "x", 7) for i, t in enumerate(texts)] + [(None, "a b", "x", 7), (0, texts[0], "x", 7)],
                                 "doc_id bigint, text string, n_tokens string, part int")


def test_counts_equal_the_library(spark, piece_model):
    texts = awkward()
    got = token_counts(table_of(spark, texts), tokenizer_path("piece_bpe_32k.model"), limit=100).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        t = "a b" if r.doc_id is None else texts[r.doc_id] or ""
        n = len(piece_model.encode(t))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 100), t[:80]


def test_counts_of_a_whole_table(spark, piece_model):
    docs = spark.read.parquet(DOCS)
    want = {r.doc_id: len(piece_model.encode(r.text)) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in token_counts(docs, tokenizer_path("piece_bpe_32k.model")).collect()} == want


def test_counter_forgets_but_counts_the_same(piece_model, monkeypatch):
    import panelcast.llm.token_counts as T

    c = Counter(tokenizer_path("piece_bpe_32k.model"))
    c.seen.limit = 5
    texts = [t for t in awkward() if t]
    for _ in range(2):
        assert c(pa.array(texts)).tolist() == [len(x) for x in piece_model.encode(texts)]
    assert T.KEPT > 5


def check_pieces(rows, ids_of, window):
    """Pieces tile the documents and the windows, and hold the right ids."""
    docs, windows = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        windows.setdefault(r.sequence_id, []).append(r)
    for d, pieces in docs.items():
        want, at = ids_of[d], 0
        for r in sorted(pieces, key=lambda r: r.start):
            ids = np.frombuffer(r.ids, "<u4").tolist()
            assert (r.start, r.doc_tokens, r.length) == (at, len(want), len(ids)) and ids == want[at : at + r.length] and r.length > 0
            at += r.length
        assert at == len(want)
    for s, pieces in windows.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == window or s == max(windows) and at < window
    assert sorted(windows) == list(range(len(windows)))


@pytest.mark.parametrize("window", [64, 4096])
def test_packing_is_an_exact_round_trip(spark, word_model, window):
    texts = awkward()
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, ids int").repartition(5)
    pieces = P.pack(df, tokenizer_path("word_bpe_49k.json"), end_id=2, window=window)
    rows = pieces.collect()
    check_pieces(rows, {i: word_model.encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}, window)
    seqs = {r.sequence_id: r for r in P.sequences(pieces, window).collect()}
    joined = {}
    for r in sorted(rows, key=lambda r: r.offset):
        joined[r.sequence_id] = joined.get(r.sequence_id, b"") + bytes(r.ids)
    assert {s: bytes(r.ids) for s, r in seqs.items()} == joined
    assert all(r.padded_to == (r.n_ids if r.n_ids & (r.n_ids - 1) == 0 else window) for r in seqs.values())


def test_packing_query_digest(spark, word_model):
    from panelcast.llm.queries import op10_packing

    docs = {r.doc_id: word_model.encode(r.text, add_special_tokens=False).ids + [2] for r in spark.read.parquet(DOCS).collect()}
    rows = op10_packing(spark, "/root/testdata/sf0.001").collect()
    assert sum(r.length for r in rows) == sum(map(len, docs.values()))
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(docs[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_counts(df, tokenizer_path("piece_bpe_32k.model")).count() == 0
    assert P.pack(df, tokenizer_path("word_bpe_49k.json"), 2).count() == 0


def test_ids_behind_every_letter():
    """Punctuation behind any letter, as the library has it: some letters end in a mark once they are normalised."""
    import sys
    import unicodedata

    enc = P.WordEncoder(tokenizer_path("word_bpe_49k.json"))
    letters = [c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c)[0] == "L"]
    texts = [t.replace("@", c) for c in letters for t in ("@, x", "H@) b", "@\u0307. 's")] + ["\u0130. x <|endoftext|>", "a\u0130) b, c."]
    ids, n = enc(pa.array(texts))
    at = np.r_[0, np.cumsum(n)]
    assert [ids[i:j].tolist() for i, j in zip(at, at[1:])] == enc.ids(texts)
