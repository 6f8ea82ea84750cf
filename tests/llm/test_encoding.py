import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.encoding import TOKENIZER_DIR, boundary_after, boundary_before, decode, decode_tree, encode, encode_tree, is_boundary, join_ids, load_tokenizer, token_counts

pytestmark = pytest.mark.skipif(not os.path.exists(f"{TOKENIZER_DIR}/byte_bpe_50k.tiktoken"), reason="no tokenizer files")
PIECES = ["word", " ", "  ", "\n", "\t\n ", "don't", "'ll", "123", " 4567", "é", "…", "你好", "🙂👍🏽", "a​b", "　", "\xa0", "!!", " ?", "İ", "<|endoftext|>", "x" * 40, "\r\n", "\x0b\x0c", " "]


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_trees_equal_whole_encoding():
    tok = load_tokenizer()
    for text in texts(300, 1):
        whole = tok.encoding.encode_ordinary(text)
        for leaf in (1, 2, 5, 17, 64):
            got = encode_tree(tok, text, leaf)
            assert list(got) == whole
            assert decode_tree(tok, list(got), 4) == text


def test_joins_at_every_place():
    tok = load_tokenizer()
    for text in texts(25, 2):
        for mid in range(len(text) + 1):
            left, right = (np.array(tok.encoding.encode_ordinary(t), np.int64) for t in (text[:mid], text[mid:]))
            assert list(join_ids(tok, text, 0, mid, len(text), left, right, 2)) == tok.encoding.encode_ordinary(text)


def test_equals_the_tokenizers_library():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(f"{TOKENIZER_DIR}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    tok = load_tokenizer()
    sample = texts(400, 3)
    assert [list(encode_tree(tok, s, 16)) for s in sample] == [e.ids for e in t.encode_batch(sample, add_special_tokens=False)]


def test_boundaries():
    assert boundary_before("ab cd", 5, 0) == 2 and boundary_before("abcd", 4, 0) is None
    assert boundary_after("ab cd", 0, 5) == 2 and boundary_after("ab  ", 2, 4) is None


def test_encode_defines_ids_of_empty_and_null_texts(spark):
    rows = [(1, ""), (2, None), (3, "a b"), (3, "a b"), (None, "x"), (5, "y" * 20_000 + " z" * 5_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit("clash"))
    got = encode(df, "doc_id", "text", leaf=64, chunk_chars=10)
    assert got.columns == ["doc_id", "ids"]
    found = {(r["doc_id"], None if r["ids"] is None else tuple(r["ids"])) for r in got.collect()}
    whole = load_tokenizer().encoding.encode_ordinary
    assert found == {(k, None if t is None else tuple(whole(t))) for k, t in rows} and got.count() == len(rows)
    assert encode(df.limit(0), "doc_id", "text").count() == 0
    counts = {(r["doc_id"], r["n_tokens"]) for r in token_counts(df, "doc_id", "text").collect()}
    assert counts == {(k, None if t is None else len(whole(t))) for k, t in rows}


def test_another_vocabulary():
    tok = load_tokenizer("byte_bpe_multi_50k")
    for text in texts(60, 4):
        assert list(encode_tree(tok, text, 8)) == tok.encoding.encode_ordinary(text)


def test_decoding_gives_back_every_text(spark):
    rows = [(1, "a b"), (2, ""), (3, None), (3, None), (None, "é " * 9000), (5, "護理" * 5000 + "，1a'll")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit("clash"))
    back = decode(encode(df, "doc_id", "text"), "doc_id", "ids")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    assert decode(encode(df.limit(0), "doc_id", "text"), "doc_id", "ids").count() == 0


def test_boundaries_in_texts_without_white_space():
    tok = load_tokenizer()
    for text in ("護理人員，檢查" * 3000, "0af3b9c2d1" * 3000, "it's'll'1''d" * 2000, "x" * 5000):
        assert list(encode_tree(tok, text, 64)) == tok.encoding.encode_ordinary(text)
    assert [i for i in range(1, 9) if is_boundary("ab12,c'd ", i)] == [2, 4, 5, 6, 8]
