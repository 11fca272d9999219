import base64
import random

import pytest

from tapeloom.llm.encode import WORD_PATTERN, Encoder, Merges, encode, vocabulary_text
from tapeloom.llm import encode as module
from tapeloom.llm.tokens import Counter, count_tokens, rank_text

HARD = [
    "", " ", "\n\n\n x\t", "a" * 3000, " " * 1000, "ab" * 500, "0123456789" * 100, "中文没有空格" * 200, "é" * 300, "👍🏽 ok", "龍契士の魔サーティワン裏覚醒",
    "<|endoftext|> is text", "﻿abc\x00\x1c", "!?" * 200, "it's we'll I'D", "ﬁ ① ² Ⅷ", "x" + "́" * 5, "퟿",
]


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_text().splitlines())}
    return tiktoken.Encoding("own", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def ids(encoder, texts):
    flat, lengths = encoder.encode(texts)
    out, at = [], 0
    for n in lengths:
        out.append(flat[at : at + n].tolist())
        at += n
    return out


def test_same_as_the_library(library):
    rnd = random.Random(0)
    letters = "ab eE1.,'\n\t中文字é👍_-"
    texts = HARD + ["".join(rnd.choice(letters) for _ in range(rnd.randrange(80))) for _ in range(300)]
    assert ids(Encoder(vocabulary_text()), texts) == [library(t) for t in texts]


def test_limits_change_nothing(library, monkeypatch):
    monkeypatch.setattr(module, "LIST_WORDS", 50)
    monkeypatch.setattr(module, "QUERY_BYTES", 64)
    monkeypatch.setattr(module, "REMEMBERED", 10)
    encoder = Encoder(vocabulary_text())
    for _ in range(2):
        assert ids(encoder, HARD) == [library(t) for t in HARD]


def test_random_bytes_decode_to_themselves():
    import json

    text = vocabulary_text()
    vocab, letters = json.loads(text)["model"]["vocab"], module.byte_letters()
    back = {i: bytes(letters[c] for c in token) for token, i in vocab.items() if all(c in letters for c in token)}
    merges = Merges(text)
    rnd = random.Random(2)
    words = [rnd.randbytes(rnd.randrange(1, 60)) for _ in range(200)]
    assert [b"".join(back[i] for i in got) for got in merges.encode(words)] == words


def test_words_as_by_the_pattern():
    import regex

    finder, pattern, rnd = module.WordFinder(), regex.compile(WORD_PATTERN), random.Random(4)
    plane = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    for i in range(200):
        text = "".join(rnd.choice(plane) for _ in range(300)) + "".join(rnd.choice(" '\nsa1中é") for _ in range(100)) + ("𝔸𝟙👍" if i % 2 else "")
        assert finder.findall(text) == pattern.findall(text) == [m.group() for m in finder.finditer(text)]
    assert all(finder.findall(f"a{c} {c}1") == pattern.findall(f"a{c} {c}1") for c in plane)


def test_frame(spark, library):
    rows = [(1, None, "n"), (2, "", "e"), (3, "same words", "a"), (3, "same words", "a"), (4, "中文 " * 5000, None)]
    df = encode(spark.createDataFrame(rows, "doc_id bigint, text string, tag string"), "text")
    assert df.dtypes == [("doc_id", "bigint"), ("tag", "string"), ("ids", "array<int>")]
    assert sorted((r["doc_id"], r["tag"] or "", r["ids"]) for r in df.collect()) == sorted((i, tag or "", library(t or "")) for i, t, tag in rows)
    assert encode(df.select("doc_id", "tag").limit(0).withColumnRenamed("tag", "text"), "text").collect() == []


def test_clashing_names(spark, library):
    df = spark.createDataFrame([("a b", 5, 6, 7)], "text string, ids int, __text int, n_tokens int")
    assert encode(df, "text").first().asDict() == {"ids_in": 5, "__text": 6, "n_tokens": 7, "ids": library("a b")}
    assert count_tokens(df, "text").first().asDict() == {"ids": 5, "__text": 6, "n_tokens_in": 7, "n_tokens": 2}


def test_counts(spark, library):
    counter = Counter(rank_text())
    assert [counter.text(t) for t in [*HARD, None]] == [len(library(t)) for t in [*HARD, ""]]
