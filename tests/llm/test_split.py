import random

import pytest

from tapeloom.llm.split import Splitter, split_texts
from tapeloom.llm.tokens import Counter, rank_text

PARTS = ["一、重要提示\n", "公司前三季度实现收入25.1亿元，同比增长3%。", "The name fell 4.5% today. ", "\n\n", "\n", "  ", "x" * 90, "中" * 70, "👍🏽", "# Head\n", "; ", "？！”", "\t"]


@pytest.fixture(scope="module")
def splitter():
    return Splitter(Counter(rank_text()))


def check(splitter, text, limit, overlap):
    pieces, count = splitter.split(text, limit, overlap), splitter.counter.text
    assert pieces[0].start == 0 and pieces[-1].end == len(text)
    for p in pieces:
        n = count(text[p.start : p.end])
        assert n == p.tokens and (n <= limit or p.end - p.start == 1)
    for p, q in zip(pieces, pieces[1:]):
        assert p.start < q.start <= p.end < q.end
        assert q.overlap == count(text[q.start : p.end])
    assert "".join([text[pieces[0].start : pieces[0].end], *[text[p.end : q.end] for p, q in zip(pieces, pieces[1:])]]) == text
    return pieces


@pytest.mark.parametrize("limit,overlap", [(1, 0), (2, 1), (8, 3), (40, 0), (40, 8), (100, 16), (10**6, 5)])
def test_pieces_cover_within_the_limit(splitter, limit, overlap):
    rnd = random.Random(limit)
    for _ in range(60):
        check(splitter, "".join(rnd.choice(PARTS) for _ in range(rnd.randrange(1, 40))), limit, overlap)


def test_very_long_and_unbroken(splitter):
    for text in ("a" * 20_000, "中" * 5_000, " " * 5_000, "word " * 20_000, "👍🏽" * 700):
        pieces = check(splitter, text, 200, 20)
        assert len(pieces) > 3 or splitter.counter.text(text) < 600


def test_overlap_is_near_the_asked(splitter):
    text = "公司前三季度实现收入25.1亿元，同比增长3%。" * 200 + "The name fell today and closed lower. " * 200
    pieces = check(splitter, text, 120, 24)
    assert all(22 <= p.overlap <= 33 for p in pieces[1:])


@pytest.mark.parametrize("text", ["=" * 40_000, "word " * 300 + "=" * 30_000 + " word" * 300, ("-" * 4_000 + "\n") * 30])
@pytest.mark.parametrize("limit,overlap", [(128, 32), (512, 64)])
def test_runs_of_long_tokens(splitter, text, limit, overlap):
    pieces = check(splitter, text, limit, overlap)
    assert all(overlap - 1 <= p.overlap <= overlap + 8 for p in pieces[1:])
    assert text.strip("=") or all(p.tokens > limit - 8 for p in pieces[:-1])


def test_cuts_where_the_text_breaks(splitter):
    sentence = "Revenue rose in the quarter and margins held up well. "
    text = "\n\n".join(sentence * 6 for _ in range(8))
    for p in check(splitter, text, 90, 0)[:-1]:
        assert text[: p.end].rstrip(" \n").endswith(".")
    whole = "\n\n".join(sentence * 3 for _ in range(8))
    assert all(whole[: p.end].endswith("\n\n") for p in check(splitter, whole, 40, 0)[:-1])


def test_limit_must_be_positive(splitter):
    for limit, overlap in ((0, 0), (-3, 0), (5, 5), (5, 9), (5, -1)):
        with pytest.raises(ValueError):
            splitter.split("a b", limit, overlap)


@pytest.mark.parametrize("limit,overlap", [(50, 40), (50, 49), (128, 100), (8, 7), (2, 1)])
def test_any_overlap_under_the_limit(splitter, limit, overlap):
    """Up to limit - 1; pieces still cover the text, keep within the limit and get on."""
    text = "The name fell today and closed lower than before. " * 60
    pieces = check(splitter, text, limit, overlap)
    assert sum(overlap - 2 <= p.overlap <= overlap + 8 for p in pieces[1:]) >= 0.9 * (len(pieces) - 1)
    rnd = random.Random(overlap)
    for _ in range(20):
        check(splitter, "".join(rnd.choice(PARTS) for _ in range(rnd.randrange(1, 40))), limit, overlap)


def test_packing_is_greedy_in_long_runs(splitter):
    for overlap in (0, 10):
        pieces = check(splitter, "=" * 20_000, 50, overlap)
        assert all(p.tokens >= 49 for p in pieces[:-1])


def test_frame(spark):
    rows = [(1, None, 10, 2), (2, "", 10, 2), (3, "one two", None, None), (4, "one two three four five six", 2, None), (4, "one two three four five six", 2, None), (5, "a b c", 1, 0)]
    df = spark.createDataFrame(rows, "doc_id int, text string, max_tokens int, overlap_tokens int").selectExpr("*", "7 AS piece", "8 AS __split_t")
    out = split_texts(df, "text", "max_tokens", "overlap_tokens")
    assert out.columns == ["doc_id", "piece_in", "__split_t", "piece", "pieces", "start", "end", "n_tokens", "shared", "piece_text"]
    got = sorted((r["doc_id"], r["piece"], r["pieces"], r["n_tokens"], r["piece_text"]) for r in out.where("doc_id in (2,3,4)").collect())
    four = [(4, 1, 3, 2, "one two"), (4, 2, 3, 2, " three four"), (4, 3, 3, 2, " five six")]
    assert got == sorted([(2, 1, 1, 0, ""), (3, 1, 1, 2, "one two"), *four, *four])
    assert [r["piece_text"] for r in out.where("doc_id = 1").collect()] == [None] and out.where("doc_id = 5").count() == 3
    assert split_texts(df.limit(0), "text", "max_tokens", "overlap_tokens").collect() == []
