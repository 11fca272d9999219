"""Texts over a size limit cut into overlapping pieces at natural boundaries."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.names import col, keep_clear, prefix
from tapeloom.llm.tokens import Counter, counter_of, rank_text

#: Separators from the coarsest to the finest: a text may be cut where a match ends. Words come from the tokenizer's own pattern.
SECTION = re.compile(r"\n(?=[ \t　]*(?:#{1,6} |[一二三四五六七八九十百]+[、.．]|第[一二三四五六七八九十百0-9]+[章节条部分]|[（(][一二三四五六七八九十]+[)）]|(?:Item|Section|Part|Chapter|SECTION|PART) |[0-9]+(?:\.[0-9]+)*[.)、] ))|\n(?:[ \t　]*\n){2,}")
PARAGRAPH = re.compile(r"\n[ \t　]*\n\s*")
LINE = re.compile(r"\n")
SENTENCE = re.compile(r"[。！？；…]+[”’」』）)]*|[.!?;]+[\"'”’)]*(?=\s)")
HIERARCHY = (SECTION, PARAGRAPH, LINE, SENTENCE)


@dataclass(frozen=True)
class Piece:
    start: int
    end: int
    tokens: int
    overlap: int


class Splitter:
    """Cuts texts; positions are in characters."""

    def __init__(self, counter: Counter):
        self.counter = counter

    def split(self, text: str, limit: int, overlap: int) -> list[Piece]:
        """Pieces of at most ``limit`` tokens that cover the text; each but the first begins with about ``overlap`` tokens of the one
        before.

        The text is cut recursively: a span over the limit is cut at its sections, a section over the limit at its paragraphs, then
        lines, sentences, words and at last characters. The spans so got are packed greedily. The next piece begins so far before the
        last one's end that it shares ``overlap`` tokens with it, or the fewest above that for which there is a boundary of a word or,
        in a word of many tokens, of a character. Any overlap under the limit is honoured as far as pieces still get on: a piece begins
        after the start of the one before and ends after its end, so where the words at a border leave no room for that, it shares fewer.
        A limit under 1, an overlap under 0 and one not under the limit raise ValueError. A single character of more tokens than the
        limit makes a piece of its own.
        """
        if limit < 1:
            raise ValueError("limit must be at least 1")
        if not 0 <= overlap < limit:
            raise ValueError("overlap must be at least 0 and under the limit")
        words = self.counter.find.findall(text)
        counts = self.counter.counts(words)
        total = int(counts.sum())
        if total <= limit:
            return [Piece(0, len(text), total, 0)]
        starts = np.r_[0, np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))]
        tokens = np.r_[0, np.cumsum(counts)]
        atoms = self._atoms(text, starts, tokens, max(1, limit - overlap - (overlap > 0) * min(8, max(0, limit - overlap - 1))))
        return self._pack(text, starts, tokens, atoms, limit, overlap)

    def _atoms(self, text: str, starts: np.ndarray, tokens: np.ndarray, room: int) -> list[tuple[int, int]]:
        """The spans, as ranges of words, that the recursion ends with; only single words may be over ``room``."""
        levels: list[np.ndarray | None] = [None] * len(HIERARCHY)

        def cuts(level: int) -> np.ndarray:
            if levels[level] is None:
                at = np.fromiter((m.end() for m in HIERARCHY[level].finditer(text)), np.int64)
                word = np.searchsorted(starts, at)  # a match that ends inside a word cuts after it
                levels[level] = np.unique(word[(word > 0) & (word < len(starts) - 1)])
            return levels[level]  # type: ignore[return-value]

        out: list[tuple[int, int]] = []
        stack = [(0, len(starts) - 1, 0)]
        while stack:
            lo, hi, level = stack.pop()
            if tokens[hi] - tokens[lo] <= room or hi - lo == 1:
                out.append((lo, hi))
            elif level == len(HIERARCHY):
                a = lo
                while a < hi:  # words, packed
                    b = max(a + 1, int(np.searchsorted(tokens, tokens[a] + room, side="right")) - 1)
                    out.append((a, min(b, hi)))
                    a = min(b, hi)
            else:
                at = cuts(level)
                inside = at[np.searchsorted(at, lo, side="right") : np.searchsorted(at, hi, side="left")]
                edges = [lo, *inside.tolist(), hi]
                stack.extend((a, b, level + 1) for a, b in reversed(list(zip(edges, edges[1:]))))
        return out

    def _pack(self, text: str, starts: np.ndarray, tokens: np.ndarray, atoms: list[tuple[int, int]], limit: int, overlap: int) -> list[Piece]:
        out: list[Piece] = []
        begin, fresh, shared = 0, 0, 0  # where the piece begins, where its own part begins, tokens it shares (characters, tokens)
        held = 0  # tokens from begin to fresh and on to the last atom taken
        end = 0
        count = self.counter.text

        def close() -> None:
            nonlocal begin, shared, held, fresh
            out.append(Piece(begin, end, self._alone(text, starts, tokens, begin, end, held), shared))
            begin = self._back(text, starts, tokens, begin, end, overlap) if overlap else end
            held, fresh = self._inside(text, starts, tokens, begin, end), end
            shared = self._alone(text, starts, tokens, begin, end, held)

        for lo, hi in atoms:
            n = int(tokens[hi] - tokens[lo])
            if held + n > limit and end > fresh:
                close()
            if held + n <= limit:
                held, end = held + n, int(starts[hi])
                continue
            # a single word too long for what is left: by characters
            a, b = int(starts[lo]), int(starts[hi])
            while a < b:
                c = self._fit(text, begin, a, b, limit)
                if c == a and end > fresh:
                    close()
                    continue
                if c == a:  # nothing fits beside the overlap
                    begin, shared = a, 0
                    c = max(self._fit(text, begin, a, b, limit), a + 1)
                end, a = c, c
                held = count(text[begin:end])
                if a < b:
                    close()
        if end > fresh or not out:
            out.append(Piece(begin, end, self._alone(text, starts, tokens, begin, end, held), shared))
        return out

    def _alone(self, text: str, starts: np.ndarray, tokens: np.ndarray, begin: int, end: int, held: int) -> int:
        """Tokens of begin..end as a text of its own, ``held`` being those it has inside the whole text: only blanks at the end may be cut
        into other words there."""
        if not text[end - 1 : end].isspace() or begin == end:
            return held
        blanks = begin + len(text[begin:end].rstrip())
        a, b = int(np.searchsorted(starts, blanks)), int(np.searchsorted(starts, end))
        if starts[a] != blanks or starts[b] != end:
            return self.counter.text(text[begin:end])
        return held - int(tokens[b] - tokens[a]) + self.counter.text(text[blanks:end])

    def _inside(self, text: str, starts: np.ndarray, tokens: np.ndarray, begin: int, end: int) -> int:
        """Tokens from begin to end where more text follows; blanks before it may be cut into words otherwise than at a text's end."""
        a, b = int(np.searchsorted(starts, begin)), int(np.searchsorted(starts, end))
        if starts[b] != end or a > b:
            return self.counter.text(text[begin:end])
        return int(tokens[b] - tokens[a]) + self.counter.text(text[begin : int(starts[a])])

    def _fit(self, text: str, begin: int, a: int, b: int, limit: int) -> int:
        """The greatest c from a to b for which begin..c is within the limit; counts are exact, so a near miss is stepped back from."""
        reach = 8 * limit + 8
        while begin + reach < b and self.counter.text(text[begin : begin + reach]) <= limit:
            reach *= 2  # tokens of many characters, as of a ruled line
        lo, hi = a, min(b, begin + reach)
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if self.counter.text(text[begin:mid]) <= limit:
                lo = mid
            else:
                hi = mid - 1
        return lo

    def _back(self, text: str, starts: np.ndarray, tokens: np.ndarray, begin: int, end: int, overlap: int) -> int:
        """Where the piece after one from ``begin`` to ``end`` begins."""
        w = int(np.searchsorted(starts, end))
        if starts[w] != end:  # the piece ended inside a word
            return self._back_in(text, max(begin + 1, int(starts[w - 1])), end, overlap)
        a = int(np.searchsorted(tokens, tokens[w] - overlap, side="right")) - 1  # the last word from which there are enough
        first = int(np.searchsorted(starts, begin, side="right"))
        need = overlap - int(tokens[w] - tokens[first])
        if a < first and need > 0 and tokens[first] - tokens[first - 1] > 8:  # the long word that the piece itself begins in
            return self._back_in(text, begin + 1, int(starts[first]), need)
        a = max(a, first)
        at = int(starts[min(a, w)])
        over = int(tokens[w] - tokens[a]) - overlap
        if over > 0 and tokens[a + 1] - tokens[a] > 8:  # a long word: begin inside it
            inner = text[at : int(starts[a + 1])]
            need = overlap - int(tokens[w] - tokens[a + 1])
            return at + self._tail(inner, need)
        return at if over <= 8 else int(starts[a + 1])

    def _back_in(self, text: str, a: int, end: int, overlap: int) -> int:
        return a + self._tail(text[a:end], overlap)

    def _tail(self, word: str, need: int) -> int:
        """The greatest position in a word from which it still has ``need`` tokens; 0 if it has fewer."""
        if need <= 0:
            return len(word)
        reach = 8 * need + 8
        while reach < len(word) and self.counter.text(word[-reach:]) < need:
            reach *= 2
        lo, hi = max(0, len(word) - reach), len(word)
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if self.counter.text(word[mid:]) >= need:
                lo = mid
            else:
                hi = mid - 1
        return lo


def source_key(c):
    """A source's name without differences of case, outer blanks and ``-`` for ``_``."""
    return F.replace(F.lower(F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")), F.lit("-"), F.lit("_"))


def split_texts(df: DataFrame, text: str, limit: str, overlap: str, ranks: str | None = None) -> DataFrame:
    """One row for each piece: the columns of ``df`` but ``text``, ``limit`` and ``overlap``, with piece (from 1), pieces, start and end (in
    characters), n_tokens, shared (tokens in common with the piece before) and piece_text.

    A row with a null ``limit`` has no limit, and null overlap means none. A text within its limit is one piece; so are empty texts, with
    0 tokens, and null texts, whose piece is null. Limits and overlaps that :meth:`Splitter.split` refuses raise ValueError. Repeated rows
    are split each; empty input gives no rows.
    Columns of ``df`` called as the new ones come out with the suffix ``_in``.
    """
    added = ["piece", "pieces", "start", "end", "n_tokens", "shared", "piece_text"]
    own = prefix("__split", df.columns)
    kept = df.select(*[col(c) for c in df.columns if c not in (text, limit, overlap)])
    given = df.select(*[col(c) for c in kept.columns], col(text).cast("string").alias(f"{own}_t"), col(limit).cast("long").alias(f"{own}_l"), col(overlap).cast("long").alias(f"{own}_o"))
    kept = keep_clear(kept, added)
    rest, schema = kept.columns, kept.schema
    shared_ranks = df.sparkSession.sparkContext.broadcast(rank_text(ranks))  # one file of a few MB
    for name in added[:-1]:
        schema = schema.add(name, "long")
    schema = schema.add("piece_text", "string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(counter_of(shared_ranks.value))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield _pieces(batch.slice(at, 256), splitter, rest, added)

    return given.mapInArrow(work, schema)


def _pieces(batch: pa.RecordBatch, splitter: Splitter, rest: list[str], added: list[str]) -> pa.RecordBatch:
    texts, limits, overlaps = (batch.column(len(rest) + i).to_pylist() for i in range(3))
    row: list[int] = []
    columns: list[list] = [[] for _ in added]
    for i, (text, limit, overlap) in enumerate(zip(texts, limits, overlaps)):
        if not text:
            got = [Piece(0, 0, 0, 0)]
        elif limit is None:
            got = [Piece(0, len(text), splitter.counter.text(text), 0)]
        else:
            got = splitter.split(text, limit, overlap or 0)
        for number, p in enumerate(got, 1):
            row.append(i)
            for column, value in zip(columns, (number, len(got), p.start, p.end, p.tokens, p.overlap, None if text is None else text[p.start : p.end])):
                column.append(value)
    index = pa.array(row, pa.int64())
    kept = [batch.column(i).take(index) for i in range(len(rest))]
    made = [pa.array(c, pa.int64()) for c in columns[:-1]] + [pa.array(columns[-1], pa.string())]
    return pa.RecordBatch.from_arrays([*kept, *made], [*rest, *added])
