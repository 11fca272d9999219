"""Token counts by a public tokenizer, word by word."""

from __future__ import annotations

import base64
import itertools
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tapeloom.functions.names import col, keep_clear, prefix
from tapeloom.llm.encode import LIST_WORDS, REMEMBERED, TOKENIZERS, WORD_PATTERN, WordFinder

DEFAULT_RANKS = "byte_bpe_50k.tiktoken"


def rank_text(ranks: str | None = None) -> bytes:
    """The bytes of a rank file; a name is looked up in ``TOKENIZERS``."""
    name = ranks or DEFAULT_RANKS
    with open(name if os.path.isabs(name) else os.path.join(TOKENIZERS, name), "rb") as file:
        return file.read()


class Counter:
    """Counts the tokens of words and texts; the pattern cuts a text into words, and no token reaches across two of them."""

    def __init__(self, text: bytes):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in text.splitlines() if line)}
        self.find = WordFinder()
        self._encode = tiktoken.Encoding("own", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[str, int] = {}

    def word(self, word: str) -> int:
        n = self.known.get(word)
        if n is None:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            n = self.known[word] = len(self._encode(word))
        return n

    def counts(self, words: list[str]) -> np.ndarray:
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        except KeyError:
            return np.fromiter(map(self.word, words), np.int64, len(words))

    def text(self, text: str | None) -> int:
        """Tokens of a text; of null, none."""
        if not text:
            return 0
        if len(text) <= LIST_WORDS:
            return int(self.counts(self.find.findall(text)).sum())
        found, total = self.find.finditer(text), 0
        while some := [m.group() for m in itertools.islice(found, LIST_WORDS)]:
            total += int(self.counts(some).sum())
        return total


@lru_cache(maxsize=2)
def counter_of(text: bytes) -> Counter:
    """One counter for all tasks of a worker."""
    return Counter(text)


def count_tokens(df: DataFrame, text: str, out: str = "n_tokens", ranks: str | None = None) -> DataFrame:
    """``df`` without ``text`` and with ``out``, the number of tokens of each text. Null and empty texts have none; another column called
    as ``out`` gets the suffix ``_in``."""
    shared = df.sparkSession.sparkContext.broadcast(rank_text(ranks))  # one file of a few MB
    given = df.select(*[col(c) for c in df.columns if c != text], col(text).cast("string").alias(prefix("__text", df.columns)))
    kept = keep_clear(given.drop(given.columns[-1]), [out])
    rest, schema = kept.columns, kept.schema.add(out, T.LongType())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(shared.value)
        for batch in batches:
            n = [counter.text(t.as_py()) for t in batch.column(len(rest))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64())], [*rest, out])

    return given.mapInArrow(work, schema)
