"""Encoding of texts by a public byte-level BPE tokenizer, its merges carried out by recursive DuckDB queries."""

from __future__ import annotations

import itertools
import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tapeloom.functions.names import col, keep_clear, prefix

#: Where the vocabulary files of public tokenizers are, unless the environment or a parameter says otherwise. Only the driver reads them.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
DEFAULT_VOCABULARY = "byte_bpe_50k.json"

# Fixed value: the pattern by which byte-level BPE of this family cuts text into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Characters of text worked on at once, bytes of new words in one query, rounds of one query, words of one text taken at once, and words
#: remembered by a worker; they bound memory and change no result.
SLICE_CHARS, QUERY_BYTES, QUERY_ROUNDS, LIST_WORDS, REMEMBERED = 1 << 20, 1 << 17, 32, 1 << 18, 1 << 19


class WordFinder:
    """Cuts texts by WORD_PATTERN. Texts of the basic plane, nearly all, go through a pattern of the ``re`` module whose classes are spelled
    out from the ``regex`` module's own properties, which takes less than half the time; texts with characters beyond it through ``regex``."""

    def __init__(self):
        import regex

        self._any = regex.compile(WORD_PATTERN)
        plane = "".join(map(chr, range(0x10000)))

        def spelled(kind: str) -> str:
            spans = [(m.start(), m.end() - 1) for m in regex.finditer(f"(?:{kind})+", plane)]
            return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in spans)

        letter, number, blank = (spelled(k) for k in (r"\p{L}", r"\p{N}", r"\s"))
        self._plane = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{blank}{letter}{number}]+|[{blank}]+(?![^{blank}])|[{blank}]+")
        self._beyond = re.compile("[\U00010000-\U0010ffff]")

    def _pattern(self, text: str):
        return self._any if self._beyond.search(text) else self._plane

    def findall(self, text: str) -> list[str]:
        return self._pattern(text).findall(text)

    def finditer(self, text: str):
        return self._pattern(text).finditer(text)


def vocabulary_text(vocabulary: str | None = None) -> bytes:
    """The bytes of a vocabulary file in the format of the tokenizers library; a name is looked up in ``TOKENIZERS``."""
    name = vocabulary or DEFAULT_VOCABULARY
    with open(name if os.path.isabs(name) else os.path.join(TOKENIZERS, name), "rb") as file:
        return file.read()


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files: printable Latin-1 characters stand for themselves, the others, in order,
    for the characters from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """The merge table of a vocabulary file, in a DuckDB connection of its own."""

    def __init__(self, text: bytes):
        import duckdb

        model = json.loads(text)["model"]
        vocab, letters = model["vocab"], byte_letters()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.bytes_to_id = np.zeros(256, np.int32)
        for letter, byte in letters.items():
            self.bytes_to_id[byte] = vocab[letter]
        table = pa.table({k: pa.array(v, pa.int32()) for k, v in {
            "l": [vocab[a] for a, _ in pairs], "r": [vocab[b] for _, b in pairs], "rank": range(len(pairs)), "joined": [vocab[a + b] for a, b in pairs]}.items()})
        # Merging all places of a word's best pair at once is the same as one after the other from the left only if no merge makes a
        # better one possible: a part must always have been made by an earlier merge than the pair it is in.
        made = {a + b: i for i, (a, b) in enumerate(pairs)}
        assert all(made.get(a, -1) < i and made.get(b, -1) < i for i, (a, b) in enumerate(pairs)), "merges out of order"
        # bytes that stand side by side inside some token; between any others no merge can ever reach across
        self.joinable = np.zeros((256, 256), bool)
        for token in made:
            raw = [letters[c] for c in token]
            self.joinable[raw[:-1], raw[1:]] = True
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self.db.register("given", table)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.db.unregister("given")

    # A run of hits side by side is one pair of equal tokens again and again: every other one of them is taken, counted from the run's
    # first. stop is the place of the last token before this one that begins no hit, so the place in the run is no - stop.
    ROUNDS_SQL = f"""
        WITH RECURSIVE state(w, i, t, k) AS (
          SELECT w, i, t, 0 FROM start
          UNION ALL
          SELECT w, i, CASE WHEN hit AND (no - stop) % 2 = 1 THEN joined ELSE t END, k + 1 FROM (
            SELECT *, coalesce(max(CASE WHEN NOT hit THEN no END) OVER (PARTITION BY w ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stop FROM (
              SELECT w, i, t, k, no, joined, coalesce(rank = best, false) AS hit FROM (
                SELECT p.*, m.rank, m.joined, min(m.rank) OVER (PARTITION BY p.w) AS best FROM (
                  SELECT *, lead(t) OVER (PARTITION BY w ORDER BY i) AS after, row_number() OVER (PARTITION BY w ORDER BY i) AS no
                  FROM state WHERE k < {QUERY_ROUNDS}
                ) p LEFT JOIN merges m ON m.l = p.t AND m.r = p.after
              ) WHERE best IS NOT NULL
            )
          ) WHERE (no - 1 - stop) % 2 = 0)
        SELECT w, i, t, k FROM state"""

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word.

        Words are first cut where no token of the vocabulary can reach across; the distinct parts, one row for each byte, go through a
        recursive query in which every round merges the pair of least rank of each part, from the left, until none is left. A query
        makes at most QUERY_ROUNDS rounds, parts that are not done start another one, so that its rounds fit into memory.
        """
        cut = [self._parts(w) for w in words]
        known: dict[bytes, list[int]] = {}
        todo = list(dict.fromkeys(p for parts in cut for p in parts))
        for part in (p for p in todo if len(p) == 1):
            known[part] = [int(self.bytes_to_id[part[0]])]
        batch: list[bytes] = []
        size = 0
        for part in itertools.chain((p for p in todo if len(p) > 1), [None]):
            if part is None or (batch and size + len(part) > QUERY_BYTES):
                known |= zip(batch, self._merge(batch))
                batch, size = [], 0
            if part is not None:
                batch.append(part)
                size += len(part)
        return [known[parts[0]] if len(parts) == 1 else [t for p in parts for t in known[p]] for parts in cut]

    def _parts(self, word: bytes) -> list[bytes]:
        if len(word) < 3:
            return [word]
        raw = np.frombuffer(word, np.uint8)
        at = np.flatnonzero(~self.joinable[raw[:-1], raw[1:]]) + 1
        if not len(at):
            return [word]
        edges = [0, *at.tolist(), len(word)]
        return [word[a:b] for a, b in zip(edges, edges[1:])]

    def _merge(self, parts: list[bytes]) -> list[list[int]]:
        if not parts:
            return []
        lengths = np.array([len(p) for p in parts])
        w = np.repeat(np.arange(len(parts)), lengths)
        i = np.arange(len(w)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        t = self.bytes_to_id[np.frombuffer(b"".join(parts), np.uint8)]
        done: list[list[int] | None] = [None] * len(parts)
        while len(w):
            self.db.register("given", pa.table({"w": w.astype(np.int32), "i": i.astype(np.int32), "t": t.astype(np.int32)}))
            self.db.execute("CREATE OR REPLACE TEMP TABLE start AS SELECT * FROM given")
            self.db.unregister("given")
            self.db.execute(f"CREATE OR REPLACE TEMP TABLE rounds AS {self.ROUNDS_SQL}")
            last = "rounds JOIN (SELECT w, max(k) AS k FROM rounds GROUP BY w) USING (w, k)"
            for no, ids in self.db.execute(f"SELECT w, list(t ORDER BY i) FROM {last} WHERE k < {QUERY_ROUNDS} GROUP BY w").fetchall():
                done[no] = ids
            left = self.db.execute(f"SELECT w, i, t FROM rounds WHERE k = {QUERY_ROUNDS} ORDER BY w, i").fetchnumpy()
            w, i, t = left["w"], left["i"], left["t"]
        return done  # type: ignore[return-value]


@lru_cache(maxsize=2)
def _merges(text: bytes) -> Merges:
    return Merges(text)


class Encoder:
    """Encodes texts, remembering the ids of words: all ids lie in one array, and a word knows where its own are."""

    def __init__(self, text: bytes):
        self.find = WordFinder()
        self.merges = _merges(text)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.begins, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, words: Iterable[str]) -> None:
        """Look up the ids of all words that are not remembered."""
        new = sorted(set(words) - self.known.keys())
        if new:
            got = self.merges.encode([w.encode("utf-8") for w in new])
            sizes = np.fromiter(map(len, got), np.int64, len(got))
            self.known |= zip(new, range(len(self.known), len(self.known) + len(new)))
            self.begins = np.r_[self.begins, len(self.ids) + np.cumsum(sizes) - sizes]
            self.sizes = np.r_[self.sizes, sizes]
            self.ids = np.r_[self.ids, np.fromiter(itertools.chain.from_iterable(got), np.int32, int(sizes.sum()))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the number of ids of each. The texts should be a slice of bounded size; of one
        that is longer, LIST_WORDS words are taken at once."""
        if len(self.known) > REMEMBERED:
            self._forget()
        parts: list[np.ndarray] = []
        lengths = np.zeros(len(texts), np.int64)
        short = [i for i, t in enumerate(texts) if len(t) <= LIST_WORDS]
        found = {i: self.find.findall(texts[i]) for i in short}
        for at, run in itertools.groupby(range(len(texts)), key=lambda i: i in found):
            numbers = list(run)
            if at:
                flat, sizes = self._ids([w for i in numbers for w in found[i]])
                ends = np.cumsum([len(found[i]) for i in numbers])
                total = np.r_[0, np.cumsum(sizes)]
                lengths[numbers] = np.diff(np.r_[0, total[ends]])
                parts.append(flat)
                continue
            for i in numbers:
                words = self.find.finditer(texts[i])
                while some := [m.group() for m in itertools.islice(words, LIST_WORDS)]:
                    flat, sizes = self._ids(some)
                    lengths[i] += len(flat)
                    parts.append(flat)
        return (parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.int32), *parts])), lengths

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, end to end, and the number of ids of each word."""
        self.learn(words)
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(self.begins[at] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)], sizes


@lru_cache(maxsize=2)
def _encoder(text: bytes) -> Encoder:
    """One encoder for all tasks of a worker, so that what one has learnt serves the next."""
    return Encoder(text)


def _slices(texts: list[str | None]) -> Iterator[list[str]]:
    some: list[str] = []
    size = 0
    for text in texts:
        some.append(text or "")
        size += len(some[-1])
        if size >= SLICE_CHARS:
            yield some
            some, size = [], 0
    if some:
        yield some


def encode(df: DataFrame, text: str, ids: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``df`` without ``text`` and with ``ids``, the token ids of each text by a byte-level BPE vocabulary, without special tokens.

    Texts are cut into words by the tokenizer's pattern; a task keeps the ids of the words it has met and finds those of new ones by
    recursive DuckDB queries over the merge table, so a query sees each distinct word once. Whole texts are encoded, whatever their
    length, in slices of bounded memory; strings that look like special tokens are plain text.

    Null and empty texts give an empty list. Repeated rows stay repeated, empty input gives no rows. Other columns are carried along; one
    that is called as ``ids`` comes out with the suffix ``_in``.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary_text(vocabulary))  # one file of a few MB
    given = df.select(*[col(c) for c in df.columns if c != text], col(text).cast("string").alias(prefix("__text", df.columns)))
    rest = keep_clear(given.drop(given.columns[-1]), [ids]).columns
    schema = keep_clear(given.drop(given.columns[-1]), [ids]).schema.add(ids, T.ArrayType(T.IntegerType()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            at, last = 0, len(rest)
            for some in _slices(batch.column(last).to_pylist()):
                flat, lengths = encoder.encode(some)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32)), pa.array(flat))
                part = batch.slice(at, len(some))
                yield pa.RecordBatch.from_arrays([*part.columns[:last], lists], [*rest, ids])
                at += len(some)

    return given.mapInArrow(work, schema)
