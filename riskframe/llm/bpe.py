"""Byte-level BPE by recursive SQL queries over each partition's words.

A task keeps an in-memory DuckDB database with the vocabulary, the merge table (every split of a
token in two tokens) and the words it has met. New words become rows (word, position, token) and
one recursive query joins neighbours to the merge table and contracts each word's leftmost pair of
minimum rank, until no word has a pair. Texts become rows (document, position, word); ordered
aggregation joins their ids and, from the ids' bytes, the decoded text.

Nothing is shuffled. What a worker remembers is bounded, as is the text it handles at once. A lost
executor costs the words remembered and nothing else. The work on one match of the pattern grows
with the square of its length, as each step contracts one pair of it.
"""

from __future__ import annotations

import base64
import re
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.packing import text_groups

WORDS_KEPT = 800_000      # words a worker remembers
GROUP_CHARS = 4_000_000   # text handled at once, unless one document is longer
MEMORY = "600MB"

# The public pattern spelled out for texts below U+0250, where the standard matcher knows all of
# its classes; it gives the same matches in half the time.
_LETTER, _NUMBER, _SPACE = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
_OTHER = f"[^{_SPACE}{_LETTER}{_NUMBER}]"
LATIN = (f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?{_OTHER}+"
         f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
PUBLIC = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

CONTRACT = """
WITH RECURSIVE steps(word, pos, id, after, live) AS (
  SELECT word, pos, id, lead(id) OVER (PARTITION BY word ORDER BY pos), true FROM start
  UNION ALL
  SELECT * FROM (
    WITH pairs AS (
      SELECT s.word, s.pos, s.id, m.id AS made
      FROM (SELECT word, pos, id, after FROM steps WHERE live) s
      LEFT JOIN merges m ON m.pair = s.id::BIGINT * 4294967296 + s.after),
    best AS (
      SELECT word, min(made::BIGINT * 4294967296 + pos) AS chosen FROM pairs GROUP BY word)
    SELECT word, pos, id, lead(id) OVER (PARTITION BY word ORDER BY pos), live
    FROM (
      SELECT p.word, p.pos, b.chosen IS NOT NULL AS live,
        CASE WHEN p.pos = b.chosen & 4294967295 THEN p.made ELSE p.id END AS id,
        lag(p.pos) OVER (PARTITION BY p.word ORDER BY p.pos) = b.chosen & 4294967295 AS gone
      FROM pairs p JOIN best b USING (word))
    WHERE gone IS NOT TRUE))
SELECT word, pos, id FROM steps WHERE NOT live
"""

LEARN = """
INSERT INTO words
SELECT t.word, count(*)::INT, string_agg(t.id::VARCHAR, ' ' ORDER BY t.pos),
       decode(unhex(string_agg(v.hex, '' ORDER BY t.pos)))
FROM contracted t JOIN vocab v USING (id) GROUP BY t.word
"""

WRITE = """
SELECT d.doc, coalesce(x.n, 0)::BIGINT AS n_tokens,
       coalesce(array_to_string(list_transform(x.parts, lambda p: p.ids), ' '), '') AS ids,
       coalesce(array_to_string(list_transform(x.parts, lambda p: p.text), ''), '') AS decoded
FROM docs d LEFT JOIN (
  SELECT doc, sum(n) AS n, list({'ids': w.ids, 'text': w.text} ORDER BY r.pos) AS parts
  FROM uses r JOIN words w USING (word) GROUP BY doc) x USING (doc)
ORDER BY d.doc
"""


class Encoder:
    """The database of a worker, and the numbers of the words it holds."""

    loaded: dict[tuple[str, str], Encoder] = {}

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        warnings.filterwarnings("ignore", category=UserWarning, module=__name__)
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        pairs = [(ranks[token[:k]], ranks[token[k:]], rank) for token, rank in ranks.items()
                 for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks]
        left, right, made = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.find = regex.compile(pattern).findall
        self.find_latin = re.compile(LATIN).findall if pattern == PUBLIC else None
        self.is_latin = re.compile("[^\0-ɏ]").search
        self.db = duckdb.connect()
        self.db.execute(f"SET threads = 1; SET memory_limit = '{MEMORY}'; SET temp_directory = ''")
        self.fill("merges", {"pair": left * 2**32 + right, "id": made.astype(np.int32)})
        self.fill("vocab", {"id": np.array(list(ranks.values()), np.int32),
                            "hex": pa.array([token.hex() for token in ranks])})
        self.forget()

    @classmethod
    def of(cls, path: str, pattern: str) -> Encoder:
        if (path, pattern) not in cls.loaded:
            cls.loaded[path, pattern] = cls(path, pattern)
        return cls.loaded[path, pattern]

    def fill(self, name: str, columns: dict) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.db.execute("CREATE OR REPLACE TEMP TABLE words (word INT, n INT, ids VARCHAR, text VARCHAR)")

    def matches(self, text: str) -> list[str]:
        if self.find_latin and not self.is_latin(text):
            return self.find_latin(text)
        return self.find(text)

    def learn(self, new: list[str]) -> None:
        """Contract the bytes of new words and remember their tokens."""
        if len(self.numbers) + len(new) > WORDS_KEPT and self.numbers:
            raise OverflowError
        first = len(self.numbers)
        self.numbers.update(zip(new, range(first, first + len(new)), strict=True))
        data = [word.encode() for word in new]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        starts = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(data), np.uint8)
        self.fill("start", {
            "word": (first + np.repeat(np.arange(len(new)), sizes)).astype(np.int32),
            "pos": np.arange(len(flat)) - np.repeat(starts, sizes), "id": self.byte_ids[flat]})
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE contracted AS {CONTRACT}")
        self.db.execute(LEARN)

    def run(self, texts: list[str]) -> pa.Table:
        """doc (place in `texts`), n_tokens, ids, decoded."""
        found = [self.matches(text) for text in texts]
        distinct = set().union(*found)
        try:
            new = sorted(distinct.difference(self.numbers))
            if new:
                self.learn(new)
        except OverflowError:
            self.forget()
            self.learn(sorted(distinct))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        number = self.numbers.__getitem__
        self.fill("uses", {
            "doc": np.repeat(np.arange(len(found)), sizes).astype(np.int32),
            "pos": np.arange(sizes.sum()),
            "word": np.fromiter((n for words in found for n in map(number, words)), np.int32,
                                int(sizes.sum()))})
        self.fill("docs", {"doc": np.arange(len(found), dtype=np.int32)})
        return self.db.sql(WRITE).to_arrow_table()


def encode_and_decode(docs: DataFrame, ranks: str, pattern: str = PUBLIC, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, ids (decimal, joined by one space), decoded.

    `ranks` is the path of a rank file, read where the task runs. No special tokens. A null or
    empty text has no ids and decodes to the empty text. Rows that repeat an id are encoded each by
    itself. Extra columns are ignored. An empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(ranks, pattern)
        for batch in batches:
            at = 0
            for group in text_groups(batch.column(1), GROUP_CHARS):
                out = encoder.run(group).combine_chunks()
                ids = batch.column(0).slice(at, len(group))
                at += len(group)
                yield pa.RecordBatch.from_arrays(
                    [ids, *(out.column(c).combine_chunks().cast(kind) for c, kind in (
                        ("n_tokens", pa.int64()), ("ids", pa.string()), ("decoded", pa.string())))],
                    [id_col, "n_tokens", "ids", "decoded"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids string, decoded string")


def id_array(ids: Column) -> Column:
    """The ids of `encode_and_decode` as numbers."""
    return F.when(ids == "", F.array().cast("array<int>")).otherwise(
        F.split(ids, " ").cast("array<int>"))
