"""Packing of tokenised documents into sequences of fixed length.

1. *Tokens.* Each document is encoded in a task, word by word: the tokenizer drops white space and
   no token crosses it, so a word's ids are remembered. A word met for the first time is parted from
   the marks at its end; one of letters alone goes to the merges without the steps before them,
   which would only lower its case. Ids leave the task as one binary column.
2. *Histogram.* Pieces of equal length are interchangeable, so the plan is made from the number of
   pieces of each length: at most `SEQUENCE` numbers, however many documents there are.
3. *Reduction* after Martello and Toth: a bin whose contents provably dominate every other way to
   use its longest piece is fixed for all copies at once, and the instance shrinks.
4. *Best fit* of what remains, longest first, again for all copies at once. The plan is a list of
   bin patterns with a multiplicity; a pattern list is bounded by the number of lengths.
5. *Placement.* Pieces are sorted by length and id over all tasks; a piece's rank within its length
   names its pattern, copy and offset. No task holds a length or a bin as a whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import cut_lineage

SEQUENCE = 4096           # tokens a sequence holds
END_ID = 1                # closes each document
CACHE_BYTES = 100_000_000  # of words and their ids in each of the two halves of a worker's memory
ENTRY_BYTES = 200          # of an entry besides its word and ids
NEW_WORDS = 5_000          # words encoded at once
GROUP_CHARS = 1_000_000    # of texts encoded at once
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
LETTERS = {chr(code).encode() for code in range(0xC0, 0x100) if chr(code).isalpha()}   # À to ÿ
PLAIN = re.compile("[a-zÀ-ÖØ-öø-ÿ]+")   # one run of composed letters

Pattern = tuple[tuple[tuple[int, int], ...], int]   # ((length, how often), ...), copies


# ---- tokens ---------------------------------------------------------------------------------

class WordIds:
    """Ids of texts by way of their words, remembered between texts and tasks of a worker.

    A full memory becomes the old half, from which words that are met again are taken over.
    A text with the string of a special token in it is encoded whole, as the tokenizer does by
    default. `array` numbers are in the machine's order, which is little-endian wherever Spark runs Arrow.
    """

    loaded: dict[str, WordIds] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        # The same merges without normalizer and pattern. The suffix shows where a word ends.
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = self.tokenizer.model.end_of_word_suffix
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.closes[[n for token, n in self.merges.get_vocab().items() if token.endswith(suffix)]] = True
        self.ids: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.held = 0
        self.most = CACHE_BYTES

    @classmethod
    def of(cls, path: str, cache_bytes: int | None = None) -> WordIds:
        if path not in cls.loaded:
            cls.loaded[path] = cls(path)
        cls.loaded[path].most = cache_bytes or CACHE_BYTES
        return cls.loaded[path]

    def remind(self, words: set[bytes]) -> set[bytes]:
        """Take words over from the old half; those that are not in it."""
        new = words.difference(self.old)      # a set's intersection with a dict would walk all of the dict
        for word in words - new:
            self.ids[word] = self.old[word]
            self.held += ENTRY_BYTES + len(word) + len(self.ids[word])
        return new

    def learn(self, words: set[bytes]) -> None:
        """Remember the ids of new words."""
        # Marks after a letter or digit, up to the word's end, are tokens of their own.
        ends = {}
        for word in words:
            if word[-1] in MARKS:
                stem = word.rstrip(MARKS)
                if stem[-1:].isalnum() or stem[-2:] in LETTERS:
                    ends[word] = stem
        parts = words.difference(ends)
        parts.update(ends.values(), {word[len(stem):] for word, stem in ends.items()})
        plain, others = [], []
        for word in self.remind(parts.difference(self.ids)):
            text = word.decode()
            (plain if PLAIN.fullmatch(text) else others).append((word, text))
        for found, encode in ((plain, self.merged), (others, self.normalised)):
            for start in range(0, len(found), NEW_WORDS):
                part = found[start:start + NEW_WORDS]
                raw, cuts = encode([text for _, text in part])
                self.ids.update((word, raw[low:high]) for (word, _), low, high in zip(
                    part, cuts, cuts[1:], strict=False))
                self.held += ENTRY_BYTES * len(part) + sum(len(word) for word, _ in part) + len(raw)
        ids = self.ids
        for word, stem in ends.items():
            ids[word] = ids[stem] + ids[word[len(stem):]]
            self.held += ENTRY_BYTES + len(word) + len(ids[word])

    def merged(self, words: list[str]) -> tuple[bytes, list[int]]:
        """The ids of words of letters alone, and in which bytes each word's begin and end."""
        ids = np.array(self.merges.encode_batch_fast([" ".join(words).lower()], add_special_tokens=False)[0].ids, "<u4")
        after = np.flatnonzero(self.closes[ids]) + 1
        if len(after) != len(words):
            raise ValueError("the tokenizer does not close each word with its suffix")
        return ids.tobytes(), [0, *(4 * after).tolist()]

    def normalised(self, words: list[str]) -> tuple[bytes, list[int]]:
        """The same of any words, by all steps of the tokenizer."""
        # Lower-cased words may look like special tokens; they are not.
        self.tokenizer.encode_special_tokens = True
        found = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        owners = np.array(found.word_ids, np.int64)
        cuts = 4 * np.searchsorted(owners, np.arange(len(words) + 1))
        return array("I", found.ids).tobytes(), cuts.tolist()

    def whole(self, text: str) -> bytes:
        self.tokenizer.encode_special_tokens = False
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str] | list[bytes]) -> list[bytes]:
        """The ids of each text, given as such or in UTF-8, as little-endian unsigned 32-bit numbers."""
        raw = [text.encode() if isinstance(text, str) else text for text in texts]
        whole = {n: self.whole(text.decode()) for n, text in enumerate(raw) if any(s in text for s in self.special)}
        split = [[] if n in whole else text.lower().split() for n, text in enumerate(raw)]
        if self.held > self.most:
            self.old, self.ids, self.held = self.ids, {}, 0
        self.learn(self.remind(set().union(*split).difference(self.ids)))
        found = self.ids.__getitem__
        return [whole[n] if n in whole else b"".join(map(found, words)) for n, words in enumerate(split)]


def text_groups(column: pa.Array, chars: int = 500_000) -> Iterator[list]:
    """The texts of a column, or their bytes, in groups of bounded size, null as empty."""
    group, size, empty = [], 0, b"" if pa.types.is_binary(column.type) else ""
    for text in column:
        group.append(text.as_py() or empty)
        size += len(group[-1])
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 sequence: int = SEQUENCE, cache_bytes: int | None = None) -> DataFrame:
    """id, piece, start, ids (binary) of the pieces of each document, closed by `END_ID`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = WordIds.of(tokenizer, cache_bytes), np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            row = 0
            for group in text_groups(batch.column(1).cast(pa.binary()), GROUP_CHARS):
                rows, pieces, parts = [], [], []
                for ids in words.encode(group):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * sequence)):
                        rows.append(row)
                        pieces.append(piece)
                        parts.append(ids[at:at + 4 * sequence])
                    row += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()),
                     pa.array([p * sequence for p in pieces], pa.int64()),
                     pa.array(parts, pa.binary())], [id_col, "piece", "start", "ids"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, piece int, start long, ids binary")


# ---- plan -----------------------------------------------------------------------------------

def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """(bins fixed, what remains) by dominance.

    For the longest piece j, let k be how many of the shortest pieces fit beside it at most.
    k = 0: j stays alone. If one piece fills the bin exactly, or k = 1: j with the longest piece
    that fits. k = 2: that piece as well, if it is as long as every pair that fits. Each of these
    bins can stand in for any other bin of a best packing that holds j.
    """
    left = {size: n for size, n in counts.items() if n}
    fixed: list[Pattern] = []

    def take(sizes: list[int], n: int) -> None:
        fixed.append((tuple((s, sizes.count(s)) for s in sorted(set(sizes), reverse=True)), n))
        for s in sizes:
            left[s] -= n

    for j in sorted(left, reverse=True):
        while left[j] > 0:
            room = capacity - j
            others = {s: n - (s == j) for s, n in left.items() if s <= room and n - (s == j) > 0}
            if not others:
                take([j], 1 if j <= room else left[j])
                continue
            longest = max(others)
            shortest = []
            for s in sorted(others)[:3]:
                shortest += [s] * min(others[s], 3)
            fits, total = 0, 0
            for s in shortest[:3]:
                total += s
                fits += total <= room
            pair = 0
            if fits == 2 and longest != room:
                sizes = sorted(others)
                low, high = 0, len(sizes) - 1
                while low <= high:
                    a, b = sizes[low], sizes[high]
                    if a + b > room:
                        high -= 1
                    elif a == b and others[a] < 2:
                        break
                    else:
                        pair = max(pair, a + b)
                        low += 1
            if longest == room or fits == 1 or (fits == 2 and longest >= pair):
                n = left[j] // 2 if longest == j else min(left[j], left[longest])
                # Shortages change k, so without an exact fit copies go one by one near the end.
                take([j, longest], n if longest == room or n < 2 else max(1, n // 2))
            else:
                break
    return fixed, {size: n for size, n in left.items() if n > 0}


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit, longest pieces first, with equal pieces and equal bins handled together."""
    rooms: dict[int, list[list]] = {}          # room left -> [[contents, copies], ...]
    for size in sorted(counts, reverse=True):
        left = counts[size]
        for room in sorted(r for r in rooms if r >= size):
            if not left:
                break
            fit = room // size
            waiting, rooms[room] = rooms[room], []
            for contents, copies in waiting:
                full = min(copies, left // fit)
                part = left - full * fit if full < copies and left - full * fit < fit else 0
                for times, n in ((fit, full), (part, 1 if part else 0)):
                    if n:
                        rooms.setdefault(room - times * size, []).append(
                            [contents + ((size, times),), n])
                        left -= times * n
                rest = copies - full - (1 if part else 0)
                if rest:
                    rooms[room].append([contents, rest])
            if not rooms[room]:
                del rooms[room]
        fit = capacity // size
        for times, n in ((fit, left // fit), (left % fit, 1)):
            if times and n:
                rooms.setdefault(capacity - times * size, []).append([((size, times),), n])
    return [(contents, copies) for groups in rooms.values() for contents, copies in groups]


def plan_bins(counts: dict[int, int], capacity: int = SEQUENCE) -> list[Pattern]:
    """Bin patterns that hold all pieces of a histogram of lengths."""
    fixed, rest = reduce_instance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def plan_rows(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, times, offset): which ranks of a length lie
    in which copies of a pattern, `times` in each from `offset` on."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for contents, copies in patterns:
        offset = 0
        for length, times in contents:
            first = used.get(length, 0)
            rows.append((length, first, first + times * copies - 1, sequence, times, offset))
            used[length] = first + times * copies
            offset += length * times
        sequence += copies
    return rows


# ---- placement ------------------------------------------------------------------------------

def place_pieces(pieces: DataFrame, order: list[str], sequence: int = SEQUENCE) -> DataFrame:
    """The pieces with sequence_id and offset. `pieces` has `length` (1 to `sequence`) and is
    written; `order` makes the order of equal lengths definite."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    if not counts:
        return pieces.select("*", F.lit(0).cast("long").alias("sequence_id"),
                             F.lit(0).cast("long").alias("offset"))
    plan = spark.createDataFrame(
        plan_rows(plan_bins(counts, sequence)),
        "__length long, __first long, __last long, __sequence long, __times long, __offset long")
    keys = ["length", *order]
    placed = cut_lineage(pieces.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        "__id", F.monotonically_increasing_id()))
    # The id has the task in its upper bits and the place in the lower 33.
    task = F.shiftright("__id", 33)
    parts = placed.groupBy(task.alias("__task"), F.col("length").alias("__of")).agg(
        F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__from"))
    before = Window.partitionBy("__of").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    ranked = placed.join(parts, (task == F.col("__task")) & (F.col("length") == F.col("__of")))
    ranked = ranked.withColumn("__rank", F.col("__before") + F.col("__id") - F.col("__from"))
    found = ranked.join(F.broadcast(plan), (F.col("length") == F.col("__length")) & F.col(
        "__rank").between(F.col("__first"), F.col("__last")))
    at = F.col("__rank") - F.col("__first")
    return found.select(
        *pieces.columns,
        (F.col("__sequence") + F.floor(at / F.col("__times"))).cast("long").alias("sequence_id"),
        (F.col("__offset") + F.pmod(at, F.col("__times")) * F.col("length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   sequence: int = SEQUENCE, with_ids: bool = False, cache_bytes: int | None = None) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    `cache_bytes` bounds each half of what a worker remembers of words (`CACHE_BYTES`); less costs
    time and changes nothing else.

    A null or empty text is one piece, the closing id alone. Only documents longer than a sequence
    are cut, at its multiples. Rows that repeat an id are documents each; a null id is packed like
    any other. Extra columns are ignored. An empty table gives no rows.
    """
    pieces = token_pieces(docs, tokenizer, id_col, text_col, sequence, cache_bytes)
    pieces = pieces.select(
        id_col, "piece", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"), *(["ids"] if with_ids else []))
    return place_pieces(cut_lineage(pieces), [id_col, "piece", "ids_crc32"], sequence)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of each sequence, from the output of `pack_documents` with ids. A
    sequence's pieces are bounded by its length."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(
        F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.array_join(F.transform(
        "parts", lambda p: F.hex(p["ids"])), "").alias("hex")).select(
        "sequence_id", F.unhex("hex").alias("ids"))
