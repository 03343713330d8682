"""Alignment of two tokenizers over the same texts: a byte-level BPE (A) and a sentence-piece BPE (B).

1. *Coarse cuts.* Texts are taken apart at single blanks between words, where no token of either can
   cross, and so are runs of letters, of marks and line breaks within; each part is encoded once and
   remembered. A's character offsets and B's spans say where
   tokens end. Where they do not tell tokens apart - several of one multibyte character, bytes that
   stand for an unknown one - the tokens' decoded bytes do.
2. *Groups and links.* Offsets where tokens of both end cut the stretch into groups. Between two
   neighbouring offsets where a token of either ends lies one A token over one B token: a link.
3. *Counts.* A written row per document holds its distinct links and how often each occurs. Tasks sum
   the documents of each (A id, B id) before they are shuffled.
4. *Look-ups.* The most frequent pairs, `HOT_PAIRS` at most, and each A id's highest count, one
   number per id of the vocabulary, are broadcast; they cover most links. Any other link is joined
   to its count as a row of its own, and the sums are brought back by row.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.packing import text_groups
from riskframe.session import cut_lineage

HOT_PAIRS = 1_000_000          # pairs whose counts are broadcast: 16 MB
CACHE_BYTES = 150_000_000      # of remembered parts in each of the two halves of a worker's memory
ENTRY_BYTES = 300              # of one besides its text, groups and links
NEW_STRETCHES = 20_000         # parts encoded at once
GROUP_CHARS = 1_000_000        # characters of texts handled at once, unless one has more
TASK_PAIRS = 1_000_000         # pairs a task counts before it hands them on

# Single blanks between characters that nothing takes for white space. U+180E and U+200B count as
# white space in some tables only and are left alone.
THIN = "\u180e\u200b"
_BLANK = "\\s" + THIN
CUT = re.compile(f"(?<=[^{_BLANK}]) (?=[^{_BLANK}])")
UNEVEN = re.compile(f" [{_BLANK}]|[{_BLANK}] ")
WORD_MARK = "\u2581"
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"   # no apostrophe: A takes some letters with it
FALLBACK = re.compile("<0x([0-9A-F]{2})>")
SPAN = attrgetter("id", "begin", "end")


def byte_letters() -> dict[str, int]:
    """The letter a byte-level vocabulary writes for each byte: itself if printable, else one from
    U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def refined(ends: np.ndarray, clean: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where each token ends: at its span's end if that is a clean cut, else as many decoded bytes
    after the last clean cut as the tokens since then have."""
    decoded = np.cumsum(lengths)
    shift = np.where(clean, ends - decoded, 0)
    last = np.maximum.accumulate(np.where(clean, np.arange(len(ends)), -1))
    return decoded + np.where(last >= 0, shift[np.maximum(last, 0)], 0)


Aligned = tuple[str, bytes, int]   # groups, link keys, and the numbers of A tokens, B tokens and groups


class Aligner:
    """Both tokenizers and the parts a worker remembers: stretches, which stand after a blank, under their
    text, and what stands within stretches under its bytes.

    A full memory becomes the old half, from which parts that are met again are taken over.
    """

    loaded: dict[tuple[str, str], Aligner] = {}

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            if all(c in letters for c in token):
                self.a_bytes[number] = bytes(letters[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes.fromhex(FALLBACK.fullmatch(p)[1]) if FALLBACK.fullmatch(p) and self.b.is_byte(
            i) else p.replace(WORD_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (
            np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        # Each id twice: with more of its side to come, and as its side's last in a group.
        self.names = [f"{i}{c}" for table, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;"))
                      for i in range(len(table)) for c in ends]
        self.key_type = "<u4" if len(self.a_bytes) * len(pieces) <= 1 << 32 else "<i8"
        # A piece with a blank after other characters could join two stretches.
        self.cuts = all(WORD_MARK not in p.lstrip(WORD_MARK) for p in pieces)
        # A mark after a letter begins a token, unless a piece holds both; so does a line break between
        # them, and what follows it.
        inside = {pair for i, p in enumerate(pieces) if not (
            self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i)) for pair in zip(p, p[1:], strict=False)}
        after_letters = {y for x, y in inside if x.isalpha()}
        self.marks = "".join(m for m in MARKS if m not in after_letters and self._parts_at(f"a{m}\na"))
        lines = self._parts_at("a\na") and not any("\n" in pair for pair in inside)
        letters, more = r"[^\W\d_]+", f"[{re.escape(self.marks)}]" if self.marks else "(?!)"
        # Not to be matched where line breaks are no borders.
        feed = r"\n" if lines else "(?!)"
        self.shape = re.compile(f"{letters}{more}*(?:{feed}{letters}{more}*)*")
        self.part = re.compile(rf"\n?{letters}|{more}+")
        self.known: dict[str | bytes, Aligned | None] = {}
        self.old: dict[str | bytes, Aligned | None] = {}
        self.numbers: dict[int, int] = {}     # one object for all parts of the same numbers
        self.held = 0

    @classmethod
    def of(cls, path_a: str, path_b: str) -> Aligner:
        if (path_a, path_b) not in cls.loaded:
            cls.loaded[path_a, path_b] = cls(path_a, path_b)
        return cls.loaded[path_a, path_b]

    def stretches(self, text: str) -> list[str]:
        """The text cut at single blanks between words; the blanks are left out."""
        if not self.cuts:
            return [text]
        if text[0] == " " or text[-1] == " " or UNEVEN.search(text):
            return CUT.split(text)
        return text.split(" ")

    def _parts_at(self, text: str) -> bool:
        """Whether A takes a text apart at each character."""
        found = self.a.pre_tokenizer.pre_tokenize_str(text)
        return [span for _, span in found] == [(i, i + 1) for i in range(len(text))]

    def parts(self, stretch: str) -> list[str | bytes]:
        """What a stretch consists of, where no token crosses from one to the next: its first letters,
        then, in bytes, runs of marks and of letters with the line break before them. A stretch that is
        not built like that is its only part."""
        if not self.cuts:
            return [stretch]
        first = stretch.rstrip(self.marks)
        if first.isalpha():
            return [first, stretch[len(first):].encode()] if len(first) < len(stretch) else [stretch]
        if not self.shape.fullmatch(stretch):
            return [stretch]
        first, *rest = self.part.findall(stretch)
        # The pattern takes some numbers for letters.
        if not all(part.lstrip("\n").isalpha() for part in (first, *rest) if part[-1].isalnum()):
            return [stretch]
        return [first, *map(str.encode, rest)]

    def remind(self, parts: set[str | bytes]) -> set[str | bytes]:
        """Take parts over from the old half; those that are not in it."""
        new = parts.difference(self.old)      # a set's intersection with a dict would walk all of the dict
        for part in parts - new:
            self.keep(part, self.old[part])
        return new

    def learn(self, parts: list[str | bytes]) -> None:
        """Align parts and remember the results.

        They are encoded as one text, stretches with a blank before them, which no token crosses, then
        what stands within stretches, marks after a letter. Those that would join with a neighbour's blank,
        or do not give back their bytes, are encoded by themselves.
        """
        within = [p for p in parts if isinstance(p, bytes)]
        stretches = [p for p in parts if isinstance(p, str)] if within else parts
        even = [(s, " " + s) for s in stretches if s.isalpha() or self.cuts and s and not (
            s[0].isspace() or s[-1].isspace() or s[0] in THIN or s[-1] in THIN or WORD_MARK in s)]
        feeds = [(p, p.decode()) for p in within if p.startswith(b"\n")]
        marks = (self._in_place(p) for p in within if not p.startswith(b"\n"))
        together = [*even, *([("a", " a")] if feeds else []), *feeds, *chain.from_iterable(marks)]
        if together and self._aligned(together):
            if len(even) == len(stretches):
                return
            done = {s for s, _ in even}.union(within)
        else:
            done = set()
        for part in set(parts).difference(done):
            if not self._aligned(self._in_place(part) if isinstance(part, bytes) else [(part, " " + part)]):
                self.keep(part, None)

    def _in_place(self, part: bytes) -> list[tuple[str | bytes, str]]:
        """A part that stands within stretches, and its text, behind a stretch that it may follow."""
        return [("a", " a"), (part, part.decode())]

    def keep(self, part: str | bytes, found: Aligned | None) -> None:
        self.known[part] = found
        self.held += ENTRY_BYTES + len(part) + (len(found[0]) + len(found[1]) if found else 0)

    def _aligned(self, parts: list[tuple[str | bytes, str]]) -> bool:
        """Remember the groups and links of parts whose texts are encoded together; False if their bytes do
        not come back or their borders are not where tokens end."""
        texts = [text for _, text in parts]
        text = "".join(texts)
        raw = text.encode()
        stops = np.cumsum(np.fromiter(map(len, map(str.encode, texts)), np.int64, len(texts)))
        found = self.a.encode(text, add_special_tokens=False)
        ids_a = np.array(found.ids, np.int64)
        spans = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(ids_a)).reshape(-1, 2)
        if len(raw) != len(text):
            at_char = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
            spans = np.append(at_char, len(raw))[spans]
        after = np.append(spans[1:, 0], len(raw))
        ends_a = refined(spans[:, 1], spans[:, 1] <= after, self.a_sizes[ids_a])

        pieces = self.b.encode(text[1:], return_type="proto").pieces
        flat = np.fromiter(chain.from_iterable(map(SPAN, pieces)), np.int64, 3 * len(pieces))
        ids_b, begins, ends_b = flat.reshape(-1, 3).T
        # Spans are bytes of the text after the first blank.
        ends_b = refined(ends_b + 1, ends_b > begins, self.b_sizes[ids_b])
        if (b"".join(map(self.a_bytes.__getitem__, ids_a.tolist())) != raw
                or b"".join(map(self.b_bytes.__getitem__, ids_b.tolist())) != raw):
            return False
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        if not np.isin(stops, both).all():
            return False

        cuts = np.union1d(ends_a, ends_b)
        keys = (ids_a[np.searchsorted(ends_a, cuts)] * len(self.b_sizes)
                + ids_b[np.searchsorted(ends_b, cuts)]).astype(self.key_type)
        # Names in order: of each group A's tokens, then B's; the last of each says what follows.
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        codes = np.concatenate([2 * ids_a + (both[group_a] == ends_a),
                                2 * (ids_b + len(self.a_bytes)) + (both[group_b] == ends_b)])[order]
        names = list(map(self.names.__getitem__, codes.tolist()))
        last_a, last_b, last_link, last_group = (
            (np.searchsorted(x, stops, "right")).tolist() for x in (ends_a, ends_b, cuts, both))
        packed, size = keys.tobytes(), keys.itemsize
        known, numbers, held = self.known, self.numbers, ENTRY_BYTES * len(parts) + len(raw) + len(packed)
        a = b = link = group = 0
        for (part, _), x, y, z, g in zip(parts, last_a, last_b, last_link, last_group, strict=True):
            groups = "".join(names[a + b:x + y])
            number = (x - a) | (y - b) << 32 | (g - group) << 64
            known[part] = groups, packed[size * link:size * z], numbers.setdefault(number, number)
            held += len(groups)
            a, b, link, group = x, y, z, g
        self.held += held
        return True

    def align(self, texts: list[str]) -> list[tuple[str, np.ndarray, int, int, int] | None]:
        """Groups, link keys, and the numbers of A tokens, B tokens and groups of each text; None of a
        text without tokens."""
        cut = [self.stretches(text) if text else [] for text in texts]
        if self.held > CACHE_BYTES:
            self.old, self.known, self.numbers, self.held = self.known, {}, {}, 0
        known = self.known
        new = self.remind(set().union(*cut).difference(known))
        built = {s: parts for s in new if len(parts := self.parts(s)) > 1}
        new.difference_update(built)
        new.update(self.remind(set(chain.from_iterable(built.values())).difference(known, new)))
        new = list(new)
        start = chars = 0
        for stop, part in enumerate(new, 1):
            chars += len(part)
            if stop - start >= NEW_STRETCHES or chars >= GROUP_CHARS or stop == len(new):
                self.learn(new[start:stop])
                start, chars = stop, 0
        for stretch, parts in built.items():
            found = [known[part] for part in parts]
            if None in found:
                self.keep(stretch, None)
            else:
                groups, raw, numbers = zip(*found, strict=True)
                number = sum(numbers)
                self.keep(stretch, ("".join(groups), b"".join(raw), self.numbers.setdefault(number, number)))
        out = []
        for parts in cut:
            found = list(map(known.__getitem__, parts))
            if not found or None in found:
                out.append(None)
                continue
            groups, raw, numbers = zip(*found, strict=True)
            total = sum(numbers)
            out.append(("".join(groups)[:-1], np.frombuffer(b"".join(raw), self.key_type),
                        total & 0xFFFFFFFF, total >> 32 & 0xFFFFFFFF, total >> 64))
        return out


def linked_texts(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, groups_sha256, pairs and times (binary: the distinct link
    keys in order and how often each occurs) of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of(path_a, path_b)
        for batch in batches:
            start = 0
            for texts in text_groups(batch.column(1), GROUP_CHARS):
                counts, digests, pairs, times = [], [], [], []
                for found in aligner.align(texts):
                    if found is None:
                        counts.append((0, 0, 0, 0))
                        digests.append("")
                        pairs.append(b"")
                        times.append(b"")
                        continue
                    groups, keys, n_a, n_b, n_groups = found
                    values, often = np.unique(keys, return_counts=True)
                    counts.append((n_a, n_b, n_groups, len(keys)))
                    digests.append(hashlib.sha256(groups.encode()).hexdigest())
                    pairs.append(values.tobytes())
                    times.append(often.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)),
                     *[pa.array(c, pa.int64()) for c in zip(*counts, strict=True)],
                     pa.array(digests, pa.string()), pa.array(pairs, pa.binary()), pa.array(times, pa.binary())],
                    NAMES)
                start += len(texts)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
             "pairs binary, times binary")


NAMES = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]


def pair_counts(rows: DataFrame, key_type: str) -> DataFrame:
    """pair and count: the rows of `rows` (pairs: distinct keys) that hold it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = np.array([], np.int64), np.array([], np.int64)
        for batch in batches:
            raw = [x.as_py() for x in batch.column(0)]
            for at in range(0, len(raw), 200):
                part = np.frombuffer(b"".join(raw[at:at + 200]), key_type).astype(np.int64)
                values, often = np.unique(part, return_counts=True)
                held, back = np.unique(np.concatenate([held, values]), return_inverse=True)
                count = np.bincount(back, np.concatenate([count, often]), len(held)).astype(np.int64)
                if len(held) >= TASK_PAIRS:
                    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(count)], ["pair", "count"])
                    held, count = np.array([], np.int64), np.array([], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(count)], ["pair", "count"])
    return rows.select("pairs").mapInArrow(run, "pair long, count long").groupBy("pair").agg(
        F.sum("count").alias("count"))


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The pairs of the highest counts, all of a count or none, `most` at most."""
    # Steps of a quarter of a power of two: a few hundred rows, whatever the number of pairs.
    step = F.floor(F.log2("count") * 4).cast("int")
    sizes = sorted(map(tuple, counts.groupBy(step.alias("step")).count().collect()), reverse=True)
    least, held = None, 0
    for number, size in sizes:
        held += size
        if held > most:
            break
        least = number
    return counts.filter(step >= least) if least is not None else counts.limit(0)


def scored(rows: DataFrame, hot: DataFrame, best: DataFrame, width: int, key_type: str) -> DataFrame:
    """`rows` with n_best and count_sum over the pairs of `hot`, and `rest`: (pair, times) of the
    others as structs."""
    spark = rows.sparkSession
    table = hot.sort("pair").toArrow()
    tops = np.zeros(1, np.int64)
    found = best.toArrow()
    if found.num_rows:
        tops = np.zeros(max(found["a"].to_pylist()) + 1, np.int64)
        tops[found["a"].to_numpy()] = found["best"].to_numpy()
    shared = spark.sparkContext.broadcast(
        (table["pair"].to_numpy(), table["count"].to_numpy(), tops))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, tops = shared.value
        for batch in batches:
            sums, bests, rest_pairs, rest_times, offsets = [], [], [], [], [0]
            for pairs, times in zip(batch.column(1), batch.column(2), strict=True):
                mine = np.frombuffer(pairs.as_py(), key_type).astype(np.int64)
                often = np.frombuffer(times.as_py(), "<u4").astype(np.int64)
                place = np.searchsorted(keys, mine)
                hit = place < len(keys)
                hit[hit] = keys[place[hit]] == mine[hit]
                count = values[place[hit]]
                sums.append(int((count * often[hit]).sum()))
                bests.append(int(often[hit][count == tops[mine[hit] // width]].sum()))
                rest_pairs.append(mine[~hit])
                rest_times.append(often[~hit])
                offsets.append(offsets[-1] + int((~hit).sum()))
            rest = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(np.concatenate([*rest_pairs, np.array([], np.int64)])),
                 pa.array(np.concatenate([*rest_times, np.array([], np.int64)]))], ["pair", "times"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(bests, pa.int64()), pa.array(sums, pa.int64()), rest,
                 *batch.columns[3:]], ["id", "n_best", "count_sum", "rest", *NAMES[1:6]])
    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "pairs", "times", *NAMES[1:6]).mapInArrow(
        run, f"id {kind}, n_best long, count_sum long, rest array<struct<pair:long,times:long>>, "
             "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string")


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
                     text_col: str = "text", hot_pairs: int | None = None) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A encodes a blank and the text, B the text, to which it adds the blank itself; the strings of special
    tokens are plain text. A text that is null, empty, or that the tokens do not give back byte by byte
    (U+2581, which B takes for a blank) has no tokens: zeros and an empty digest. A count is the number
    of rows that hold the pair, so rows that repeat an id count each; ties for an A id's highest
    count all count as best. A text without blanks is one stretch, however long. Extra columns are
    ignored. An empty table gives no rows.
    """
    rows = cut_lineage(linked_texts(docs, path_a, path_b, id_col, text_col))
    aligner = Aligner.of(path_a, path_b)
    width, key_type = len(aligner.b_bytes), aligner.key_type
    a = F.expr(f"pair DIV {width}").alias("a")
    counts = cut_lineage(pair_counts(rows, key_type))
    # One row per id of A's vocabulary at most.
    best = counts.groupBy(a).agg(F.max("count").alias("best"))
    hot = frequent(counts, HOT_PAIRS if hot_pairs is None else hot_pairs)
    found = scored(rows, hot, best, width, key_type).withColumn("__row", F.monotonically_increasing_id())
    found = cut_lineage(found)
    rest = found.filter(F.size("rest") > 0).select("__row", F.explode("rest").alias("r")).select(
        "__row", "r.pair", "r.times")
    # None of these pairs has more rows than the rarest of the frequent ones.
    named = rest.join(counts, "pair").select("*", a).join(F.broadcast(best), "a")
    sums = named.groupBy("__row").agg(
        F.sum(F.col("count") * F.col("times")).alias("__sum"),
        F.sum(F.when(F.col("count") == F.col("best"), F.col("times")).otherwise(0)).alias("__best"))
    out = found.drop("rest").join(sums, "__row", "left")
    more = [(F.col(c) + F.coalesce(extra, F.lit(0))).alias(c)
            for c, extra in (("n_best", "__best"), ("count_sum", "__sum"))]
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", *more, "groups_sha256")
