"""Packing of tokenised documents into sequences of a fixed length."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from funnelwright.llm.common import Scratch

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"  # of the public tokenizers; a full path can be given instead
SPLIT_BYTES = 2_000_000  # of text that is split into words at once
KNOWN_WORDS = 400_000  # whose ids a Python worker keeps

# After an ASCII letter the tokenizer's expression always ends a token before one of these, so a text can be cut there. That
# leaves fewer distinct words to encode.
_CUT = r"([A-Za-z])([!-/:-@\[-`{-~0-9])"
# The parts of the tokenizer's file that the above and the encoding by words rely on.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPLITTING = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def tokenizer_path(name: str) -> str:
    """Where the file is: ``name`` itself if it is a path, or else the file of the public tokenizers of that name."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class _Encoder:
    """Token ids of texts, by words: spaces never reach the tokenizer's output, so a text's ids are those of its words in order.

    Each distinct word is encoded once for as long as it is known. A word of Latin letters passes the tokenizer's normalisation and
    splitting as one lower-cased piece, so it goes to its model directly; any other word goes through all of the tokenizer.
    """

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        parts = json.loads(self.tokenizer.to_str())
        if (parts["normalizer"], parts["pre_tokenizer"]) != (_NORMALIZER, _SPLITTING):
            raise ValueError(f"{name} does not drop white space and split words as this packing does")
        self.tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        self.latin = re.compile("[a-zA-ZÀ-ÖØ-öø-ÿ]+").fullmatch
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.as_bytes = {code: as_bytes.pre_tokenize_str(chr(code))[0][0] for code in range(0xC0, 0x100)}
        self._forget()

    def _ids_of(self, words: list[str]) -> list[list[int]]:
        model, found = self.tokenizer.model, dict.fromkeys(words)
        other = [word for word in words if not self.latin(word)]
        found.update(zip(other, (x.ids for x in self.tokenizer.encode_batch_fast(other, add_special_tokens=False)), strict=True))
        for word, ids in found.items():
            if ids is None:
                plain = word if word.isascii() else word.lower().translate(self.as_bytes)
                found[word] = [token.id for token in model.tokenize(plain)]
        return list(found.values())

    def _forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.ids, self.starts, self.lengths, self.used = np.zeros(1 << 16, np.uint32), np.zeros(0, np.int32), np.zeros(0, np.int32), 0

    def _learn(self, words: list[str]) -> None:
        new = [word for word in words if word not in self.numbers]
        if not new:
            return
        found = self._ids_of(new)
        self.numbers.update(zip(new, range(len(self.numbers), len(self.numbers) + len(new)), strict=True))
        lengths = np.fromiter(map(len, found), np.int32, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
        if self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(max(len(flat), self.used), np.uint32)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.starts = np.append(self.starts, self.used + np.cumsum(lengths, dtype=np.int32) - lengths)
        self.lengths = np.append(self.lengths, lengths)
        self.used += len(flat)

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Ids of each of the texts."""
        try:
            valid = pa.array(texts, pa.binary()).cast(pa.string())
        except pa.ArrowInvalid:  # bytes that are no UTF-8 become replacement characters
            valid = pa.array([text.decode("utf-8", "replace") for text in texts])
        cut = pc.replace_substring_regex(valid, pattern=_CUT, replacement=r"\1 \2")
        lists = pc.ascii_split_whitespace(cut)
        words = lists.flatten().dictionary_encode()
        # The tokenizer lower-cases; doing it here for words of ASCII letters alone leaves fewer distinct ones.
        distinct = [word.lower() if word.isascii() else word for word in words.dictionary.to_pylist()]
        if len(self.numbers) > KNOWN_WORDS:
            self._forget()
        self._learn(list(dict.fromkeys(distinct)))
        numbers = np.fromiter(map(self.numbers.__getitem__, distinct), np.int32, len(distinct))
        at = numbers[words.indices.to_numpy()]
        ends = np.cumsum(pc.list_value_length(lists).to_numpy())
        for start, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            own = at[start:end]
            lengths = self.lengths[own]
            after = np.cumsum(lengths, dtype=np.int32)
            places = np.repeat(self.starts[own] - after + lengths, lengths)
            places += np.arange(len(places), dtype=np.int32)
            yield self.ids[places]


def _parts(data: bytes) -> Iterator[bytes]:
    """A text in parts of about ``SPLIT_BYTES``, cut at white space."""
    start = 0
    while len(data) - start > SPLIT_BYTES:
        cut = _SPACE.search(data, start + SPLIT_BYTES)
        if cut is None:
            break
        yield data[start : cut.start()]
        start = cut.end()
    yield data[start:]


def _grouped(rows: Iterator[tuple[int, bytes]]) -> Iterator[list[tuple[int, bytes, bool]]]:
    """Parts of texts, each with its row and whether it is the row's last, in groups of about ``SPLIT_BYTES``."""
    waiting, size = [], 0
    for row, data in rows:
        parts = _parts(data)
        part = next(parts)
        while part is not None:
            following = next(parts, None)
            waiting.append((row, part, following is None))
            size += len(part)
            if size >= SPLIT_BYTES:
                yield waiting
                waiting, size = [], 0
            part = following
    if waiting:
        yield waiting


def _pieces(name: str, capacity: int, end_id: int, encoders: dict):
    columns = ("piece", "start", "length", "ids_crc32", "part", "nth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One encoder per Python worker: a broadcast's value stays for the worker's next tasks.
        encoder = encoders.value.setdefault(name, None) or _Encoder(name)
        encoders.value[name] = encoder
        task, met = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            texts = ((row, data.as_py() or b"") for row, data in enumerate(batch.column(1)))
            rows, found = [], []
            ids, start = [np.zeros(0, np.uint32)], 0

            def give(row: int, own: np.ndarray) -> None:
                nonlocal start
                size = len(own)
                rows.append(row)
                found.append((start // capacity, start, size, zlib.crc32(own.astype("<u4").tobytes()), task, met[size]))
                met[size] += 1
                start += size

            for group in _grouped(texts):
                for (row, _, last), own in zip(group, encoder.encode([x[1] for x in group]), strict=True):
                    ids.append(own)
                    if last:
                        ids.append(np.array([end_id], np.uint32))
                    elif sum(map(len, ids)) <= capacity:
                        continue
                    held = np.concatenate(ids)
                    while len(held) > capacity:
                        give(row, held[:capacity])
                        held = held[capacity:]
                    ids = [held]
                    if last:
                        give(row, held)
                        ids, start = [np.zeros(0, np.uint32)], 0
            values = list(zip(*found, strict=True)) or [()] * len(columns)
            arrays = [pa.array(value, pa.int64()) for value in values]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *arrays], names=["doc_id", *columns])

    return run


class _Stock:
    """How many pieces of each length are left, with an index of the sums that pairs of them make."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64)
        there = (self.left > 0).astype(np.int64)
        pairs = np.convolve(there, there)[: len(counts)]
        twice = np.zeros(len(counts), np.int64)
        twice[::2] = there[: len(twice[::2])]
        self.pairs = (pairs - twice) // 2  # of two lengths
        again = np.flatnonzero(self.left > 1)
        again = again[again * 2 < len(counts)]
        self.pairs[again * 2] += 1

    def take(self, length: int, n: int) -> None:
        before, after = self.left[length], self.left[length] - n
        self.left[length] = after
        if before > 1 >= after and length * 2 < len(self.pairs):
            self.pairs[length * 2] -= 1
        if after == 0:
            others = np.flatnonzero(self.left[: len(self.pairs) - length])
            self.pairs[length + others] -= 1

    def largest(self, limit: int) -> int:
        """The largest length up to ``limit``, 0 if there is none."""
        held = np.flatnonzero(self.left[: limit + 1])
        return int(held[-1]) if len(held) else 0

    def exactly(self, gap: int) -> tuple[int, ...]:
        """One, two or three pieces that together have the length ``gap``, the largest first; none if there are no such pieces."""
        if self.left[gap]:
            return (gap,)
        if self.pairs[gap]:
            return self._pair(gap)
        held = np.flatnonzero(self.left[:gap])
        for first in held[self.pairs[gap - held] > 0][::-1].tolist():
            self.left[first] -= 1  # the pair must do without it
            pair = self._pair(gap - first)
            self.left[first] += 1
            if pair:
                return (first, *pair)
        return ()

    def _pair(self, total: int) -> tuple[int, ...]:
        first = np.flatnonzero(self.left[:total])
        fits = first[(first * 2 >= total) & (self.left[total - first] > (first * 2 == total))]
        return (int(fits[-1]), int(total - fits[-1])) if len(fits) else ()


def plan_sequences(counts: np.ndarray) -> list[tuple[int, list[int]]]:
    """How to pack pieces, of which ``counts`` has the number by length, into sequences as long as the longest length in it.

    Returns (how often, lengths in a sequence). A sequence begins with the longest piece that is left. Its gap is closed by a
    piece, a pair or a triple of exactly its length if there is one, which the index of lengths and of sums tells; else the best
    fit, the longest piece that it has room for, makes it smaller. What was found for one sequence is used for as many as
    the pieces last. So the work depends on how many lengths there are and not on how many pieces.
    """
    capacity, stock, plan = len(counts) - 1, _Stock(counts), []
    while longest := stock.largest(capacity):
        own, gap = [], capacity

        def put(length: int, n: int, own=own) -> int:
            own.extend([length] * n)
            stock.take(length, n)
            return length * n

        gap -= put(longest, 1)
        while gap:
            exact = stock.exactly(gap)
            for length in exact:
                gap -= put(length, 1)
            if exact or not (fit := stock.largest(gap)):
                break
            # As many at once as leave the gap large enough for a triple of such pieces.
            gap -= put(fit, max(1, min(int(stock.left[fit]), gap // fit - 3)))
        needs = Counter(own)
        more = min(int(stock.left[length]) // n for length, n in needs.items())
        for length, n in needs.items():
            if more:
                stock.take(length, more * n)
        plan.append((more + 1, own))
    return plan


def _places(plan: list[tuple[int, list[int]]], capacity: int) -> tuple[np.ndarray, ...]:
    """By length and rank from where on: number of the sequence for that rank, and the place in the sequences."""
    ranks, rows, sequence = Counter(), [], 0
    for times, lengths in plan:
        for length, offset in zip(lengths, accumulate(lengths, initial=0)):
            rows.append((length, ranks[length], sequence, offset))
            ranks[length] += times
        sequence += times
    table = np.array(rows, np.int64).reshape(-1, 4)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    firsts = np.searchsorted(table[:, 0], np.arange(capacity + 2))
    return firsts, table[:, 1].copy(), table[:, 2].copy(), table[:, 3].copy()


def _assigned(places):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, ranks, sequences, offsets = places.value
        for batch in batches:
            length, rank = (batch.column(name).to_numpy() for name in ("length", "rank"))
            at = np.zeros(len(length), np.int64)
            for one in np.unique(length):
                own = np.flatnonzero(length == one)
                start, end = firsts[one], firsts[one + 1]
                at[own] = start + np.searchsorted(ranks[start:end], rank[own], side="right") - 1
            new = [pa.array(sequences[at] + rank - ranks[at]), pa.array(offsets[at])]
            kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in kept), *new], names=[*kept, "sequence_id", "offset"])

    return run


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """All documents as tokens in sequences of at most ``capacity``, few sequences.

    Returns per piece doc_id, piece, start, length, ids_crc32, sequence_id and offset. A document is its ids and ``end_id``; only
    a longer one than ``capacity`` is cut, at multiples of it. Ids are written nowhere: their checksum and place say
    where a reader that encodes again has to put them.

    Texts are encoded once. The pieces, without their ids, go to the shared folder with the task that made them and how many of
    their length came before in that task. The driver plans with the number of pieces of each length, at most ``capacity``
    rows whatever the corpus. A piece's rank among those of its length, the pieces of its task and the tasks before, is its
    place in the plan.

    Defined cases: NULL and empty texts are the end id alone. Rows that share a doc_id, equal or not, are documents of their
    own. A NULL doc_id stays NULL. An empty table gives no rows. Names of special tokens in texts are ordinary text. Other columns are
    not looked at.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("data"))
    kind = source.schema["doc_id"].dataType.simpleString()
    numbers = "piece long, start long, length long, ids_crc32 long"
    encoders = spark.sparkContext.broadcast({})
    pieces = source.mapInArrow(_pieces(tokenizer, capacity, end_id, encoders), f"doc_id {kind}, {numbers}, part long, nth long")
    pieces = scratch.store(pieces, "pieces")

    by_task = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    by_task = scratch.store(by_task, "by_task")
    counts = np.zeros(capacity + 1, np.int64)
    for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row.length] = row.n
    places = spark.sparkContext.broadcast(_places(plan_sequences(counts), capacity))

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return ranked.mapInArrow(_assigned(places), f"doc_id {kind}, {numbers}, sequence_id long, offset long")
