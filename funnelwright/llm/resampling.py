"""Importance resampling towards a target text distribution, over hashed word features found by an automaton."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from funnelwright.llm.common import Scratch

BUCKETS = 10_000
LEAST_WORDS = 20  # of a document that can be drawn
PERCENT = 25  # of these that are drawn
SEED = 7
SCAN_BYTES = 2_000_000  # of text whose distinct words make one automaton
LONGEST_KEY = 256  # bytes of a word that goes into an automaton; longer ones get their payload directly

# Bytes to lower-cased word bytes; everything that is no word byte to a space. Word bytes: 0-9, a-z, and all of UTF-8's
# bytes from 0x80 on.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
# Marks in a scanned text, which the table above leaves free: the end of a document's part, and a long word.
_END, _LONG = "\x00", "\x01"


def _appending_operators() -> list[np.ndarray]:
    """For each k the linear operator on a CRC-32 that 2**k zero bytes after its text amount to, as four tables of 256."""
    places = (np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]).astype(np.uint32)
    steps = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)
    found = [(places >> np.uint32(8)) ^ steps[places & np.uint32(255)]]
    while len(found) < 31:
        found.append(_applied(found[-1], found[-1]))
    return found


def _applied(operator: np.ndarray, crc: np.ndarray) -> np.ndarray:
    bits = np.uint32(255)
    low = operator[0][crc & bits] ^ operator[1][(crc >> np.uint32(8)) & bits]
    return low ^ operator[2][(crc >> np.uint32(16)) & bits] ^ operator[3][crc >> np.uint32(24)]


def _joined_crc(operators: list[np.ndarray], first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of two texts after one another, from their own and the number of bytes of the second."""
    moved = first.copy()
    for k in range(int(length.max(initial=0)).bit_length()):
        own = np.flatnonzero(length >> k & 1)
        moved[own] = _applied(operators[k], moved[own])
    return moved ^ second


class _Scanner:
    """Payloads of the words of texts: CRC-32, CRC-32 with a space after the word, and length in bytes."""

    def __init__(self) -> None:
        self.operators = _appending_operators()
        self.long_word = re.compile(rb"[^ ]{%d,}" % (LONGEST_KEY + 1))

    def payloads(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all words of the parts in order, and how many words each part has.

        One automaton holds the distinct words of the parts, bounded by spaces on both sides; a text's scan then emits a
        payload per word. Bytes stand for characters.
        """
        rest: list[bytes] = []

        def set_apart(found: re.Match) -> bytes:
            rest.append(found[0])
            return _LONG.encode()

        short = [self.long_word.sub(set_apart, part) for part in parts]
        text = f" {f' {_END} '.join(part.decode('latin-1') for part in short)} {_END} "
        words = list(set(text.split(" ")) - {"", _END, _LONG})
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, word in enumerate([*words, _END, _LONG]):
            automaton.add_word(f" {word} ", number)
        automaton.make_automaton()
        found = np.fromiter(map(itemgetter(1), automaton.iter(text)), np.int64)

        ends = np.flatnonzero(found == len(words))
        n_words = np.diff(ends, prepend=-1) - 1
        found = np.delete(found, ends)
        crcs, spaced, lengths = self._of_words([word.encode("latin-1") for word in words])
        at = np.flatnonzero(found > len(words))
        found[at] = len(words) + np.arange(len(at))
        more = self._of_words(rest)
        crcs, spaced, lengths = (np.concatenate(both) for both in zip((crcs, spaced, lengths), more, strict=True))
        return crcs[found], spaced[found], lengths[found], n_words

    @staticmethod
    def _of_words(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        crcs = [zlib.crc32(word) for word in words]
        spaced = [zlib.crc32(b" ", crc) for crc in crcs]
        return np.array(crcs, np.uint32), np.array(spaced, np.uint32), np.array([len(word) for word in words], np.int64)

    def features(self, parts: list[bytes], follows: list[bool], last: tuple | None) -> tuple[list[np.ndarray], tuple | None]:
        """CRC-32 of the runs of one and two words of each part; those that begin in the part before belong to the later part.

        ``follows`` says of each part whether it goes on with the text before it, ``last`` is the payload of that text's
        last word. Returns the payload of the last word of all too.
        """
        crcs, spaced, lengths, n_words = self.payloads(parts)
        out, start = [], 0
        for n, goes_on in zip(n_words, follows, strict=True):
            own = slice(start, start + n)
            before = spaced[start : start + n - 1] if n else spaced[:0]
            after, size = crcs[own][1:], lengths[own][1:]
            last = last if goes_on else None
            if last is not None and n:
                before, after, size = np.append(before, last[0]), np.append(after, crcs[start]), np.append(size, lengths[start])
            out.append((crcs[own], before, after, size))
            if n:
                last = (spaced[start + n - 1],)
            start += n
        # All pairs at once: a composition costs the same few steps for one pair as for a million.
        pairs = _joined_crc(self.operators, *(np.concatenate([x[k] for x in out]) if out else np.zeros(0, np.uint32) for k in (1, 2, 3)))
        cuts = np.cumsum([len(x[1]) for x in out])
        return [np.concatenate([x[0], own]) for x, own in zip(out, np.split(pairs, cuts[:-1]) if out else [], strict=True)], last


def _pieces(data: bytes, size: int) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes, cut where words end."""
    start = 0
    while len(data) - start > size:
        cut = data.find(b" ", start + size)
        if cut < 0:
            break
        yield data[start:cut]
        start = cut
    yield data[start:]


def _features(n_buckets: int):
    kind = np.uint16 if n_buckets <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _Scanner()
        for batch in batches:
            waiting: list[tuple[int, bytes, bool]] = []
            size, last = 0, None
            hashed: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]

            def flush() -> None:
                nonlocal waiting, size, last
                found, last = scanner.features([x[1] for x in waiting], [x[2] for x in waiting], last)
                for (row, _, _), crcs in zip(waiting, found, strict=True):
                    hashed[row].append((crcs % np.uint32(n_buckets)).astype(kind))
                waiting, size = [], 0

            for row, data in enumerate(batch.column(1)):
                text = (data.as_py() or b"").translate(_PLAIN)
                for turn, part in enumerate(_pieces(text, SCAN_BYTES)):
                    waiting.append((row, part, turn > 0))
                    size += len(part)
                    if size >= SCAN_BYTES:
                        flush()
            if waiting:
                flush()
            lists = [np.concatenate(own) for own in hashed]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(own) for own in lists], pa.int64()), pa.array([own.tobytes() for own in lists], pa.binary())],
                names=["doc_id", "n_features", "buckets"],
            )

    return run


def _counted(n_buckets: int):
    kind = np.uint16 if n_buckets <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for data in batch.column(0):
                counts += np.bincount(np.frombuffer(data.as_buffer(), kind), minlength=n_buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], names=["bucket", "n"])

    return run


def word_features(docs: DataFrame, n_buckets: int = BUCKETS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_features, buckets) per row: the buckets of all runs of one and two words, repeats included, as packed integers.

    Words are runs of ASCII letters and digits, A-Z lower-cased, and of all characters beyond ASCII. NULL and empty texts
    have no features. A text of any length is scanned in parts.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("data"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_features(n_buckets), f"doc_id {kind}, n_features long, buckets binary")


def bucket_counts(features: DataFrame, n_buckets: int = BUCKETS) -> np.ndarray:
    """How many features each bucket holds. Summed in each task first; the driver gets one row per bucket."""
    parts = features.select("buckets").mapInArrow(_counted(n_buckets), "bucket long, n long")
    counts = np.zeros(n_buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] = row.n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the logarithm, in thousandths, of how much more frequent it is in the target than in the corpus.

    Counts are smoothed by one each.
    """
    n, S, T = len(corpus), int(corpus.sum()), int(target.sum())
    ratios = (float((t + 1) * (S + n)) / float((s + 1) * (T + n)) for s, t in zip(corpus.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], np.int64)


def _scored(gain: np.ndarray, seed: int):
    kind = np.uint16 if len(gain) <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights, scores = [], []
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                own = gain[np.frombuffer(data.as_buffer(), kind)]
                weights.append(int(own.sum()) // len(own) if len(own) else 0)
                digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
                luck = -1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296))
                scores.append(weights[-1] + math.floor(luck))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(weights, pa.int64()), pa.array(scores, pa.int64())],
                names=["doc_id", "n_features", "weight", "score"],
            )

    return run


def _ranked(scored: DataFrame, least_words: int, percent: int) -> DataFrame:
    """Rank 1, 2, 3... by score from above, ties to smaller doc_id, for the drawn; NULL for others.

    Scores are integers within some 200,000 of each other whatever the corpus, so their counts fit a task, and a
    score's rank starts after the counts of those above it. Only rows of one score are sorted together; the random part spreads
    even equal texts over thousands of scores.
    """
    can = F.col("n_features") >= 2 * least_words - 1
    levels = scored.filter(can).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    levels = levels.select("score", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("above"), "n")
    levels = Scratch(scored.sparkSession, "resampling").store(levels, "levels")
    n_drawn = percent * (levels.agg(F.sum("n")).first()[0] or 0) // 100
    lowest = levels.filter(F.col("above") < n_drawn).agg(F.min("score")).first()[0]
    none = F.lit(None).cast("long")
    if lowest is None:
        return scored.withColumn("rank", none)
    in_level = Window.partitionBy("score").orderBy("doc_id", "n_features", "weight")
    high = scored.filter(can & (F.col("score") >= lowest)).join(levels.select("score", "above"), "score")
    high = high.withColumn("rank", F.col("above") + F.row_number().over(in_level))
    high = high.withColumn("rank", F.when(F.col("rank") <= n_drawn, F.col("rank"))).drop("above")
    low = scored.filter(~can | (F.col("score") < lowest)).withColumn("rank", none)
    return low.unionByName(high)


def resample(
    docs: DataFrame,
    target: DataFrame,
    n_buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Draw documents whose words look like those of ``target``: per row doc_id, n_features, weight, score, rank.

    The weight is the mean gain of a document's features (see :func:`gains`), the score adds Gumbel noise that follows from
    the doc_id, and the ``percent`` highest scores of the documents with ``least_words`` words are drawn, which samples without
    replacement in proportion to the exponential of weights. All counts are over all rows.

    The texts are scanned once; their features are stored in the shared folder, counted, and scored from there.

    Defined cases: NULL and empty texts, and texts without a word, have no features, weight 0 and no rank. A NULL doc_id counts as
    an empty one. Rows that share a doc_id are documents of their own with the same noise; where their scores tie too, fewer
    features go first. An empty ``docs`` gives no rows; an empty ``target`` gives gains of the corpus alone. Other columns
    are not looked at, whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "resampling")
    features = scratch.store(word_features(docs, n_buckets, text, doc_id), "features")
    wanted = bucket_counts(word_features(target.select(F.col(text).alias("text"), F.lit(0).alias("doc_id")), n_buckets), n_buckets)
    gain = gains(bucket_counts(features, n_buckets), wanted)
    kind = features.schema["doc_id"].dataType.simpleString()
    scored = features.mapInArrow(_scored(gain, seed), f"doc_id {kind}, n_features long, weight long, score long")
    scored = scratch.store(scored, "scored")
    scratch.drop("features")
    return _ranked(scored, least_words, percent)
