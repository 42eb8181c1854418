"""Removal of lines that several documents share, kept reversible by exact reference counts and cuckoo filters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelwright.llm.common import Scratch

SHORTEST = 10  # code points of a line that counts
KEYS_PER_SHARD = 1_000_000  # a full shard's filter has 2 to 4 MB
SENT_FILTERS = 64_000_000  # bytes of all filters up to which they go to every task; beyond, lines go to their filters
LINES_PER_FILTER = 5_000_000  # that one copy of a filter looks up, where lines go to filters
KEY = ("low", "high")

_SLOTS = 4


class Cuckoo:
    """A cuckoo filter of 16-bit fingerprints in buckets of four, for 64-bit hashes. Takes and gives up many at once.

    An item lies in one of two buckets, each of which follows from the other and the fingerprint; so an item can be
    moved, and taken out, without knowing its hash. 0 marks a free cell. Numpy arrays inside, bytes outside.
    """

    def __init__(self, cells: np.ndarray):
        self.cells = cells

    @classmethod
    def for_items(cls, n: int) -> Cuckoo:
        buckets = 1 << max(1, int(np.ceil(np.log2(max(1, n) / (_SLOTS * 0.8)))))
        return cls(np.zeros((buckets, _SLOTS), np.uint16))

    @classmethod
    def from_bytes(cls, data: bytes) -> Cuckoo:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, _SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.cells.tobytes()

    def _place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes = hashes.astype(np.int64).view(np.uint64)
        prints = ((hashes >> np.uint64(48)) % np.uint64(65_535) + np.uint64(1)).astype(np.uint16)
        return prints, (hashes & np.uint64(len(self.cells) - 1)).astype(np.int64)

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        jump = (prints.astype(np.uint64) * np.uint64(0x5BD1E995)) >> np.uint64(3)
        return bucket ^ (jump & np.uint64(len(self.cells) - 1)).astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, bucket = self._place(hashes)
        found = (self.cells[bucket] == prints[:, None]).any(axis=1)
        return found | (self.cells[self._other(bucket, prints)] == prints[:, None]).any(axis=1)

    def insert(self, hashes: np.ndarray) -> bool:
        """Put the items in; False if the filter is too full for them and has to be built anew, larger."""
        prints, bucket = self._place(hashes)
        draw = np.random.default_rng(len(self.cells))
        for turn in range(200):
            if not len(prints):
                return True
            order = np.argsort(bucket, kind="stable")
            prints, bucket = prints[order], bucket[order]
            used, start, group = np.unique(bucket, return_index=True, return_inverse=True)
            rank = np.arange(len(bucket)) - start[group]
            taken = self.cells[used] != 0
            slots = np.argsort(taken, axis=1, kind="stable")
            free = _SLOTS - taken.sum(axis=1)
            fits = rank < free[group]
            self.cells[bucket[fits], slots[group[fits], rank[fits]]] = prints[fits]
            if turn:  # the first item of a bucket that is full takes the place of another one
                pushes = np.flatnonzero(rank == free[group])
                slot = draw.integers(0, _SLOTS, len(pushes))
                victims = self.cells[bucket[pushes], slot]
                self.cells[bucket[pushes], slot] = prints[pushes]
                prints[pushes] = victims
            prints, bucket = prints[~fits], bucket[~fits]
            bucket = self._other(bucket, prints)
        return False

    def remove(self, hashes: np.ndarray) -> None:
        """Take items out that are in."""
        prints, bucket = self._place(hashes)
        for value, first, second in zip(prints, bucket, self._other(bucket, prints), strict=True):
            for place in (first, second):
                hit = np.flatnonzero(self.cells[place] == value)
                if len(hit):
                    self.cells[place, hit[0]] = 0
                    break


def _line_keys(data: bytes, shortest: int) -> list[bytes | None]:
    """Per line the digest of its key; None for a key that is too short to count."""
    out: list[bytes | None] = []
    for line in data.split(b"\n"):
        key = line.strip().lower()
        long_enough = len(key) >= 4 * shortest or len(key.decode("utf-8", "replace")) >= shortest
        out.append(xxhash.xxh3_128_digest(key) if long_enough else None)
    return out


def _references(shortest: int):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            digests, counts = [], []
            for data in part["data"]:
                own = set(_line_keys(data or b"", shortest)) - {None}
                digests.extend(own)
                counts.append(len(own))
            pairs = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pd.DataFrame({"low": pairs[:, 0], "high": pairs[:, 1], "doc_id": np.repeat(part["doc_id"].to_numpy(np.int64), counts)})

    return run


class LineIndex:
    """Which documents hold which lines: exact references, their counts, and a filter of the repeated lines per shard.

    * ``references`` (low, high, doc_id): a row per document and distinct key (a 128-bit hash of the line's key).
    * ``counts`` (low, high, n_docs, keeper): exact counts of the keys that at least two documents hold, and the
      smallest of these documents.
    * ``filters`` (shard, cells): cuckoo filters of the keys in ``counts``. They only save work: a line that no filter
      knows is not looked up. What a filter lets through is decided by ``counts``.

    ``insert`` and ``delete`` give a new index with new tables; the old one stays readable. Only keys of the documents
    that come or go are counted again, and filters take in or give up the keys that reach or lose two holders. So
    deleting documents leaves what building without them would. A filter that gets too full is built anew from
    ``counts``.
    """

    def __init__(self, references: DataFrame, counts: DataFrame, filters: DataFrame, shards: int, shortest: int):
        self.references, self.counts, self.filters = references, counts, filters
        self.shards, self.shortest = shards, shortest

    @classmethod
    def build(cls, docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shortest: int = SHORTEST) -> LineIndex:
        scratch = Scratch(docs.sparkSession, "lines")
        references = scratch.store(_documents_lines(docs, text, doc_id, shortest), "references")
        counts = scratch.store(_counted(references), "counts")
        shards = max(1, -(-counts.count() // KEYS_PER_SHARD))
        keys = counts.select(_shard(shards).alias("shard"), "low")
        filters = scratch.store(keys.groupBy("shard").applyInPandas(_built, "shard long, cells binary"), "filters")
        return cls(references, counts, filters, shards, shortest)

    def insert(self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> LineIndex:
        scratch = Scratch(docs.sparkSession, "lines")
        new = scratch.store(_documents_lines(docs, text, doc_id, self.shortest), "new")
        references = scratch.store(self.references.union(new).distinct(), "references")
        return self._recounted(references, new, scratch)

    def delete(self, ids: DataFrame, doc_id: str = "doc_id") -> LineIndex:
        """Forget the documents whose numbers are in ``ids``; numbers that the index doesn't hold change nothing."""
        scratch = Scratch(ids.sparkSession, "lines")
        ids = ids.select(F.col(doc_id).cast("long").alias("doc_id"))
        gone = scratch.store(self.references.join(ids, "doc_id", "left_semi").select(*KEY, "doc_id"), "gone")
        references = scratch.store(self.references.join(ids, "doc_id", "left_anti").select(*KEY, "doc_id"), "references")
        return self._recounted(references, gone, scratch)

    def _recounted(self, references: DataFrame, changed: DataFrame, scratch: Scratch) -> LineIndex:
        touched = changed.select(*KEY).distinct()
        again = _counted(references.join(touched, list(KEY), "left_semi"))
        counts = self.counts.join(touched, list(KEY), "left_anti").unionByName(again)
        counts = scratch.store(counts, "counts")
        shards = max(1, -(-counts.count() // KEYS_PER_SHARD))
        if shards > 2 * self.shards:  # so that no filter grows without end
            keys = counts.select(_shard(shards).alias("shard"), "low")
            filters = scratch.store(keys.groupBy("shard").applyInPandas(_built, "shard long, cells binary"), "filters")
            return LineIndex(references, counts, filters, shards, self.shortest)
        came = counts.join(self.counts, list(KEY), "left_anti").select(_shard(self.shards).alias("shard"), "low", F.lit(True).alias("came"))
        went = self.counts.join(counts, list(KEY), "left_anti").select(_shard(self.shards).alias("shard"), "low", F.lit(False).alias("came"))
        moves = came.union(went).groupBy("shard")
        moved = self.filters.groupBy("shard").cogroup(moves).applyInPandas(_updated, "shard long, cells binary")
        moved = scratch.store(moved, "moved")
        full = moved.filter("cells IS NULL").select("shard")
        keys = counts.select(_shard(self.shards).alias("shard"), "low").join(F.broadcast(full), "shard", "left_semi")
        rebuilt = keys.groupBy("shard").applyInPandas(_built, "shard long, cells binary")
        filters = scratch.store(moved.filter("cells IS NOT NULL").union(rebuilt), "filters")
        return LineIndex(references, counts, filters, self.shards, self.shortest)

    def surplus(self) -> DataFrame:
        """(``doc_id``, ``lows``, ``highs``): per document the keys whose lines it loses.

        Every reference is looked up in its shard's filter first: in its own task while all filters are small enough to be sent,
        else where the filters are.
        """
        size = self.filters.agg(F.sum(F.length("cells"))).first()[0] or 0
        if size <= SENT_FILTERS:
            spark = self.references.sparkSession
            cells = spark.sparkContext.broadcast({row.shard: bytes(row.cells) for row in self.filters.collect()})
            maybe = self.references.mapInPandas(_known(cells, self.shards), self.references.schema)
        else:
            maybe = self._known_where_filters_are()
        lost = maybe.join(self.counts, list(KEY)).filter("doc_id != keeper")
        return lost.groupBy("doc_id").agg(F.collect_list("low").alias("lows"), F.collect_list("high").alias("highs"))

    def _known_where_filters_are(self) -> DataFrame:
        """The references that filters know. References go to the tasks of their shards, several per shard where a line is
        frequent, each of which reads the shard's filter before them."""
        own = self.references.withColumn("shard", _shard(self.shards))
        parts = own.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / LINES_PER_FILTER).cast("int").alias("parts"))
        dealt = own.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
        filters = self.filters.join(parts, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        nothing = [F.lit(0).cast("long").alias(name) for name in (*KEY, "doc_id")]  # NULL would make pandas read doubles
        both = filters.select("shard", "part", F.lit(False).alias("is_line"), "cells", *nothing).union(
            dealt.select("shard", "part", F.lit(True), F.lit(None).cast("binary"), *KEY, "doc_id")
        )
        met = both.repartition("shard", "part").sortWithinPartitions("shard", "part", "is_line")
        return met.mapInPandas(_known_after_filter, self.references.schema)


def _documents_lines(docs: DataFrame, text: str, doc_id: str, shortest: int) -> DataFrame:
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("data"))
    return source.filter("doc_id IS NOT NULL").mapInPandas(_references(shortest), "low long, high long, doc_id long")


def _counted(references: DataFrame) -> DataFrame:
    counts = references.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("keeper"), F.max("doc_id").alias("_last"))
    return counts.filter("keeper != _last").drop("_last")


def _shard(shards: int):
    return F.pmod(F.shiftright("low", 20), F.lit(shards)).cast("long")


def _built(keys: pd.DataFrame) -> pd.DataFrame:
    n = len(keys)
    while True:
        table = Cuckoo.for_items(n)
        if table.insert(keys["low"].to_numpy()):
            return pd.DataFrame({"shard": [keys["shard"].iloc[0]], "cells": [table.to_bytes()]})
        n *= 2


def _updated(held: pd.DataFrame, moves: pd.DataFrame) -> pd.DataFrame:
    shard = (held if len(held) else moves)["shard"].iloc[0]
    if not len(held):  # a shard without a filter yet
        return pd.DataFrame({"shard": [shard], "cells": [None]})
    table = Cuckoo.from_bytes(held["cells"].iloc[0])
    came = moves["came"].to_numpy(bool)
    table.remove(moves["low"].to_numpy()[~came])
    fits = table.insert(moves["low"].to_numpy()[came])
    return pd.DataFrame({"shard": [shard], "cells": [table.to_bytes() if fits else None]})


def _known(cells, shards: int):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filters = {shard: Cuckoo.from_bytes(data) for shard, data in cells.value.items()}
        for part in parts:
            low = part["low"].to_numpy()
            shard = (low >> 20) % shards
            keep = np.zeros(len(part), bool)
            for number, held in filters.items():
                own = np.flatnonzero(shard == number)
                keep[own] = held.contains(low[own])
            yield part[keep]

    return run


def _known_after_filter(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines that the filter before them knows. A shard without filter has no repeated line; its lines are after another's filter."""
    held, shard = None, None
    for part in parts:
        low, shards = part["low"].to_numpy(), part["shard"].to_numpy()
        keep = np.zeros(len(part), bool)
        filters = np.flatnonzero(~part["is_line"].to_numpy(bool))
        for start, end in zip([0, *filters], [*filters, len(part)], strict=True):
            if len(filters) and start in filters and end > start:
                held, shard = Cuckoo.from_bytes(part["cells"].iloc[start]), shards[start]
                start += 1
            if held is not None and end > start:
                own = start + np.flatnonzero(shards[start:end] == shard)
                keep[own] = held.contains(low[own])
        yield part.loc[keep, ["low", "high", "doc_id"]]


def _rewriter(shortest: int):
    @F.pandas_udf("text string, n_lines long, n_dropped long")
    def rewrite(data: pd.Series, lows: pd.Series, highs: pd.Series) -> pd.DataFrame:
        texts, lines, dropped = [], [], []
        for one, low, high in zip(data, lows, highs, strict=True):
            one = one or b""
            n = one.count(b"\n") + 1
            gone = 0
            if low is not None:
                lost = {a.tobytes() for a in np.stack([np.asarray(low, np.int64), np.asarray(high, np.int64)], axis=1)}
                kept = [line for line, key in zip(one.split(b"\n"), _line_keys(one, shortest), strict=True) if key not in lost]
                gone = n - len(kept)
                one = b"\n".join(kept)
            texts.append(one.decode("utf-8", "replace"))
            lines.append(n)
            dropped.append(gone)
        return pd.DataFrame({"text": texts, "n_lines": lines, "n_dropped": dropped})

    return rewrite


def dedup_lines(docs: DataFrame, index: LineIndex | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with its text replaced by the lines that stay, and with n_lines (before) and n_dropped.

    A line's key is the line stripped of ASCII white space, A-Z lower-cased. Keys of at least ``shortest`` code points
    that at least two documents of ``index`` (of ``docs`` if none is given) hold lose all their lines but in the
    smallest such doc_id. Other lines stay, joined by line feeds.

    Defined cases: NULL text is one empty line. A row without doc_id keeps its lines and does not count as a holder.
    Rows that share a doc_id are one holder; each is rewritten. A line that occurs repeatedly in its keeper stays as
    often as it occurs. Extra columns of any name stay, except that existing n_lines and n_dropped are replaced.
    """
    index = index or LineIndex.build(docs, text, doc_id)
    lost = index.surplus().withColumnRenamed("doc_id", "lost_of")
    boxed = docs.select(F.struct("*").alias("row"), F.col(doc_id).cast("long").alias("holder"), F.col(text).cast("binary").alias("data"))
    joined = boxed.join(lost, F.col("holder") == F.col("lost_of"), "left")
    done = joined.select("row", _rewriter(index.shortest)("data", "lows", "highs").alias("done"))
    new = {text: F.col("done.text"), "n_lines": F.col("done.n_lines"), "n_dropped": F.col("done.n_dropped")}
    names = [*docs.columns, *[name for name in ("n_lines", "n_dropped") if name not in docs.columns]]
    return done.select([new.get(name, F.col("row")[name]).alias(name) for name in names])
