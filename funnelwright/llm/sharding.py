"""Shards of nearly equal bytes by histogram sort. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelwright.functions import quoted
from funnelwright.llm.common import Scratch

SHARDS = 40
OVERHEAD = 16  # bytes of a document besides its text
_BITS = 60  # of each of the two parts of a key
_PROBE_BITS = 10  # of a key that a round looks at: 1,023 probes between the boundaries of each interval


def _sixty_bits(value: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(value, F.lit(""))), 1, 15), 16, 10).cast("long")


def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``docs`` with _size and its sort key: a hash of the text, then one of doc_id, so that equal texts are neighbours."""
    return docs.withColumns(
        {
            "_size": F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + OVERHEAD,
            "_high": _sixty_bits(F.col(text)),
            "_low": _sixty_bits(F.col(doc_id).cast("string")),
        }
    )


class Splitter:
    """The boundary in front of a shard: the first key (high, low) of it, and of how many rows of this key it is not."""

    def __init__(self, high: int, low: int, copies: int):
        self.high, self.low, self.copies = high, low, copies


def find_splitters(units: DataFrame, shards: int, tolerance: float, scratch: Scratch) -> list[Splitter]:
    """``shards`` - 1 boundaries between keys of ``units`` (_high, _low, _size, n) that share the bytes out evenly.

    Each boundary is wanted where a multiple of total / ``shards`` bytes lies below. All of them are searched at once: a
    round counts the exact bytes below evenly spaced probes within the interval that each boundary is known to lie in,
    by a sum per probe that all partitions contribute to. The interval shrinks to that between two probes, until a
    probe is off by at most ``tolerance`` of a shard or the interval holds one key only. A round reads the two-column
    table of keys, of which all but the first few rounds' rows are filtered out by their intervals, and gives the driver
    at most ``shards`` * 1,024 sums. Keys are hashes, so 256 thousand documents take three rounds, and thirty
    thousand million five; a text with many copies takes as many more as it takes to tell their doc_ids apart.
    """
    total = units.agg(F.sum(F.col("_size") * F.col("n"))).first()[0] or 0
    found: dict[int, Splitter] = {}
    # Boundary -> (bits known of the key, these bits of its parts, bytes below the interval)
    open_goals = {j: (0, 0, 0, 0) for j in range(1, shards)}
    while open_goals and total:
        intervals = {state[:3]: state[3] for state in open_goals.values()}
        sums = _probe(units, list(intervals))
        bins: dict[tuple, list] = {}
        for row in sums:
            bins.setdefault((row["bits"], row["high"], row["low"]), []).append(row)
        still = {}
        for j, state in open_goals.items():
            below = state[3]
            wanted = j * total  # in bytes * shards
            rows = sorted(bins[state[:3]], key=lambda r: r["bin"])
            for place, row in enumerate(rows):
                if (below + row["bytes"]) * shards > wanted or place == len(rows) - 1:
                    break
                below += row["bytes"]
            bits, high, low = _deeper(state[:3], row["bin"])
            slack = tolerance * total
            if wanted - below * shards <= slack:
                found[j] = Splitter(*_edge(bits, high, low), 0)
            elif (below + row["bytes"]) * shards - wanted <= slack:
                found[j] = Splitter(*_edge(bits, high, low, after=True), 0)
            elif row["units"] == 1:
                short = -((below * shards - wanted) // (row["size"] * shards))
                found[j] = Splitter(row["one_high"], row["one_low"], min(row["copies"], short))
            else:
                still[j] = (bits, high, low, below)
        open_goals = still
    return [found[j] for j in sorted(found)]


def _probe(units: DataFrame, intervals: list[tuple[int, int, int]]):
    """Sums between the probes of each interval. An interval is told by its number of bits and the bits of both parts."""
    spark = units.sparkSession
    parts = []
    for bits in sorted({i[0] for i in intervals}):
        own = [i for i in intervals if i[0] == bits]
        # From literals: a frame made of Python's values would be read by Python workers.
        known_bits = F.array(*[F.struct(F.lit(i[1]).cast("long").alias("high"), F.lit(i[2]).cast("long").alias("low")) for i in own])
        table = spark.range(1).select(F.inline(known_bits))
        shift = _BITS - bits if bits < _BITS else 2 * _BITS - bits
        if bits < _BITS:
            known = [F.shiftright("_high", shift).alias("high"), F.lit(0).cast("long").alias("low")]
            step = F.shiftright("_high", shift - _PROBE_BITS)
        else:
            known = [F.col("_high").alias("high"), F.shiftright("_low", shift).alias("low")]
            step = F.shiftright("_low", shift - _PROBE_BITS)
        mine = units.select("*", *known, step.bitwiseAND((1 << _PROBE_BITS) - 1).alias("bin"))
        mine = mine.join(F.broadcast(table), ["high", "low"])  # at most one row per shard
        parts.append(mine.withColumn("bits", F.lit(bits)))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    return (
        rows.groupBy("bits", "high", "low", "bin")
        .agg(
            F.sum(F.col("_size") * F.col("n")).alias("bytes"), F.count("*").alias("units"), F.max("n").alias("copies"),
            F.max("_size").alias("size"), F.max("_high").alias("one_high"), F.max("_low").alias("one_low"),
        )
        .collect()
    )


def _deeper(interval: tuple[int, int, int], place: int) -> tuple[int, int, int]:
    bits, high, low = interval
    if bits < _BITS:
        return bits + _PROBE_BITS, (high << _PROBE_BITS) | place, 0
    return bits + _PROBE_BITS, high, (low << _PROBE_BITS) | place


def _edge(bits: int, high: int, low: int, after: bool = False) -> tuple[int, int]:
    """The first key of an interval, or the first behind it."""
    key = (high << (_BITS - bits)) << _BITS if bits <= _BITS else (high << _BITS) | (low << (2 * _BITS - bits))
    key += (1 << (2 * _BITS - bits)) if after else 0
    return key >> _BITS, key & ((1 << _BITS) - 1)


def _shard_of(splitters: list[Splitter], copy: Column) -> Column:
    """The number of boundaries at or below a row."""
    if not splitters:
        return F.lit(0)
    at = F.struct(F.col("_high").alias("a"), F.col("_low").alias("b"), copy.cast("long").alias("c"))
    kind = T.StructType([T.StructField(x, T.LongType(), False) for x in "abc"])
    bounds = F.array(*[F.struct(F.lit(s.high).cast("long").alias("a"), F.lit(s.low).cast("long").alias("b"), F.lit(s.copies).cast("long").alias("c")) for s in splitters])
    return F.size(F.filter(bounds.cast(T.ArrayType(kind, False)), lambda s: s <= at)).cast("int")


def _units(keyed: DataFrame) -> DataFrame:
    """A row per key: rows of one text and doc_id are counted before they move."""
    return keyed.groupBy("_high", "_low").agg(F.count("*").alias("n"), F.max("_size").alias("_size"))


def shard_table(docs: DataFrame, shards: int = SHARDS, tolerance: float = 0.0, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Where each row of ``docs`` goes: doc_id, size, text_crc32, law ("bytes"), shard, slot, grown_shard (NULL).

    Rows are ordered by a hash of the text and one of doc_id and cut by ``find_splitters``; with ``tolerance`` 0 a shard
    holds its share of bytes to a document. A row belongs to the shard in which it begins. One exchange by ranges
    of (shard, key) then puts the rows in order; a slot is a row's place in its shard: its place among the shard's rows
    in its task, plus the rows of the tasks before. So neither a shard nor a text with many copies has to fit a task.

    Defined cases: a NULL text has size 16 and the checksum of the empty text, 0. Rows that agree in text and doc_id
    are neighbours and told apart by their order, which is arbitrary, as they are equal. More shards than documents
    leave shards empty. Extra columns are ignored. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "shards")
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    keyed = _keyed(own, "text", "doc_id").withColumn("_crc", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))).drop("text")
    units = keyed.groupBy("_high", "_low").agg(
        F.count("*").alias("n"), F.max("_size").alias("_size"), F.max("_crc").alias("_crc"), F.max("doc_id").alias("doc_id")
    )
    units = scratch.store(units, "units")
    splitters = find_splitters(units, shards, tolerance, scratch)
    rows = units.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    rows = rows.withColumn("shard", _shard_of(splitters, F.col("_copy")))
    order = ("shard", "_high", "_low", "_copy")
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.select("doc_id", F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), "shard", F.monotonically_increasing_id().alias("_place"))
    ordered = scratch.store(ordered.withColumn("_task", F.shiftright("_place", 33)), "ordered")
    held = ordered.groupBy("shard", "_task").agg(F.count("*").alias("_held"), F.min("_place").alias("_first"))
    before = Window.partitionBy("shard").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("shard", "_task", (F.coalesce(F.sum("_held").over(before), F.lit(0)) - F.col("_first")).alias("_start"))
    return ordered.join(starts, ["shard", "_task"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_place") + F.col("_start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, tolerance: float = 0.0, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with ``shard`` (an existing one is replaced), exchanged once, in order of (shard, key) within tasks.

    Copies of a row that agree in text and doc_id go to the shard of the first of them. Other columns, of any name, stay as they
    are; see ``shard_table`` for NULLs, ties and empty tables.
    """
    scratch = Scratch(docs.sparkSession, "shards")
    columns = [quoted(c) for c in docs.columns if c != "shard"]
    boxed = docs.select(F.struct(*columns).alias("_row"), F.col(text).alias("text"), F.col(doc_id).alias("doc_id"))
    keyed = _keyed(boxed, "text", "doc_id").drop("text", "doc_id")
    units = scratch.store(_units(keyed.select("_high", "_low", "_size")), "units")
    splitters = find_splitters(units, shards, tolerance, scratch)
    placed = keyed.withColumn("shard", _shard_of(splitters, F.lit(0)))
    return placed.repartitionByRange("shard", "_high", "_low").sortWithinPartitions("shard", "_high", "_low").select("_row.*", "shard")
