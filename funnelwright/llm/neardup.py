"""Near-duplicate documents: fast similarity sketches, banding, and confirmation on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelwright.llm.common import Scratch
from funnelwright.llm.graph import components
from funnelwright.llm.tiles import common_items, each_tile, smallest_reachable

# 30 bands of 4 coordinates find a pair of similarity 0.8 with probability 1 - 1.4e-7.
BANDS, ROWS = 30, 4
SIMILAR = 80  # percent
WIDTH = 5  # words in a shingle
BLOCK_ROWS, BLOCK_SHINGLES = 1_024, 1_000_000  # of a large bucket, that are compared at once with as many others

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31, _S32 = (np.uint64(n) for n in (30, 27, 31, 32))
_LOW = np.uint64(0xFFFFFFFF)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits depend on all input bits (the finalizer of splitmix64)."""
    x = (x ^ (x >> _S30)) * _B
    x = (x ^ (x >> _S27)) * _C
    return x ^ (x >> _S31)


def shingle_hashes(data: bytes | None, width: int, known: dict[bytes, int]) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the shingles of a text given in UTF-8.

    ``known`` remembers hashes of words; it is emptied at 200,000 words.
    """
    tokens = data.lower().split() if data else []
    if not tokens:
        return np.empty(0, np.uint64)
    if len(known) > 200_000:
        known.clear()
    hashes = np.empty(len(tokens), np.uint64)
    for i, token in enumerate(tokens):
        value = known.get(token)
        if value is None:
            value = known[token] = xxhash.xxh64_intdigest(token)
        hashes[i] = value
    size = min(width, len(tokens))
    ways = len(tokens) - size + 1
    out = np.full(ways, size, np.uint64)
    for offset in range(size):
        out = mixed(out * _A + hashes[offset : offset + ways])
    return np.unique(out)


def sketch(items: np.ndarray, size: int) -> np.ndarray:
    """Fast similarity sketch of a non-empty set: two sets agree in a coordinate with the probability of their Jaccard.

    In round i < ``size`` each item falls into a random bin with the value (i, random); in round ``size`` + j every item
    falls into bin j. A bin keeps its least value, so later rounds only fill bins that are still empty, and after
    2 * ``size`` rounds every bin is full. Sets of more than ``size`` * ln(``size``) items need a round or two.
    """
    bins = np.full(size, np.uint64(0xFFFFFFFFFFFFFFFF))
    step = max(1, int(size * (np.log(size) + 1) / len(items)) + 1)
    done = 0
    while done < size:
        rounds = np.arange(done, min(size, done + step), dtype=np.uint64)[:, None]
        drawn = mixed(items[None, :] ^ mixed(rounds * _A + _C))
        where = ((drawn >> _S32) * np.uint64(size)) >> _S32
        np.minimum.at(bins, where.ravel().astype(np.int64), ((rounds << _S32) | (drawn & _LOW)).ravel())
        done += len(rounds)
        if bins.max() != np.uint64(0xFFFFFFFFFFFFFFFF):
            return bins
    for j in np.flatnonzero(bins == np.uint64(0xFFFFFFFFFFFFFFFF)):
        turn = np.uint64(size + int(j))
        drawn = mixed(items ^ mixed(turn * _A + _C)) & _LOW
        bins[j] = (turn << _S32) | drawn.min()
    return bins


def band_keys(bins: np.ndarray, rows: int) -> np.ndarray:
    """One key per band of ``rows`` coordinates; the same coordinates in another band give another key."""
    bands = bins.reshape(-1, rows)
    out = np.arange(len(bands), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for column in range(rows):
            out = mixed(out * _A + bands[:, column])
    return out.view(np.int64)


def _sketches(width: int, bands: int, rows: int):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, int] = {}
        with np.errstate(over="ignore"):
            for part in parts:
                sizes, low, high, keys = [], [], [], []
                for data in part["data"]:
                    items = shingle_hashes(data, width, known)
                    digest = xxhash.xxh128_intdigest(items.tobytes())
                    sizes.append(len(items))
                    low.append((digest & (2**64 - 1)) - 2**63)
                    high.append((digest >> 64) - 2**63)
                    keys.append(band_keys(sketch(items, bands * rows), rows) if len(items) else np.empty(0, np.int64))
                yield pd.DataFrame({"doc_id": part["doc_id"], "n_shingles": sizes, "low": low, "high": high, "bands": keys})

    return run


def _confirm(width: int):
    """Exact intersection and union of the shingle sets of two texts, for rows (src, dst, src_data, dst_data)."""

    def grams(data: bytes) -> frozenset:
        tokens = data.lower().split()
        size = min(width, len(tokens))
        return frozenset(zip(*(tokens[i:] for i in range(size)), strict=False))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, held = None, frozenset()
        for part in parts:
            both, either = [], []
            for one, other in zip(part["src_data"], part["dst_data"], strict=True):
                if one is not last and one != last:
                    last, held = one, grams(one)
                mine = grams(other)
                common = len(held & mine)
                both.append(common)
                either.append(len(held) + len(mine) - common)
            yield pd.DataFrame({"src": part["src"], "dst": part["dst"], "both": both, "either": either})

    return run


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The different texts of the documents in ``ids`` (doc_id)."""
    return docs.join(ids, "doc_id", "left_semi").groupBy("doc_id", "data").agg(F.lit(1).alias("_one")).drop("_one")


def _blocks(rows: Column, shingles: Column) -> Column:
    """In how many blocks to cut rows, so that a block has at most about a thousand rows and a million shingles."""
    return F.greatest(F.lit(1), F.ceil(F.greatest(rows / BLOCK_ROWS, F.coalesce(shingles, F.lit(0)) / BLOCK_SHINGLES))).cast("int")


def _tile_links(width: int, similar: int):
    """Links of the rows that ask with the others of their tile, as links of each row with the smallest one reachable."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, int] = {}
        for rows in each_tile(parts):
            asks = np.flatnonzero(rows["asks"].to_numpy(bool))
            others = np.flatnonzero(~rows["asks"].to_numpy(bool))
            if not len(asks) or not len(others):
                continue
            with np.errstate(over="ignore"):
                sets = [shingle_hashes(data, width, known) for data in rows["data"]]
            sizes = np.array([len(s) for s in sets])
            common = common_items(sets, asks, others)
            either = sizes[asks][:, None] + sizes[others][None, :] - common
            ids, groups = rows["rep"].to_numpy(), rows["component"].to_numpy()
            linked = (100 * common >= similar * either) & (groups[asks][:, None] != groups[others][None, :])
            a, b = np.nonzero(linked)
            if len(a):
                roots = smallest_reachable(ids, asks[a], others[b])
                moved = np.flatnonzero(roots != ids)
                yield pd.DataFrame({"src": ids[moved], "dst": roots[moved]}).drop_duplicates()

    return run


def _compared(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``pairs`` (src, dst) with the exact sizes of intersection and union: of two documents with several texts, those of
    the most similar ones."""
    heads = texts.select(F.col("doc_id").alias("src"), F.col("data").alias("src_data"))
    tails = texts.select(F.col("doc_id").alias("dst"), F.col("data").alias("dst_data"))
    joined = pairs.join(tails, "dst").join(heads, "src").select("src", "dst", "src_data", "dst_data")
    compared = joined.mapInPandas(_confirm(width), "src long, dst long, both long, either long")
    best = F.max(F.struct((F.col("both") / F.col("either")).alias("s"), "both", "either")).alias("best")
    return compared.groupBy("src", "dst").agg(best).select("src", "dst", "best.both", "best.either")


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    width: int = WIDTH,
    similar: int = SIMILAR,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of at least ``similar`` percent of their word shingles.

    A-Z is lower-cased; a text of fewer than ``width`` words is one shingle. Returns one row per row of ``docs``:
    doc_id, n_shingles, component_id (the smallest doc_id reachable by links, itself included) and kept.

    * Documents with the same set become one class, named by its smallest doc_id, before anything else. Copies never
      meet in pairs.
    * Classes that agree in a band share a bucket. Each is compared exactly with the smallest class of the bucket, its
      hub; so a bucket of m near copies costs m comparisons.
    * Classes that this did not join with their hub are compared with all other members of the bucket but the hub, if
      these are of different groups by then. This is done in tiles of two blocks of rows: pairs are counted inside a
      task, and what comes out is at most a row per row of the tile. So no link between bucket mates is lost, whatever
      the bucket's size, and no pairs are written.

    Defined cases: NULL, empty or blank text has n_shingles 0 and links with nothing. A row without doc_id links with
    nothing, has component_id NULL and is kept. Rows that share a doc_id are one document with several texts. Extra
    columns are ignored. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("data"))
    schema = "doc_id long, n_shingles long, low long, high long, bands array<long>"
    sketches = scratch.store(docs.mapInPandas(_sketches(width, bands, rows), schema), "sketches")
    usable = sketches.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("low", "high", "n_shingles", "bands").agg(F.min("doc_id").alias("rep"))
    members = classes.select("rep", "n_shingles", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).filter("hub != last")
    shared = scratch.store(members.join(buckets.drop("last"), "key"), "buckets")

    tested = shared.filter("rep != hub").select(F.col("hub").alias("src"), F.col("rep").alias("dst")).distinct()
    texts = scratch.store(_texts(docs, shared.select(F.col("rep").alias("doc_id")).distinct()), "texts")
    tested = scratch.store(_compared(tested, texts, width), "stars")
    is_link = F.col("both") * 100 >= F.col("either") * similar
    groups = scratch.store(components(tested.filter(is_link), scratch, "first"), "groups")

    # What is left: bucket mates in different groups, neither of which is the hub.
    group_of = groups.select(F.col("node").alias("rep"), "component")
    hub_group = groups.select(F.col("node").alias("hub"), F.col("component").alias("hub_component"))
    mates = shared.filter("rep != hub").join(group_of, "rep", "left").join(hub_group, "hub", "left")
    mates = mates.select(
        "key", "rep", "n_shingles", F.coalesce("component", "rep").alias("component"),
        (F.coalesce("component", "rep") != F.coalesce("hub_component", "hub")).alias("outside"),
    )
    mates = scratch.store(mates, "mates")
    scratch.drop("buckets")
    scratch.drop("stars")
    mixed_buckets = mates.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        _blocks(F.count("*"), F.sum("n_shingles")).alias("blocks"),
        _blocks(F.count_if("outside"), F.sum(F.when(F.col("outside"), F.col("n_shingles")))).alias("outside_blocks"),
    )
    mixed_buckets = mixed_buckets.filter("low != high").drop("low", "high")
    tiled = mates.join(mixed_buckets, "key")
    of = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    tile = lambda i, j: F.xxhash64("key", i, j).alias("tile")
    rows = tiled.select("*", F.explode(F.sequence(F.lit(0), F.col("outside_blocks") - 1)).alias("other"))
    rows = rows.select("rep", "component", F.lit(False).alias("asks"), tile(F.col("other"), of(F.col("blocks"))))
    asks = tiled.filter("outside").select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    asks = asks.select("rep", "component", F.lit(True).alias("asks"), tile(of(F.col("outside_blocks")), F.col("other")))
    rows = scratch.store(rows.union(asks), "tiles")
    full = rows.join(texts, F.col("rep") == F.col("doc_id")).drop("doc_id")
    full = full.repartition("tile").sortWithinPartitions("tile", "rep")
    more = scratch.store(full.mapInPandas(_tile_links(width, similar), "src long, dst long"), "rest")
    for table in ("mates", "tiles", "texts"):
        scratch.drop(table)
    if not more.isEmpty():
        both = more.union(groups.select("component", "node"))
        groups = scratch.store(components(both, scratch, "second"), "all-groups")

    named = classes.join(groups, F.col("rep") == F.col("node"), "left")
    named = named.select("low", "high", F.coalesce("component", "rep").alias("component_id"))
    found = sketches.withColumn("usable", F.expr("n_shingles > 0 AND doc_id IS NOT NULL")).drop("bands")
    found = found.join(named.withColumn("usable", F.lit(True)), ["low", "high", "usable"], "left")
    component = F.coalesce("component_id", "doc_id")
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **settings) -> DataFrame:
    """``docs`` with one document of each group of ``near_duplicates``, the one of the smallest doc_id.

    Rows without doc_id stay. Of several rows that share a kept doc_id, all stay.
    """
    gone = near_duplicates(docs, text, doc_id, **settings).filter("NOT kept").select(F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs[doc_id] == gone["_gone"], "left_anti")
