"""Near-duplicate embeddings: Euclidean p-stable hashing, then exact cosines within buckets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelwright.llm.common import Scratch
from funnelwright.llm.graph import components
from funnelwright.llm.tiles import each_tile, smallest_reachable

# A pair of cosine 0.93 (distance 0.374) shares a bucket in at least one table with probability 0.994, one of cosine
# 0.96 with 0.9999; an unrelated pair (distance 1.41) with 0.002.
TABLES, PROJECTIONS, CELL = 48, 18, 2.5
COSINE = 0.93
BLOCK = 256  # rows of a bucket that are compared at once with as many others


def _unit(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Vectors at length 1 in double precision, NULL where they cannot be compared, and a hash of (label, vector)."""
    for part in parts:
        units, lows, highs = [], [], []
        for vector, label in zip(part["vector"], part["label"], strict=True):
            unit, low, high = None, None, None
            if vector is not None and label is not None and len(vector) and not any(x is None for x in vector):
                row = np.asarray(vector, np.float64)
                top = np.abs(row).max()
                if np.isfinite(row).all() and top > 0:
                    row = row / top  # so that squares neither overflow nor vanish
                    unit = row / np.sqrt(row @ row)
                    digest = xxhash.xxh128_intdigest(label.encode() + b"\0" + unit.tobytes())
                    low, high = (digest & (2**64 - 1)) - 2**63, (digest >> 64) - 2**63
            units.append(unit)
            lows.append(low)
            highs.append(high)
        yield pd.DataFrame(
            {"vec_id": part["vec_id"], "label": part["label"], "unit": units, "low": pd.array(lows, "Int64"), "high": pd.array(highs, "Int64")}
        )


def _keyed(tables: int, projections: int, cell: float, seed: int):
    """A bucket number per table: the cells of ``projections`` random directions with random offsets, hashed."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        drawn: dict[int, tuple] = {}
        for part in parts:
            keys = [None] * len(part)
            widths = part["unit"].map(len).to_numpy()
            for width in np.unique(widths):
                if width not in drawn:
                    draw = np.random.default_rng([seed, int(width)])
                    drawn[width] = draw.standard_normal((width, tables * projections)), draw.uniform(0, cell, tables * projections)
                directions, offsets = drawn[width]
                own = np.flatnonzero(widths == width)
                units = np.stack([part["unit"].iloc[i] for i in own])
                cells = np.floor((units @ directions + offsets) / cell).astype(np.int64).reshape(len(own), tables, projections)
                for row, i in enumerate(own):
                    head = f"{part['label'].iloc[i]}\0{width}\0".encode()
                    keys[i] = [xxhash.xxh3_64_intdigest(head + cells[row, t].tobytes(), t) - 2**63 for t in range(tables)]
            yield part.assign(keys=keys)

    return run


def _tile_links(cosine: float):
    """Links within tiles. Rows come sorted by tile; a tile has two blocks at most, and is the only thing held.

    A pair counts in the first table that has it in one bucket only. Per class with links: the weight of its partners,
    and the smallest class that links within this tile lead to.
    """

    def links(ids, sides, tables, units, weights, keys):
        cross = sides.min() != sides.max()
        one = np.flatnonzero(sides == sides.min())
        other = np.flatnonzero(sides == sides.max())
        a, b = np.nonzero(units[one] @ units[other].T >= cosine)
        a, b = one[a], other[b]
        if not cross:
            a, b = a[a < b], b[a < b]
        table = int(tables[0])
        if table and len(a):
            first = np.concatenate([(keys[a[s : s + 50_000], :table] != keys[b[s : s + 50_000], :table]).all(axis=1) for s in range(0, len(a), 50_000)])
            a, b = a[first], b[first]
        if not len(a):
            return None
        partners = np.bincount(a, weights[b], len(ids)) + np.bincount(b, weights[a], len(ids))
        roots = smallest_reachable(ids, a, b)
        linked = np.flatnonzero(partners)
        return pd.DataFrame({"cid": ids[linked], "links": partners[linked].astype(np.int64), "root": roots[linked]})

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in each_tile(parts):
            if len(rows) > 1:
                ids, sides, tables, weights = (rows[c].to_numpy() for c in ("cid", "side", "table", "weight"))
                found = links(ids, sides, tables, np.stack(rows["unit"].to_numpy()), weights, np.stack(rows["keys"].to_numpy()))
                if found is not None:
                    yield found

    return run


def near_vectors(
    vectors: DataFrame,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    label: str = "label",
    cosine: float = COSINE,
    tables: int = TABLES,
    projections: int = PROJECTIONS,
    cell: float = CELL,
    seed: int = 7,
) -> DataFrame:
    """Links between vectors of one label that share a bucket and have a cosine of at least ``cosine``.

    One row per row of ``vectors``: vec_id, n_links (other vectors linked directly), component_id (the smallest vec_id
    reachable by links) and kept. Equal vectors become one class with a weight before anything else. A large bucket is
    cut into blocks, and every two blocks are compared by a task of their own; pairs are counted there and never
    written out. The work is that of the real links plus few false candidates; n near copies have n * n / 2 links.

    Defined cases: vectors that are NULL, empty, zero, or hold NULL or non-finite components, and rows without label or
    vec_id, link with nothing: n_links 0, component_id vec_id, kept. Vectors of different lengths are not compared.
    Rows that share a vec_id are one vector with several places, but each counts as a link. Extra columns are ignored.
    """
    scratch = Scratch(vectors.sparkSession, "vectors")
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector")
    )
    rows = rows.withColumn("usable", F.col("vec_id").isNotNull())
    schema = "vec_id long, label string, unit array<double>, low long, high long"
    usable = scratch.store(rows.filter("usable").drop("usable").mapInPandas(_unit, schema), "units")
    classes = usable.filter("unit IS NOT NULL").groupBy("low", "high", "label", "unit")
    classes = classes.agg(F.min("vec_id").alias("cid"), F.count("*").alias("weight"))
    keyed = classes.mapInPandas(
        _keyed(tables, projections, cell, seed), "low long, high long, label string, unit array<double>, cid long, weight long, keys array<long>"
    )
    keyed = scratch.store(keyed, "classes")
    members = keyed.select("low", "high", F.posexplode("keys").alias("table", "key"))
    buckets = members.groupBy("table", "key").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = members.join(buckets, ["table", "key"]).withColumn("blocks", blocks)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("low", "high"), F.col("blocks")).cast("int"))
    tiles = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.select(
        "low", "high", "table", F.col("block").alias("side"),
        F.xxhash64("table", "key", F.least("block", "other"), F.greatest("block", "other")).alias("tile"),
    )
    full = tiles.join(keyed.select("low", "high", "cid", "unit", "weight", "keys"), ["low", "high"])
    full = full.select("tile", "side", "table", "cid", "unit", "weight", "keys").repartition("tile").sortWithinPartitions("tile", "cid")
    links = scratch.store(full.mapInPandas(_tile_links(cosine), "cid long, links long, root long"), "links")
    groups = components(links.select(F.col("cid").alias("src"), F.col("root").alias("dst")), scratch)
    counted = links.groupBy("cid").agg(F.sum("links").alias("links"))
    named = keyed.select("low", "high", "cid", "weight").join(counted, "cid", "left")
    named = named.join(groups, F.col("cid") == F.col("node"), "left")
    named = named.select("low", "high", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "cid").alias("component_id"))
    found = usable.select("vec_id", "low", "high").join(named, ["low", "high"], "left")
    found = found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    nameless = rows.filter("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.union(nameless).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
