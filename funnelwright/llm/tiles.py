"""Groups that are compared in tiles: two blocks of rows at a time, whatever the size of a group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd


def each_tile(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of one tile at a time, of rows that come sorted by ``tile``. A tile is all that is held."""
    rest = None
    for part in parts:
        rest = part if rest is None else pd.concat([rest, part], ignore_index=True)
        names = rest["tile"].to_numpy()
        cuts = np.flatnonzero(names[1:] != names[:-1]) + 1
        for start, end in zip([0, *cuts[:-1]], cuts, strict=True) if len(cuts) else ():
            yield rest.iloc[start:end]
        if len(cuts):
            rest = rest.iloc[cuts[-1] :].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest


def smallest_reachable(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per row the smallest of ``ids`` reachable by the links between rows ``a`` and rows ``b``."""
    order = np.argsort(ids, kind="stable")
    root = np.empty(len(ids), np.int64)
    root[order] = np.arange(len(ids))
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[order[root]]
        if (root == before).all():
            return ids[order[root]]


def common_items(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets at ``first`` with those at ``second``.

    Items in few sets are counted pair by pair, the others by products of slices of the incidence matrix.
    """
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, item, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    out = np.zeros((len(sets), len(sets)), np.float32)
    few = (held[item] > 1) & (held[item] <= 12)
    order = np.argsort(item[few], kind="stable")
    few_item, few_row = item[few][order], row[few][order]
    for lag in range(1, 12):
        same = np.flatnonzero(few_item[lag:] == few_item[:-lag]) if lag < len(few_item) else np.empty(0, np.int64)
        one, other = few_row[same], few_row[same + lag]
        np.add.at(out, (one, other), 1)
        np.add.at(out, (other, one), 1)
    out = out[np.ix_(first, second)]
    many = held[item] > 12
    number = np.full(len(held), -1)
    kept = np.flatnonzero(held > 12)
    number[kept] = np.arange(len(kept))
    column, many_row = number[item[many]], row[many]
    for start in range(0, len(kept), 4096):
        own = (column >= start) & (column < start + 4096)
        part = np.zeros((len(sets), min(4096, len(kept) - start)), np.float32)
        part[many_row[own], column[own] - start] = 1
        out += part[first] @ part[second].T
    return out
