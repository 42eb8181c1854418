"""Document quality: random Fourier features of document statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelwright.llm.common import Scratch

FEATURES = 300  # random Fourier features
RIDGE = 1e-3  # per training row
BINS = 1_024  # of raw scores for the calibration
CALIBRATION_FOLD, FOLDS = 1, 4  # of the learning rows, by another hash
THRESHOLD = 0.3
_ALPHA = np.zeros(256, bool)
_ALPHA[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SENTENCE = re.compile(rb"[.!?](?=\s|$)")


def statistics(data: bytes | None) -> list[float]:
    """Numbers that describe a text given in UTF-8; whoever wrote it and where it comes from are not among them."""
    data = data or b""
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n = max(1, len(data))
    tokens = data.split()
    m = max(1, len(tokens))
    lines = data.split(b"\n")
    full = [line.strip() for line in lines if line.strip()]
    k = max(1, len(full))
    seen = Counter(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens)) if tokens else np.zeros(1, np.int64)
    pairs = len(set(zip(tokens, tokens[1:], strict=False)))
    triples = len(set(zip(tokens, tokens[1:], tokens[2:], strict=False)))
    heads = sum(1 for t in tokens if 65 <= t[0] <= 90)
    plain = sum(1 for t in tokens if t.isalpha())
    common = seen.most_common(3)
    return [
        np.log1p(len(data)),
        np.log1p(len(tokens)),
        np.log1p(len(full)),
        float(lengths.mean()),
        float(lengths.std()),
        counts[_ALPHA].sum() / n,
        counts[48:58].sum() / n,
        counts[65:91].sum() / n,
        (counts[46] + counts[33] + counts[63]) / m,
        counts[44] / m,
        (counts[35] + counts[37] + counts[42] + counts[36] + counts[38] + counts[64]) / m,
        (counts[124] + counts[60] + counts[62] + counts[91] + counts[93] + counts[123] + counts[125] + counts[95] + counts[61]) / m,
        counts[33] / m,
        (counts[9] + counts[32]) / n,
        len(seen) / m,
        len(seen) / np.sqrt(m),
        pairs / max(1, m - 1),
        triples / max(1, m - 2),
        common[0][1] / m if common else 0.0,
        sum(c for _, c in common) / m,
        heads / m,
        plain / m,
        sum(1 for t in tokens if t.isupper()) / m,
        len(set(full)) / k,
        float(np.mean([len(line) for line in full])) if full else 0.0,
        sum(1 for line in full if line[-1:] in b".!?\"'") / k,
        len(_SENTENCE.findall(data)) / m,
        sum(1 for line in full if len(line) < 30) / k,
    ]


N_STATISTICS = len(statistics(b""))


def _described(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        rows = [statistics(data) for data in part["data"]]
        held = [None if missing else zlib.crc32(str(name).encode()) % 5 == 0 for name, missing in zip(part["doc_id"], part["missing"], strict=True)]
        yield pd.DataFrame({"doc_id": part["doc_id"], "missing": part["missing"], "held_out": [h is None or h for h in held], "x": rows})


class Model:
    """Scores of rows of statistics, from 0 to 1."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, directions: np.ndarray, phases: np.ndarray):
        self.mean, self.scale, self.directions, self.phases = mean, scale, directions, phases
        self.weights = np.zeros(directions.shape[1] + mean.size + 1)
        self.knots = np.array([0.0, 1.0])
        self.levels = np.array([0.5, 0.5])

    def features(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features, the standardized statistics themselves, and a constant."""
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / self.directions.shape[1])
        return np.hstack([waves, z * 0.2, np.ones((len(z), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.levels), 0, 1)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence closest to ``values`` in weighted squares (pool adjacent violators)."""
    pools: list[list[float]] = []
    for value, weight in zip(values, weights, strict=True):
        pools.append([value, weight, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v, w, n = pools.pop()
            u = pools[-1]
            pools[-1] = [(u[0] * u[1] + v * w) / (u[1] + w), u[1] + w, u[2] + n]
    return np.concatenate([np.full(n, value) for value, _, n in pools]) if pools else np.empty(0)


def describe(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, missing, held_out, x): the statistics ``x`` of each whole text; ``held_out`` rows must not be learnt from."""
    number = F.col(doc_id).cast("long")
    source = docs.select(F.coalesce(number, F.lit(0).cast("long")).alias("doc_id"), number.isNull().alias("missing"), F.col(text).cast("binary").alias("data"))
    return source.mapInPandas(_described, "doc_id long, missing boolean, held_out boolean, x array<double>")


def fit(described: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", seed: int = 11) -> Model:
    """Learn from all labelled rows that are not held out.

    Tasks send sums only: moments of the statistics, then the normal equations of their rows, then label sums per bin of
    raw scores. These have fixed sizes (a square of about ``FEATURES`` numbers; ``BINS`` rows) and are added up by key.
    The ridge system is solved on the driver. The calibration uses a quarter of the learning rows, which the regression
    did not see.
    """
    y = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("long").alias("doc_id"))
    y = y.agg(F.avg(F.col(label).cast("double")).alias("y"))
    scratch = Scratch(described.sparkSession, "quality")
    rows = described.filter("NOT held_out AND NOT missing").join(y, "doc_id")
    rows = rows.withColumn("calibrates", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)) == CALIBRATION_FOLD)
    rows = scratch.store(rows.select("x", "y", "calibrates"), "rows")
    sums = rows.agg(
        F.count("*").alias("n"), F.array(*[F.avg(F.col("x")[i]) for i in range(N_STATISTICS)]).alias("mean"),
        F.array(*[F.stddev_pop(F.col("x")[i]) for i in range(N_STATISTICS)]).alias("scale"),
    ).first()
    draw = np.random.default_rng(seed)
    width = np.sqrt(N_STATISTICS) * 0.9
    directions = draw.standard_normal((N_STATISTICS, FEATURES)) / width
    phases = draw.uniform(0, 2 * np.pi, FEATURES)
    if not sums["n"]:
        return Model(np.zeros(N_STATISTICS), np.ones(N_STATISTICS), directions, phases)
    model = Model(np.array(sums["mean"]), np.maximum(np.array(sums["scale"]), 1e-9), directions, phases)

    size = len(model.weights)
    equations = rows.filter("NOT calibrates").mapInPandas(_normal_equations(model), "line int, numbers binary")
    lines = equations.groupBy("line").applyInPandas(_added, "line int, numbers binary").collect()
    system = np.zeros((size, size + 1))
    for row in lines:
        system[row.line] = np.frombuffer(row.numbers)
    n = system[size - 1, size - 1]
    if n:
        penalty = RIDGE * n * np.eye(size)
        penalty[-1, -1] = 1e-9
        model.weights = np.linalg.solve(system[:, :size] + penalty, system[:, size])

    binned = rows.filter("calibrates").mapInPandas(_binned(model), "bin int, n long, total double")
    binned = pd.DataFrame(
        [tuple(r) for r in binned.groupBy("bin").agg(F.sum("n"), F.sum("total")).collect()], columns=["bin", "n", "total"]
    ).sort_values("bin")
    if len(binned):
        held = binned["n"].to_numpy(float)
        levels = isotonic(binned["total"].to_numpy() / held, held)
        # One knot per level, at the middle of its scores; in between the scores rise, so that ranks are not lost.
        centres = _BIN_LOW + (binned["bin"].to_numpy() + 0.5) / BINS * (_BIN_HIGH - _BIN_LOW)
        starts = np.flatnonzero(np.r_[True, levels[1:] > levels[:-1]])
        pool = np.add.reduceat(held, starts)
        model.knots = np.r_[_BIN_LOW - 1, np.add.reduceat(centres * held, starts) / pool, _BIN_HIGH + 1]
        model.levels = np.r_[levels[starts][0] * 0.5, levels[starts], 1 - (1 - levels[starts][-1]) * 0.5]
    return model


_BIN_LOW, _BIN_HIGH = -0.5, 1.5


def _normal_equations(model: Model):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = len(model.weights)
        total = np.zeros((size, size + 1))
        some = False
        for part in parts:
            if len(part):
                some = True
                z = model.features(np.stack(part["x"].to_numpy()))
                total += z.T @ np.hstack([z, part["y"].to_numpy()[:, None]])
        if some:
            yield pd.DataFrame({"line": np.arange(size, dtype=np.int32), "numbers": [row.tobytes() for row in total]})

    return run


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(numbers) for numbers in rows["numbers"])
    return pd.DataFrame({"line": rows["line"].iloc[:1], "numbers": [total.tobytes()]})


def _binned(model: Model):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = np.zeros(BINS, np.int64), np.zeros(BINS)
        for part in parts:
            if len(part):
                raw = model.raw(np.stack(part["x"].to_numpy()))
                bins = np.clip((raw - _BIN_LOW) / (_BIN_HIGH - _BIN_LOW) * BINS, 0, BINS - 1).astype(int)
                n += np.bincount(bins, minlength=BINS)
                total += np.bincount(bins, part["y"].to_numpy(), minlength=BINS)
        held = np.flatnonzero(n)
        yield pd.DataFrame({"bin": held.astype(np.int32), "n": n[held], "total": total[held]})

    return run


def score_quality(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs``, learnt from ``labels`` (doc_id, ``label`` 0 or 1).

    Rows with crc32 of doc_id as text divisible by 5 are held out: never learnt from. ``score`` is an estimate of the
    probability of label 1; ``predicted`` is 1 from 0.3 on.

    Defined cases: NULL and empty texts are scored as texts without words. A NULL doc_id counts as held out and stays
    NULL. Labels that are NULL are ignored; several labels of one doc_id are averaged; labels of unknown documents are
    ignored. Without any label to learn from each score is 0.5. Repeated rows are repeated, extra columns ignored.
    """
    scratch = Scratch(docs.sparkSession, "statistics")
    described = scratch.store(describe(docs, text, doc_id), "statistics")
    model = fit(described, labels, label)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(x.to_numpy())) if len(x) else np.empty(0))

    scored = described.select(F.when(~F.col("missing"), F.col("doc_id")).alias("doc_id"), "held_out", score("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
