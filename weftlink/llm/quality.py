"""Document quality: random Fourier features of document statistics, ridge scores, isotonic calibration.

A document becomes a dozen statistics of its bytes and words; random Fourier features approximate a Gaussian kernel over
them. Each partition sums its share of the normal equations, the shares are added up in groups, and the driver solves one
system of fixed size. The raw ridge scores of a calibration fold are counted in a fixed grid, on which pooled adjacent
violators give a monotone map to probabilities. Labels are used only from rows whose fold is not 0: folds 1 to 3 fit, fold 4 calibrates.

Edge cases: null and empty texts have zero statistics and are scored; labels that are null or without a document are left
out; with no labels, or only one class, every score is 0.5 (or that class); repeated rows are scored each; an empty table
gives no rows. Neither label, lang, source nor doc_id enters a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.llm.common import cut, fold_of, runs_of, ship
from weftlink.llm.minhash_dedup import _BASE, _BYTE, mix
from weftlink.llm.suffix_dedup import bytes_of

U64 = np.uint64
GRID = 1024

_KIND = np.zeros(256, np.uint8)
for _c in range(256):
    _s = chr(_c)
    _KIND[_c] = (
        8 if _c >= 128 else 1 if "a" <= _s <= "z" else 2 if "A" <= _s <= "Z" else 3 if "0" <= _s <= "9" else 4 if _s == "\n" else 5 if _s in " \t\r\v\f" else 6 if _s in ".,;:'\"?-()" else 7
    )
STATISTICS = 13


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of statistics per document of the concatenated texts."""
    parts = [_statistics(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in runs_of(offsets)]
    return np.concatenate(parts) if parts else np.zeros((0, STATISTICS))


def _statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    docs = len(offsets) - 1
    n = np.diff(offsets)
    out = np.zeros((docs, STATISTICS))
    some = n > 0
    if not some.any():
        return out
    kind = _KIND[data]
    starts = offsets[:-1][some]
    share = np.zeros((docs, 9))
    for k in range(1, 9):
        share[some, k] = np.add.reduceat((kind == k).view(np.uint8), starts, dtype=np.int64)
    pipes = np.zeros(docs)
    pipes[some] = np.add.reduceat((data == ord("|")).view(np.uint8), starts, dtype=np.int64)
    solid = (kind != 4) & (kind != 5)
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    begins[starts] = solid[starts]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    last = offsets[1:][some] - 1
    ends[last] = solid[last]
    a, b = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    power = np.full(len(data), U64(_BASE), dtype=np.uint64)
    power[0] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * np.multiply.accumulate(power), dtype=np.uint64)])
    back = np.full(len(data), U64(pow(_BASE, -1, 2**64)), dtype=np.uint64)
    back[0] = 1
    word = mix((sums[b] - sums[a]) * np.multiply.accumulate(back)[a])
    doc = np.searchsorted(offsets, a, side="right") - 1
    words = np.bincount(doc, minlength=docs)
    order = np.lexsort((word, doc))
    d, w = doc[order], word[order]
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (w[1:] != w[:-1])]) if len(d) else np.zeros(0, bool)
    distinct = np.bincount(d[new], minlength=docs)
    twice = np.bincount(doc[1:][(doc[1:] == doc[:-1]) & (word[1:] == word[:-1])], minlength=docs) if len(doc) else np.zeros(docs)
    tail = np.bincount(doc, weights=(kind[b - 1] == 7), minlength=docs)
    size, count = np.maximum(n, 1), np.maximum(words, 1)
    out[:, 0] = np.log1p(n)
    out[:, 1] = np.log1p(words)
    out[:, 2] = np.minimum((n - share[:, 4] - share[:, 5]) / count, 40)
    for column, k in enumerate((2, 3, 6, 7, 8), start=3):
        out[:, column] = np.sqrt(share[:, k] / size)
    out[:, 8] = np.sqrt(share[:, 4] / count)
    out[:, 9] = np.sqrt(pipes / count)
    out[:, 10] = distinct / count / np.maximum(1, 4 / np.log1p(count))
    out[:, 11] = np.sqrt(twice / count)
    out[:, 12] = np.sqrt(tail / count)
    out[words == 0, 2:] = 0
    return out


@dataclass
class Model:
    """Standardisation, random features, ridge weights and the calibration curve."""

    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    curve_x: np.ndarray
    curve_y: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.column_stack([np.cos(z @ self.waves + self.phase) * np.sqrt(2 / len(self.phase)), np.ones(len(z))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability; one part in a hundred comes from the raw score, which orders documents of one step."""
        raw = self.raw(x)
        return np.clip(0.99 * np.interp(raw, self.curve_x, self.curve_y) + 0.01 * np.clip(raw, 0, 1), 0, 1)


def isotonic(n: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Pooled adjacent violators over bins with counts: the non-decreasing fit of ones/n (0 where all is empty)."""
    blocks: list[list[float]] = []
    for i in np.flatnonzero(n):
        blocks.append([n[i], ones[i], i])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            m, o, _ = blocks.pop()
            blocks[-1][0] += m
            blocks[-1][1] += o
    at, value = [b[2] for b in blocks], [(b[1] + 0.02) / (b[0] + 0.04) for b in blocks]
    full = np.zeros(len(n))
    for k, i in enumerate(at):
        full[i : at[k + 1] if k + 1 < len(at) else len(n)] = value[k]
    if at:
        full[: at[0]] = value[0]
    return full


def summed(df: DataFrame, shape: int, fold, schema_of: str, groups: int = 16) -> np.ndarray:
    """Partition sums of `fold(batch) -> vector of length shape`, added up in `groups` groups and then on the driver, which gets at most `groups` vectors."""

    def part(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        total = np.zeros(shape)
        for b in batches:
            if b.num_rows:
                total += fold(b)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % groups], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["g", "v"])

    def add(table):
        import pyarrow as pa

        total = np.zeros(shape)
        for v in table.column("v").to_pylist():
            total += np.frombuffer(v)
        return pa.table({"g": pa.array([0], pa.int32()), "v": pa.array([total.tobytes()], pa.binary())})

    rows = df.mapInArrow(part, schema_of).groupBy("g").applyInArrow(add, schema_of).collect()
    return sum((np.frombuffer(bytes(r["v"])) for r in rows), np.zeros(shape))


def _columns(b, names):
    return [b.column(n).to_numpy(zero_copy_only=False) for n in names]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every document."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            x = statistics(*bytes_of(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "x"])

    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, x binary")


def rows_of(column) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw).reshape(-1, STATISTICS)


def fit(stats: DataFrame, labels: DataFrame, label: str, waves: int = 256, ridge: float = 1e-3, width: float = 4.0, seed: int = 17) -> Model:
    """Train on `stats` (doc_id, x) and `labels` (doc_id, `label`)."""
    known = labels.where(F.col(label).isNotNull()).select("doc_id", F.col(label).cast("double").alias("y"))
    train = cut(stats.join(known, "doc_id").select("x", "y", fold_of(F.col("doc_id")).alias("fold")).where("fold <> 0"))

    def moments(b):
        x = rows_of(b.column("x"))
        return np.concatenate([[len(x)], x.sum(0), (x**2).sum(0), [b.column("y").to_numpy().sum()]])

    m = summed(train, 2 + 2 * STATISTICS, moments, "g int, v binary")
    count = max(m[0], 1)
    mean = m[1 : 1 + STATISTICS] / count
    scale = np.sqrt(np.maximum(m[1 + STATISTICS : 1 + 2 * STATISTICS] / count - mean**2, 1e-6))
    r = np.random.default_rng(seed)
    model = Model(mean, scale, r.normal(0, 1 / width, (STATISTICS, waves)), r.uniform(0, 2 * np.pi, waves), np.zeros(waves + 1), np.array([0.0]), np.array([m[-1] / count if m[0] else 0.5]))
    if not m[0] or m[-1] in (0, m[0]):
        return model
    d = waves + 1

    def normal(b):
        f = model.features(rows_of(b.column("x")))
        return np.concatenate([(f.T @ f).ravel(), f.T @ b.column("y").to_numpy()])

    s = summed(train.where("fold <> 4"), d * d + d, normal, "g int, v binary")
    model.weights = np.linalg.solve(s[: d * d].reshape(d, d) + ridge * np.eye(d), s[d * d :])

    def bins(b):
        at = np.clip(((model.raw(rows_of(b.column("x"))) + 0.5) / 2 * GRID).astype(int), 0, GRID - 1)
        return np.concatenate([np.bincount(at, minlength=GRID), np.bincount(at, weights=b.column("y").to_numpy(), minlength=GRID)])

    s = summed(train.where("fold = 4"), 2 * GRID, bins, "g int, v binary")
    if s[:GRID].sum():
        model.curve_x = (np.arange(GRID) + 0.5) / GRID * 2 - 0.5
        model.curve_y = isotonic(s[:GRID], s[GRID:])
    else:
        model.curve_x, model.curve_y = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def score_stats(stats: DataFrame, model: Model, threshold: float) -> DataFrame:
    """doc_id, held_out, score, predicted from `stats` (doc_id, x)."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(shared.value.score(rows_of(b.column("x"))), pa.float64())], ["doc_id", "score"])

    scored = stats.mapInArrow(run, f"doc_id {dict(stats.dtypes)['doc_id']}, score double")
    return scored.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of `docs` (doc_id, text); `labels` has doc_id and quality."""
    ship(docs.sparkSession)
    stats = cut(measured(docs))
    return score_stats(stats, fit(stats, labels, "quality"), threshold)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of `docs` that score at least `threshold`, with all their columns; texts are scored where they are, without a shuffle."""
    ship(docs.sparkSession)
    model = fit(measured(docs), labels, "quality")
    return kept_rows(docs, model, lambda m, data, offsets: m.score(statistics(data, offsets)), threshold, above=True)


def kept_rows(docs: DataFrame, model, score, threshold: float, above: bool) -> DataFrame:
    """Rows whose score(model, bytes, offsets) is at least (or below) `threshold`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            text = b.column(at).cast(pa.large_string()).fill_null("").cast(pa.large_binary())
            s = score(shared.value, *bytes_of(text))
            yield b.filter(pa.array(s >= threshold if above else s < threshold))

    return docs.mapInArrow(run, docs.schema)
