"""Text quality: random Fourier features over document statistics, ridge scores, isotonic
calibration.

The statistics of a text are read once.  Cosines of random projections approximate a Gaussian
kernel over them; the normal equations of the ridge are sums over partitions, and the
calibration needs only counts of score bins.  Both are fitted on all labelled rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, text_of, whole_number

STATISTICS = (
    "log_chars log_words mean_word sd_word long_word upper title digit other_ascii symbol space non_ascii "
    "distinct top_word next_same triple_repeat lines line_repeat line_length line_end sentence compressed one_letter"
).split()
FEATURES = 256
RIDGE = 1.0
SEED = 20_240_607
#: Bins of the calibration.
BINS = 2_000


def _classes() -> np.ndarray:
    """Byte classes: 0 lower, 1 upper, 2 digit, 3 sentence marks, 4 symbols, 5 blank, 6 line
    end, 7 beyond ASCII, 8 other."""
    kinds = np.full(256, 8, np.uint8)
    kinds[128:] = 7
    for chars, k in ((b"abcdefghijklmnopqrstuvwxyz", 0), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2), (b".!?,;:'\"()-", 3), (b"#$%&*+/<=>@[\\]^_`{|}~", 4), (b" \t", 5), (b"\n\r", 6)):
        kinds[list(chars)] = k
    return kinds


CLASSES = _classes()


def statistics(text: str) -> list[float]:
    """The numbers of STATISTICS; all zero for a text without words."""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    raw = text.encode()
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kinds = np.bincount(CLASSES, weights=by_byte, minlength=9)
    letters = kinds[0] + kinds[1] + kinds[7] + 1.0
    n = len(words)
    lengths = np.fromiter(map(len, words), np.float64, n)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    triples = max(n - 2, 1)
    return [
        np.log1p(len(text)),
        np.log1p(n),
        lengths.mean(),
        lengths.std(),
        np.log1p(lengths.max()),
        kinds[1] / letters,
        sum(map(str.istitle, words)) / n,
        kinds[2] / len(raw),
        kinds[8] / len(raw),
        kinds[4] / len(raw),
        (kinds[5] + kinds[6]) / len(raw),
        kinds[7] / len(raw),
        len(counts) / n,
        counts.most_common(1)[0][1] / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        1.0 - len(set(zip(words, words[1:], words[2:]))) / triples if n > 2 else 0.0,
        np.log1p(len(lines)),
        1.0 - len(set(lines)) / max(len(lines), 1),
        np.log1p(len(text) / max(len(lines), 1)),
        sum(x[-1] in ".!?" for x in lines) / max(len(lines), 1),
        sum(w[-1] in ".!?" for w in words) / n,
        len(zlib.compress(raw, 1)) / len(raw),
        sum(lengths == 1) / n,
    ]


def with_statistics(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, x) for every row of `docs`, x the statistics of the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return docs.select(whole_number(key).alias("doc_id"), text_of(text)).mapInArrow(run, "doc_id bigint, x array<double>")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the cosines and the intercept
    knots: np.ndarray  # raw scores
    levels: np.ndarray  # calibrated scores at the knots

    def cosines(self, x: np.ndarray) -> np.ndarray:
        return cosines(x, self.mean, self.scale)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.cosines(x) @ self.weights, self.knots, self.levels), 0.0, 1.0)


def cosines(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of the scaled statistics, and a constant."""
    d = x.shape[1]
    rng = np.random.default_rng(SEED)
    directions = rng.normal(0.0, 1.0, (d, FEATURES)) / np.sqrt(d)
    phases = rng.uniform(0.0, 2 * np.pi, FEATURES)
    z = np.clip((x - mean) / scale, -5.0, 5.0)
    return np.hstack([np.sqrt(2.0 / FEATURES) * np.cos(z @ directions + phases), np.ones((len(x), 1))])


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def _equations(mean: np.ndarray, scale: np.ndarray):
    """The normal equations of a partition, a row of the matrix in each row; the last number is
    the right-hand side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        left, right = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
        for batch in batches:
            z = cosines(_matrix(batch.column(0)), mean, scale)
            left += z.T @ z
            right += z.T @ batch.column(1).to_numpy().astype(float)
        rows = np.hstack([left, right[:, None]])
        at = pa.array(np.arange(FEATURES + 1), pa.int32())
        part = pa.array(np.full(FEATURES + 1, TaskContext.get().partitionId() % 64), pa.int32())
        yield pa.RecordBatch.from_arrays([at, part, pa.array(list(rows), pa.list_(pa.float64()))], names=["at", "part", "sums"])

    return run


def _add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"at": [key[0]], "sums": [np.sum(np.stack(rows["sums"].to_list()), axis=0)]})


def isotonic(n: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Non-decreasing rates of bins in order, by pooling neighbours that violate the order."""
    blocks: list[list[float]] = []
    for total, hits in zip(n, positive):
        blocks.append([total, hits, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            total, hits, k = blocks.pop()
            blocks[-1][0] += total
            blocks[-1][1] += hits
            blocks[-1][2] += k
    return np.concatenate([np.full(int(k), (hits + 0.5) / (total + 1.0)) for total, hits, k in blocks])


def fit(rows: DataFrame) -> Model:
    """Fit on (x, label); all rows count.  Without labels of both kinds all scores are 0.5."""
    d = len(STATISTICS)
    moments = rows.agg(F.count("*"), F.sum("label"), *(f(F.col("x")[i]) for i in range(d) for f in (F.avg, F.stddev_pop))).first()
    n, positive = moments[0], moments[1] or 0
    if not positive or positive == n:
        return Model(np.zeros(d), np.ones(d), np.zeros(FEATURES + 1), np.array([0.0]), np.array([0.5]))
    mean = np.array([moments[2 + 2 * i] for i in range(d)], float)
    scale = np.array([moments[3 + 2 * i] for i in range(d)], float) + 1e-9
    partial = rows.select("x", "label").mapInArrow(_equations(mean, scale), "at int, part int, sums array<double>")
    summed = partial.groupBy("at", "part").applyInPandas(_add, "at int, sums array<double>").groupBy("at").applyInPandas(_add, "at int, sums array<double>")
    table = np.zeros((FEATURES + 1, FEATURES + 2))
    for r in summed.collect():  # FEATURES + 1 rows
        table[r["at"]] = r["sums"]
    ridge = np.eye(FEATURES + 1) * RIDGE
    ridge[-1, -1] = 0.0
    weights = np.linalg.solve(table[:, :-1] + ridge, table[:, -1])

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = cosines(_matrix(batch.column(0)), mean, scale) @ weights
            at = np.clip(((raw + 0.5) / 2.0 * BINS).astype(np.int32), 0, BINS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column(1)], names=["bin", "label"])

    counts = rows.select("x", "label").mapInArrow(bins, "bin int, label int").groupBy("bin").agg(F.count("*").alias("n"), F.sum("label").alias("hits"))
    found = sorted(counts.collect())  # BINS rows at most
    levels = isotonic(np.array([r[1] for r in found], float), np.array([r[2] for r in found], float))
    knots = (np.array([r[0] for r in found]) + 0.5) / BINS * 2.0 - 0.5
    # A level holds at the middle of its bins; in between, scores rise evenly.
    steps = pd.DataFrame({"level": levels, "knot": knots}).groupby("level", sort=True)["knot"].mean()
    return Model(mean, scale, weights, steps.to_numpy(), steps.index.to_numpy())


def score_documents(docs: DataFrame, labels: DataFrame, part: int, of: int, label: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs`, fitted on the labelled rows
    outside the held-out part: those where crc32 of the id as text does not leave `part`.

    Null and empty texts have the statistics zero and a score like others.  Null ids have no
    labels; of several labels of an id the highest counts; repeated rows count as often as they
    come.  Labels without texts are not used.  Other columns are not read.
    """
    from .toxicity import held_out

    table = materialise(with_statistics(docs), "statistics")
    known = labels.select(whole_number().alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label")).where("label is not null")
    known = known.where(~held_out(part, of)).groupBy("doc_id").agg(F.max("label").alias("label"))
    model = fit(materialise(table.join(known, "doc_id").select("x", "label"), "labelled"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    scored = table.select("doc_id", "x").mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out(part, of).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
