"""Boosted regression trees for several scores at once, grown over binned rows in blocks.

The trees are those of MLlib's boosting by squared error: the first one is fitted to the labels
and counts whole, the others to twice the residuals and count `step`; a node looks at a drawn
part of the columns, splits where the squared sums gain most, and orders categories by their
mean.  What differs is how they are grown:

* The columns of a row are binned once, into a byte each, and lie in blocks beside the residuals
  of all scores.  A job measures one level of the trees of all scores: a task sums the residuals
  of its blocks by node and bin, and only those sums reach the driver.  Of two sister nodes the
  smaller one is measured, the other is what is left of the parent.
* Rows are drawn for a round by a hash of their id, and residuals are added in a fixed point, so
  the trees are the same on any layout.
* The loss on the validation rows is known in every round, so a score ends at the round in which
  it may, and a longer fit goes on from a shorter one.
"""

from __future__ import annotations

import json
import math
from threading import Lock

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.filters import usable_label
from ..session import fresh_path

#: Names the draws of rows.
DRAW = "rows"
#: Rows of a block, which ends below twice as many.  A count and a sum of so many residuals of
#: 23 bits share one double without rounding.
BLOCK, COUNT = 16_384, 2.0**38
#: Residuals are kept as whole numbers of 32 bits; those that are added drop so many bits.
DROPPED = 9
#: Share of the rows of a round, and of the columns of a node.
ROW_SHARE = COLUMN_SHARE = 0.8
#: Bytes of blocks in one part.
PART = 2**26
#: Stands for a residual that is not known.
UNKNOWN = -(2**31)
#: Squared residuals are added in units of one by this.
SQUARES = 2.0**16


def category_counts(field) -> dict[int, int]:
    """Number of values of the categorical slots of a column of vectors, by its attributes."""
    attrs = field.metadata.get("ml_attr", {}).get("attrs", {})
    found = {a["idx"]: len(a["vals"]) if "vals" in a else a["num_vals"] for a in attrs.get("nominal", []) if "vals" in a or "num_vals" in a}
    return found | {a["idx"]: 2 for a in attrs.get("binary", [])}


def cut_points(values: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between the values of a column: between all of them, or at about equal counts."""
    known, counts = np.unique(values, return_counts=True)
    middles = (known[:-1] + known[1:]) / 2
    if len(middles) < bins:
        return middles
    stride, cuts, reached, wanted = len(values) / bins, [], counts[0], len(values) / bins
    for i in range(1, len(known)):
        before, reached = reached, reached + counts[i]
        if abs(before - wanted) < abs(reached - wanted):
            cuts.append(middles[i - 1])
            wanted += stride
    return np.array(cuts)


def stop_round(losses: list[float], patience: int) -> tuple[int, bool]:
    """The round (from 1) of the least loss before `patience` rounds brought no gain, and whether
    it was those rounds that ended the search."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def _walker():
    """Rows by node of a tree in heap order; nodes from `stop` on are not split any more."""

    def walk(x, rows, feature, left, stop):
        ready, found = [(1, rows)], {}
        while ready:
            node, at = ready.pop()
            if node >= stop or feature[node] < 0:
                found[node] = at
                continue
            side = left[node].take(x[feature[node]].take(at))
            ready.append((2 * node, at.compress(side)))
            ready.append((2 * node + 1, at.compress(~side)))
        return found

    return walk


def _drawer():
    """Rows drawn for a round by their hash."""

    def drawn(h, v, number, share):
        import numpy as np

        z = h + np.uint32(number * 0x9E3779B9 % 2**32)
        z = (z ^ (z >> np.uint32(16))) * np.uint32(0x85EBCA6B)
        z = (z ^ (z >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        return ~v & ((z ^ (z >> np.uint32(16))) < np.uint32(share * 2**32))

    return drawn


def _summer(sizes: list[int], dropped: int, step: float):
    """Counts and sums of residuals by group of rows and bin, for all columns side by side."""

    def measure(x, r, groups):
        import numpy as np

        rows, most = np.concatenate(groups), max(sizes)
        kind = np.uint16 if len(groups) * most <= 2**16 else np.int64
        first = np.repeat(np.arange(len(groups), dtype=kind) * kind(most), [len(g) for g in groups])
        weights = ((r.take(rows).astype(np.int64) + 2 ** (dropped - 1)) >> dropped) + step
        found = np.stack([np.bincount(first + column.take(rows), weights, minlength=len(groups) * most) for column in x])
        found = np.concatenate([f.reshape(len(groups), most)[:, :size] for f, size in zip(found, sizes)], axis=1)
        count = np.rint(found / step)
        return np.stack([count, found - count * step]).astype(np.int64)

    return measure


def _blocks(cuts: dict[int, np.ndarray], sizes: list[int], kind: str, targets: int, unit: float, most: int):
    unknown = UNKNOWN

    def run(batches):
        import numpy as np
        import pyarrow as pa

        parts, waiting = [], 0

        def block():
            x, h, v, r = (np.concatenate(p, axis=-1) for p in zip(*parts))
            columns = [pa.array([a.tobytes()], pa.binary()) for a in (x, h, v, r)]
            return pa.RecordBatch.from_arrays(columns, names=["x", "h", "v", "r"])

        for batch in (b.slice(start, most) for b in batches for start in range(0, b.num_rows, most)):
            n = batch.num_rows
            values = np.array(batch.column(0).flatten()).reshape(n, -1)
            if np.isnan(values).any():
                raise ValueError("boosting needs features without NaN")
            x = np.empty((len(sizes), n), kind)
            for f, size in enumerate(sizes):
                x[f] = np.searchsorted(cuts[f], values[:, f]) if f in cuts else values[:, f]
                if x[f].max() >= size:
                    raise ValueError(f"column {f} has categories that its attributes do not name")
            h = (batch.column(1).to_numpy().view(np.uint64) >> np.uint64(32)).astype(np.uint32)
            v = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            r = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, targets).T
            r = np.where(np.isnan(r), unknown, np.rint(r * unit)).astype(np.int32)
            parts.append((x, h, v, r))
            waiting += n
            if waiting >= most:
                yield block()
                parts, waiting = [], 0
        if waiting:
            yield block()

    return run


def _advance(trees: list, active: list[int], number: int, sizes: list[int], kind: str, unit: float, share: float):
    """Take the last trees off the residuals, and measure the roots of the active scores over the
    rows of round `number` and the loss of all scores on the validation rows."""
    walk, drawn, measure, unknown, squares = _walker(), _drawer(), _summer(sizes, DROPPED, COUNT), UNKNOWN, SQUARES

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                at = lambda c, kind: np.frombuffer(batch.column(c)[i].as_buffer(), kind)
                h, v = at(1, np.uint32), at(2, bool)
                x, r = at(0, kind).reshape(len(sizes), -1), at(3, np.int32).reshape(len(trees), -1).copy()
                everyone = np.arange(len(h))
                for mine, tree in zip(r, trees):
                    if tree is not None:
                        feature, left, values = tree
                        less = np.empty(len(h), np.int64)
                        for node, rows in walk(x, everyone, feature, left, len(feature)).items():
                            less[rows] = values[node]
                        mine[:] = np.where(mine == unknown, unknown, np.clip(mine - less, unknown + 1, -unknown - 1))
                mask = drawn(h, v, number, share)
                roots = [measure(x, r[t], [np.flatnonzero(mask & (r[t] != unknown))]) for t in active]
                checked = r[:, v]
                known = checked != unknown
                lost = np.where(known, np.rint((checked / unit) ** 2 * squares), 0).astype(np.int64).sum(1)
                found = np.concatenate([known.sum(1), lost, *[a.ravel() for a in roots]]).astype(np.int64)
                columns = [pa.array([a.tobytes()], pa.binary()) for a in (x, h, v, r, found)]
                yield pa.RecordBatch.from_arrays(columns, names=["x", "h", "v", "r", "found"])

    return run


def _level(work: list, number: int, sizes: list[int], kind: str, targets: int, share: float):
    """Measure some nodes of the growing trees: (score, feature, left, stop, nodes) each."""
    walk, drawn, measure, unknown = _walker(), _drawer(), _summer(sizes, DROPPED, COUNT), UNKNOWN

    def run(batches):
        import numpy as np
        import pyarrow as pa

        total, none = None, np.zeros(0, np.intp)
        for batch in batches:
            for i in range(batch.num_rows):
                at = lambda c, kind: np.frombuffer(batch.column(c)[i].as_buffer(), kind)
                x, r = at(0, kind).reshape(len(sizes), -1), at(3, np.int32).reshape(targets, -1)
                mask, found = drawn(at(1, np.uint32), at(2, bool), number, share), []
                for t, feature, left, stop, nodes in work:
                    rows = walk(x, np.flatnonzero(mask & (r[t] != unknown)), feature, left, stop)
                    found.append(measure(x, r[t], [rows.get(node, none) for node in nodes]).ravel())
                found = np.concatenate(found)
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["found"])

    return run


class Tree:
    """A growing tree in heap order: node i has the children 2i and 2i + 1."""

    def __init__(self, depth: int, bins: int):
        self.feature = np.full(2**depth, -1)
        self.left = np.zeros((2**depth, bins), bool)
        self.gain = np.zeros(2**depth)
        self.count = np.zeros(2 ** (depth + 1))
        self.sum = np.zeros(2 ** (depth + 1))
        self.measured: dict[int, np.ndarray] = {}

    def means(self) -> np.ndarray:
        return self.sum / np.maximum(self.count, 1)


class Boosting:
    """Trees of all `targets` over one table of the id, `features`, `split` and the targets."""

    def __init__(self, table: DataFrame, targets: list[str], bins: int, rounds: int, grown: int, depth: int, step: float, patience: int, seed: int):
        self.table, self.targets, self.rounds, self.grown = table, list(targets), rounds, grown
        self.depth, self.step, self.patience, self.seed = depth, step, patience, seed
        self.trees: dict[str, list[Tree]] = {t: [] for t in targets}
        self.losses: dict[str, list[float]] = {t: [] for t in targets}
        self.judged: dict[str, int] = {}
        self.lock, self.number = Lock(), 0
        self.state: DataFrame | None = None
        self.path: str | None = None
        self.bins = bins

    def grow(self, target: str, n: int) -> int:
        """Trees of `target` to hand out for `n` rounds: fewer if its search ended before.

        A round grows a tree for every score that is not at its end, so whoever asks first
        waits for the round and the others find theirs grown."""
        with self.lock:
            if self.state is None:
                self._begin()
            while len(self._known(target)) < n and not self.ended(target) and self._round():
                pass
        return min(n, len(self._known(target)))

    def _known(self, target: str) -> list:
        """Its trees as far as their loss is known, if there is one."""
        trees = self.trees[target]
        return trees[: len(self.losses[target])] if self.judged.get(target) else trees

    def ended(self, target: str) -> bool:
        losses = self.losses[target]
        return bool(losses) and stop_round(losses, self.patience)[1]

    def close(self) -> None:
        """Free what the rounds kept."""
        if self.path:
            self.state.unpersist()
            self._delete(self.path)

    def _delete(self, path: str) -> None:
        spark = self.table.sparkSession
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    def _begin(self) -> None:
        table, spark = self.table, self.table.sparkSession
        id_column = table.columns[0]
        valid = [F.when(usable_label(t), F.col(t).cast("double")) for t in self.targets]
        rows = table.where((F.col("split") != "test") & F.coalesce(*valid).isNotNull())
        learn = rows.where(F.col("split") == "train")
        n, largest = learn.agg(F.count("*"), F.max(F.greatest(*[F.abs(c) for c in valid], F.lit(0.0)))).first()
        if not n:
            raise ValueError("boosting needs training rows")
        counts = category_counts(table.schema["features"])
        needed = max(self.bins**2, 10_000)
        parts = 2**30
        drawn = learn.where(F.pmod(F.xxhash64(id_column, F.lit("cuts")), F.lit(parts)) < min(parts, -(-needed * parts // n)))
        sample = drawn.select(vector_to_array("features").alias("x")).toArrow().column("x").combine_chunks()
        sample = np.array(sample.flatten()).reshape(len(sample), -1)
        self.columns = sample.shape[1]
        most = min(self.bins, n)
        self.cuts = {f: cut_points(sample[:, f], most) for f in range(self.columns) if f not in counts}
        self.sizes = [counts[f] if f in counts else len(self.cuts[f]) + 1 for f in range(self.columns)]
        self.ordered = np.array([f not in counts for f in range(self.columns)])
        self.counts = counts
        self.kind = "uint8" if max(self.sizes) <= 256 else "uint16" if max(self.sizes) <= 2**16 else "int32"
        # Residuals of up to four times the largest label fit.
        self.unit = 2.0 ** (29 - math.ceil(math.log2(max(largest or 0.0, 1.0))))
        self.coarse = self.unit / 2**DROPPED
        starts = np.cumsum([0, *self.sizes[:-1]])
        within = np.arange(max(self.sizes))
        self.filled = within < np.array(self.sizes)[:, None]
        self.places = np.where(self.filled, starts[:, None] + within, 0)
        binned = rows.select(
            vector_to_array("features").alias("x"),
            F.xxhash64(F.lit(DRAW), id_column, F.lit(self.seed)).alias("h"),
            (F.col("split") != "train").alias("v"),
            F.array(*valid).alias("r"),
        ).mapInArrow(_blocks(self.cuts, self.sizes, self.kind, len(self.targets), self.unit, BLOCK), "x binary, h binary, v binary, r binary")
        # Parts of at most PART bytes and, up to that, one for each core.
        blocks = -(-rows.count() // BLOCK)
        size = BLOCK * (5 + len(self.targets) * 4 + self.columns * np.dtype(self.kind).itemsize)
        parts = max(1, min(blocks, max(spark.sparkContext.defaultParallelism, -(-blocks * size // PART))))
        # A session of its own: a file is a part here, and the rows are long.
        self.session = spark.newSession()
        settings = {
            "spark.sql.files.openCostInBytes": 2 * PART,
            "spark.sql.files.maxPartitionBytes": 2 * PART,
            "spark.sql.execution.arrow.maxRecordsPerBatch": 4,
            "spark.sql.adaptive.enabled": "false",
        }
        for name, value in settings.items():
            self.session.conf.set(name, value)
        self._store(binned.repartition(parts), ("x", "h", "v", "r"))
        self.last: list = [None] * len(self.targets)
        self._update()

    def _store(self, state: DataFrame, names: tuple[str, ...]) -> None:
        """Write the blocks of a round and read them from there: what is cached can be read again.  Those of
        the round before go."""
        before, self.path = self.path, fresh_path(self.table.sparkSession, "boosting")
        how = {"compression": "none", "parquet.enable.dictionary": "false", "parquet.page.write-checksum.enabled": "false"}
        state.write.options(**how).parquet(self.path)
        old, self.state = self.state, self.session.read.schema(", ".join(f"{c} binary" for c in names)).parquet(self.path)
        if "found" in names:  # read once for each level
            self.state = self.state.persist()
        if before:
            old.unpersist()
            self._delete(before)

    def _active(self) -> list[str]:
        """Scores that take part in the next round."""
        return [t for t in self.targets if not self.ended(t) and len(self.trees[t]) < (self.rounds if self.judged.get(t, 1) else self.grown)]

    def _update(self) -> None:
        """Residuals after the last round, the rows of the next one and its roots."""
        judged, active = self.judged, self._active()  # whoever ends by the loss found now is left out below
        places = [self.targets.index(t) for t in active]
        run = _advance(self.last, places, self.number, self.sizes, self.kind, self.unit, ROW_SHARE)
        names = ("x", "h", "v", "r", "found")
        self._store(self.state.select(*names[:4]).mapInArrow(run, ", ".join(f"{c} binary" for c in names)), names)
        found = sum(np.frombuffer(r.found, np.int64) for r in self.state.select("found").collect())
        n, total = len(self.targets), sum(self.sizes)
        for i, t in enumerate(self.targets):
            judged[t] = int(found[i])
            if judged[t] and len(self.losses[t]) < len(self.trees[t]):
                self.losses[t].append(float(found[n + i]) / SQUARES / judged[t])
        roots = found[2 * n :].reshape(len(active), 2, total)
        self.roots = {t: m for t, m in zip(active, roots) if t in self._active()}

    def _round(self) -> bool:
        """Grow a tree for every active score; False if there is none."""
        if not self.roots:
            return False
        growing = {}
        for t, root in self.roots.items():
            tree = growing[t] = Tree(self.depth, max(self.sizes))
            tree.measured[1] = root
            tree.count[1], tree.sum[1] = (int(a[: self.sizes[0]].sum()) for a in root)
            if not tree.count[1]:
                raise ValueError(f"{t} has no training rows")
        drawn = math.ceil(COLUMN_SHARE * self.columns)
        for level in range(self.depth):
            nodes = range(2**level, 2 ** (level + 1))
            looked = {node: np.random.default_rng([self.seed, self.number, node]).choice(self.columns, drawn, replace=False) for node in nodes}
            for tree in growing.values():
                self._split(tree, [node for node in nodes if node in tree.measured], looked)
            if level + 1 == self.depth:
                break
            self._measure({t: tree for t, tree in growing.items() if (tree.feature[list(nodes)] >= 0).any()}, nodes)
        self.last = [None] * len(self.targets)
        for t, tree in growing.items():
            tree.measured = {}
            # Later trees learn twice the residual, as MLlib's gradient has it.
            weight = 2 * self.step if self.trees[t] else 1.0
            self.trees[t].append(tree)
            self.last[self.targets.index(t)] = (tree.feature, tree.left, np.rint(tree.means() * (weight * 2**DROPPED)).astype(np.int64))
        self.number += 1
        self._update()
        return True

    def _split(self, tree: Tree, nodes: list[int], looked: dict[int, np.ndarray]) -> None:
        """The best split of each node, if one gains."""
        if not nodes:
            return
        both = np.stack([tree.measured[node] for node in nodes])[:, :, self.places] * self.filled
        count, total = both[:, 0].astype(float), both[:, 1].astype(float)
        # Categories are ordered by their mean, empty ones last.
        mean = np.where(count > 0, total / np.maximum(count, 1), np.inf)
        order = np.argsort(np.where(self.ordered[:, None], np.arange(count.shape[2]), mean), axis=2, kind="stable")
        n, s = (np.take_along_axis(a, order, 2).cumsum(2) for a in (count, total))
        all_n, all_s = tree.count[nodes][:, None, None], tree.sum[nodes][:, None, None]
        rest_n, rest_s = all_n - n, all_s - s
        may = (n > 0) & (rest_n > 0) & np.array([np.isin(np.arange(self.columns), looked[node]) for node in nodes])[:, :, None]
        gain = s * s / np.maximum(n, 1) + rest_s * rest_s / np.maximum(rest_n, 1) - all_s * all_s / all_n
        gain = np.where(may, gain, -np.inf).reshape(len(nodes), -1)
        for i, (node, at) in enumerate(zip(nodes, gain.argmax(1))):
            if gain[i, at] <= 1e-12 * tree.sum[node] ** 2 / tree.count[node]:
                continue
            f, b = divmod(int(at), count.shape[2])
            tree.feature[node] = f
            tree.left[node, order[i, f, : b + 1]] = True
            tree.gain[node] = gain[i, at] / tree.count[node] / self.coarse**2
            for child, cn, cs in ((2 * node, n[i, f, b], s[i, f, b]), (2 * node + 1, rest_n[i, f, b], rest_s[i, f, b])):
                tree.count[child], tree.sum[child] = cn, cs

    def _measure(self, growing: dict[str, Tree], nodes: range) -> None:
        """Sums of the children of `nodes`: the smaller of two is measured, the other is the rest."""
        if not growing:
            return
        work, small = [], {}
        for t, tree in growing.items():
            small[t] = [2 * node + int(tree.count[2 * node + 1] < tree.count[2 * node]) for node in nodes if tree.feature[node] >= 0]
            work.append((self.targets.index(t), tree.feature, tree.left, 2 * nodes.start, small[t]))
        run = _level(work, self.number, self.sizes, self.kind, len(self.targets), ROW_SHARE)
        found = sum(np.frombuffer(r.found, np.int64) for r in self.state.select("x", "h", "v", "r").mapInArrow(run, "found binary").collect())
        start, total = 0, sum(self.sizes)
        for t, tree in growing.items():
            size = 2 * len(small[t]) * total
            each = found[start : start + size].reshape(2, len(small[t]), total)
            start += size
            for i, node in enumerate(small[t]):
                parent = tree.measured.pop(node // 2)
                tree.measured[node] = each[:, i]
                tree.measured[node ^ 1] = parent - each[:, i]

    def node_rows(self, target: str, n: int) -> list[tuple]:
        """The first `n` trees of a score as MLlib writes them, nodes in preorder.  The sums of
        squares are not kept, so the impurities are NaN."""
        rows, nan = [], float("nan")
        for number, tree in enumerate(self.trees[target][:n]):
            scale = (2.0 if number else 1.0) / self.coarse
            means = tree.means() * scale
            made: list[list] = []
            ready = [(1, None)]
            while ready:
                node, link = ready.pop()
                place = len(made)
                if link is not None:
                    made[link[0]][link[1]] = place
                split = node < len(tree.feature) and tree.feature[node] >= 0
                stats = [float(tree.count[node]), float(tree.sum[node] * scale), nan]
                row = [place, float(means[node]), nan, stats, int(tree.count[node]), -1.0, -1, -1, (-1, [], -1)]
                if split:
                    f = int(tree.feature[node])
                    on_left = np.flatnonzero(tree.left[node])
                    row[5] = float(tree.gain[node]) * (4.0 if number else 1.0)
                    row[8] = (f, [float(c) for c in on_left], self.counts[f]) if f in self.counts else (f, [float(self.cuts[f][on_left[-1]])], -1)
                    ready += [(2 * node + 1, (place, 7)), (2 * node, (place, 6))]
                made.append(row)
            rows += [(number, tuple(row)) for row in made]
        return rows


NODE = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
    "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


class BlockRegressor(GBTRegressor):
    """MLlib's regressor whose trees `boosting` grows, for one of its targets."""

    boosting: Boosting
    target: str

    @classmethod
    def over(cls, boosting: Boosting, target: str, n: int) -> BlockRegressor:
        made = cls(
            maxDepth=boosting.depth, stepSize=boosting.step, subsamplingRate=ROW_SHARE, featureSubsetStrategy=str(COLUMN_SHARE),
            maxIter=n, maxBins=boosting.bins, seed=boosting.seed,
        )
        made.boosting, made.target = boosting, target
        return made

    def _fit_java(self, dataset: DataFrame):
        self._transfer_params_to_java()
        grown = self.boosting
        n = grown.grow(self.target, self.getMaxIter())
        return saved_model(self, grown.node_rows(self.target, n), n, grown.columns, grown.step)


def saved_model(regressor: BlockRegressor, nodes: list[tuple], n: int, columns: int, step: float):
    """MLlib's model (the Java one) of the nodes of its trees, by way of its saved form."""
    spark = regressor.boosting.table.sparkSession
    path = fresh_path(spark, "trees")
    plain = lambda params: {p.name: v for p, v in params.items() if p.name != "weightCol"}
    about = {
        "class": "org.apache.spark.ml.regression.GBTRegressionModel",
        "timestamp": 0,
        "sparkVersion": spark.version,
        "uid": regressor.uid,
        "paramMap": plain(regressor._paramMap),
        "defaultParamMap": plain(regressor._defaultParamMap),
    }
    tree = about | {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "paramMap": {"maxDepth": regressor.getMaxDepth()}}
    tree["defaultParamMap"] = {k: v for k, v in about["defaultParamMap"].items() if k in TREE_PARAMS}
    weights = [(i, json.dumps(tree | {"uid": f"{regressor.uid}_{i}"}), step if i else 1.0) for i in range(n)]
    whole = json.dumps(about | {"numFeatures": columns, "numTrees": n})
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(weights, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(nodes, NODE).coalesce(1).write.parquet(f"{path}/data")
    return spark.sparkContext._jvm.org.apache.spark.ml.regression.GBTRegressionModel.load(path)


TREE_PARAMS = (
    "cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB",
    "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed",
)
