"""Tree classifiers (X3) on sparse TF-IDF vectors.

MLlib's own fit turns every vector into a dense array of bins, one per vocabulary
entry, and sends a histogram as wide as the vocabulary for each node: work and
memory grow with rows x vocabulary.  Here the same trees come from the entries
that occur.  Parameters, thresholds, gains, ties, stopping, pruning and boosting
are MLlib's; the result is an MLlib model.

1. The values of each term are counted, which gives its thresholds (MLlib takes
   them from about 10,000 rows; here all rows count).  A split is a number:
   thresholds are numbered term by term.
2. Each entry becomes the number of the highest threshold below its value.  Rows
   are written once, in blocks of such numbers; entries below all are left out.
3. For each level a task walks its rows down the trees grown so far, adds up
   (rows, target, target squared) per node and number, and sends the sums that
   occur to parts of the numbers, which give their best split per node.

Sums over a term's numbers from one upwards are the right side of that split; the
left side is the node's total less these.  The driver sees one row per part and node.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ready, scratch_path

ENTRIES = 1 << 20        # entries of a block; it bounds memory only
CELLS = 1 << 23          # sums that a task holds at once; nodes beyond take another pass
DIGITS = 10              # of a gain; below, splits are equal
BLOCKS = "block long, labels binary, sizes binary, numbers binary"


# --------------------------------------------------------------- thresholds

def chosen(values: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """Whether a threshold lies before each value, where a term has more values than
    it may have thresholds: MLlib's choice, about equal numbers of rows between them."""
    stride, upto, out = counts.sum() / (most + 1), np.cumsum(counts), np.zeros(len(values), bool)
    target = stride
    for i in range(1, len(values)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            out[i] = True
            target += stride
    return out


def thresholds(held: pd.DataFrame, rows: int, most: int) -> pd.DataFrame:
    """``(term, threshold)`` from ``(term, value, n)`` of all values but 0."""
    zeros = rows - held.groupby("term")["n"].sum()
    zeros = pd.DataFrame({"term": zeros.index, "value": 0.0, "n": zeros.to_numpy()})
    held = pd.concat([held, zeros[zeros["n"] > 0]]).sort_values(["term", "value"], ignore_index=True)
    term, value, n = (held[c].to_numpy() for c in ("term", "value", "n"))
    before = np.r_[False, term[1:] == term[:-1]]
    starts = np.flatnonzero(~before)
    for a, b in zip(starts, np.r_[starts[1:], len(term)]):
        if b - a - 1 > most:
            before[a:b] = chosen(value[a:b], n[a:b], most)
    at = np.flatnonzero(before)
    return pd.DataFrame({"term": term[at].astype(np.int32), "threshold": (value[at - 1] + value[at]) / 2.0})


def _entries(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries other than 0 of a batch of vectors: row, term, value."""
    kind, _, indices, values = batch.column(column).flatten()
    sizes = pc.list_value_length(values).to_numpy()
    sparse = np.repeat(kind.to_numpy() == 0, sizes)
    terms = np.arange(len(sparse)) - np.repeat(np.cumsum(sizes) - sizes, sizes)  # right for dense vectors
    terms[sparse] = indices.flatten().to_numpy()
    values = values.flatten().to_numpy()
    keep = values != 0
    return np.repeat(np.arange(len(sizes)), sizes)[keep], terms[keep], values[keep]


def split_table(data: DataFrame, column: str, rows: int, bins: int) -> pd.DataFrame:
    """``(term, threshold)`` of every possible split, in order: at most ``bins - 1`` per term."""
    most = min(bins, rows) - 1

    def count(batches):
        for batch in batches:
            _, terms, values = _entries(batch, column)
            held = pd.DataFrame({"term": terms, "value": values}).groupby(["term", "value"], as_index=False).size()
            yield pa.RecordBatch.from_pandas(held.astype({"term": "int32", "size": "int64"}), preserve_index=False)

    def cut(t):
        return pa.Table.from_pandas(thresholds(t.drop_columns("part").to_pandas(), rows, most), preserve_index=False)
    values = (data.select(column).mapInArrow(count, "term int, value double, size long")
              .groupBy("term", "value").agg(F.sum("size").alias("n")))
    found = (values.withColumn("part", F.col("term") % 64).groupBy("part")
             .applyInArrow(cut, "term int, threshold double").toPandas())
    return found.sort_values(["term", "threshold"], ignore_index=True)


# ------------------------------------------------------------------- blocks

def numbered(terms: np.ndarray, values: np.ndarray, first: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """The number of the highest threshold below each value; -1 for none."""
    out = np.full(len(terms), -1, np.int32)
    at, end, open_ = first[terms], first[terms + 1], np.arange(len(terms))
    while len(open_):
        open_ = open_[at[open_] < end[open_]]
        open_ = open_[values[open_] > limits[at[open_]]]
        out[open_] = at[open_]
        at[open_] += 1
    return out


def blocks(data: DataFrame, column: str, label: str, splits: pd.DataFrame, width: int) -> DataFrame:
    """The rows in blocks of threshold numbers (``BLOCKS``), written once."""
    spark = data.sparkSession
    first = np.searchsorted(splits["term"].to_numpy(), np.arange(width + 1)).astype(np.int32)
    table = spark.sparkContext.broadcast((first, splits["threshold"].to_numpy()))

    def run(batches):
        from pyspark import TaskContext
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def close():
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), *(pa.array([np.concatenate(x).tobytes()], pa.binary()) for x in zip(*held))],
                names=["block", "labels", "sizes", "numbers"])
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                rows, terms, values = _entries(part, column)
                numbers = numbered(terms, values, *table.value)
                sizes = np.bincount(rows[numbers >= 0], minlength=part.num_rows).astype(np.int32)
                labels = np.asarray(part.column(label).to_pylist()).astype(np.uint8)
                held.append((labels, sizes, numbers[numbers >= 0]))
                size += int(sizes.sum())
                if size >= ENTRIES:
                    yield close()
                    number, held, size = number + 1, [], 0
        if held:
            yield close()
    path = scratch_path(spark, "trees", "blocks")
    data.select(column, label).mapInArrow(run, BLOCKS).write.parquet(path)
    return spark.read.schema(BLOCKS).parquet(path)


# -------------------------------------------------------------------- trees

@dataclass
class Tree:
    """Nodes by heap number (root 1): the split's number (-1: leaf) and the node's sums."""
    depth: int
    split: np.ndarray = None
    gain: dict[int, float] = field(default_factory=dict)
    sums: dict[int, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        self.split = np.full(2 << self.depth, -1, np.int64)

    def mean(self) -> np.ndarray:
        out = np.zeros(len(self.split))
        for k, (n, s, _) in self.sums.items():
            out[k] = s / n if n else 0.0
        return out


class Rows:
    """A block's rows, and where they stand in trees."""

    def __init__(self, labels: bytes, sizes: bytes, numbers: bytes):
        self.label = np.frombuffer(labels, np.uint8).astype(np.float64)
        sizes = np.frombuffer(sizes, np.int32)
        self.row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.number = np.frombuffer(numbers, np.int32)

    def nodes(self, trees: list[np.ndarray], spans: dict[int, tuple[int, int]], total: int) -> list[np.ndarray]:
        """Each row's node in each tree.  ``spans`` has the numbers of a split's term."""
        used = sorted({spans[int(s)] for t in trees for s in t[t >= 0]})
        column = np.zeros(total + 1, np.int16)
        for i, (a, b) in enumerate(used):
            column[a:b] = i + 1
        where = column[self.number]
        hit = np.flatnonzero(where)
        held = np.full((len(self.label), len(used) + 1), -1, np.int32)
        held[self.row[hit], where[hit]] = self.number[hit]
        every, out = np.arange(len(self.label)), []
        for t in trees:
            node = np.ones(len(self.label), np.int64)
            for _ in range(int(len(t)).bit_length() - 2):
                s = t[node]
                node = np.where(s >= 0, 2 * node + (held[every, column[s]] >= s), node)
            out.append(node)
        return out


def _side(sums: np.ndarray) -> np.ndarray:
    n, s = sums[..., 0], sums[..., 1]
    return np.divide(s * s, n, out=np.zeros_like(s), where=n > 0)


def best_splits(sums: np.ndarray, total: np.ndarray, end: np.ndarray, allowed: np.ndarray) -> list[tuple]:
    """``(gain, place, sums of the right side)`` per node: the largest reduction of
    variance, of equal ones the first.  ``sums`` is (node, number, 3) and ``end``
    the place after the last number of a number's term."""
    above = np.zeros((sums.shape[0], sums.shape[1] + 1, 3))
    above[:, :-1] = np.cumsum(sums[:, ::-1], axis=1)[:, ::-1]
    right = above[:, :-1] - above[:, end]
    left = total[:, None] - right
    gain = (_side(left) + _side(right) - _side(total)[:, None]) / np.maximum(total[:, None, 0], 1)
    gain = np.where((right[..., 0] >= 1) & (left[..., 0] >= 1) & allowed, gain.round(DIGITS), -1.0)
    at = gain.argmax(axis=1)
    return [(float(gain[k, i]), int(i), right[k, i]) for k, i in enumerate(at)]


class Learner:
    """Grows trees over one set of blocks."""

    def __init__(self, data: DataFrame, column: str, label: str, bins: int, depth: int):
        first = data.select(column).first()
        self.width, self.depth = len(first[0]), depth
        self.splits = split_table(data, column, data.count(), bins)
        self.blocks = blocks(data, column, label, self.splits, self.width)
        term = self.splits["term"].to_numpy()
        self.term, self.total = term, len(term)
        self.start = np.searchsorted(term, term).astype(np.int64)
        self.end = np.searchsorted(term, term, side="right").astype(np.int64)
        self.parts = data.sparkSession.sparkContext.defaultParallelism

    def span(self, split: int) -> tuple[int, int]:
        return int(self.start[split]), int(self.end[split])

    def _level(self, trees: list[Tree], nodes: list[tuple[int, int]], target, allowed) -> dict:
        """The best split of ``nodes`` (tree, node): ``(gain, number, right sums, node's sums)``.

        ``allowed`` has the terms that a node may split on (None: all)."""
        total, depth_trees = self.total, [t.split for t in trees]
        spans = {int(s): self.span(int(s)) for t in (*depth_trees, *target.earlier) for s in t[t >= 0]}
        groups = []  # (tree, its nodes, the numbers they may split on, which node may use which)
        for tree in dict.fromkeys(t for t, _ in nodes):
            own = [k for t, k in nodes if t == tree]
            if allowed is None:
                step = max(1, CELLS // max(total, 1))
                groups += [(tree, own[i:i + step], None, None) for i in range(0, len(own), step)]
            else:
                mine = [np.isin(self.term, allowed[tree, k]) for k in own]
                numbers = np.flatnonzero(np.any(mine, axis=0))
                groups.append((tree, own, numbers, np.stack([m[numbers] for m in mine])))
        out = {}
        while groups:  # as many at once as a task can hold
            now, cells = [], 0
            while groups and (not now or cells + len(groups[0][1]) * self._width(groups[0]) <= CELLS):
                now.append(groups.pop(0))
                cells += len(now[-1][1]) * self._width(now[-1])
            out |= self._pass(depth_trees, now, spans, target)
        return out

    def _width(self, group) -> int:
        return self.total if group[2] is None else len(group[2])

    def _pass(self, trees: list[np.ndarray], groups: list, spans: dict, target) -> dict:
        total = self.total
        parts = self.parts if groups[0][2] is None else 1
        sent = [(tree, own, numbers) for tree, own, numbers, _ in groups]
        widths = [self._width(g) for g in groups]
        bounds = [np.linspace(0, w, parts + 1).astype(np.int64) for w in widths]
        for b, w, (_, _, numbers, _) in zip(bounds, widths, groups):  # a term's numbers stay together
            if numbers is None and w:
                b[1:-1] = self.start[np.minimum(b[1:-1], w - 1)]

        def add(batches):
            held = [np.zeros((3, len(own) * w)) for (_, own, _), w in zip(sent, widths)]
            whole = [np.zeros((3, len(own))) for _, own, _ in sent]
            for batch in batches:
                for block, labels, sizes, numbers in zip(*(batch.column(i).to_pylist() for i in range(4))):
                    rows = Rows(labels, sizes, numbers)
                    nodes = rows.nodes([*trees, *target.earlier], spans, total)
                    y = target.of(rows.label, nodes[len(trees):])
                    weights = target.weights(block, len(y))
                    for (tree, own, some), w, h, t in zip(sent, widths, held, whole):
                        place = np.full(len(trees[tree]), -1, np.int64)
                        place[own] = np.arange(len(own))
                        at = place[nodes[tree]]
                        one = np.ones(len(y)) if weights is None else weights[:, tree].astype(np.float64)
                        inside = at >= 0
                        if some is None:
                            keep = np.flatnonzero(inside[rows.row])
                            number = rows.number[keep]
                        else:
                            local = np.full(total, -1, np.int64)
                            local[some] = np.arange(len(some))
                            number = local[rows.number]
                            keep = np.flatnonzero((number >= 0) & inside[rows.row])
                            number = number[keep]
                        row = rows.row[keep]
                        key = at[row] * w + number
                        for p, x in enumerate((one, one * y, one * y * y)):
                            h[p] += np.bincount(key, x[row], h.shape[1])
                            t[p] += np.bincount(at[inside], x[inside], t.shape[1])
            for g, ((_, own, _), w, h, t, b) in enumerate(zip(sent, widths, held, whole, bounds)):
                h = h.reshape(3, len(own), w)
                for part in range(parts):
                    cell = h[:, :, b[part]:b[part + 1]].reshape(3, -1)
                    some = np.flatnonzero(cell[0])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([g], pa.int32()), pa.array([part], pa.int32()),
                         pa.array([some.tobytes()], pa.binary()), pa.array([cell[:, some].tobytes()], pa.binary()),
                         pa.array([t.tobytes()], pa.binary())], names=["grp", "part", "cells", "sums", "whole"])
        ends = self.blocks.sparkSession.sparkContext.broadcast(self.end)
        terms = [None if numbers is None else self.term[numbers] for _, _, numbers, _ in groups]
        masks = [mask for *_, mask in groups]

        def choose(key, t):
            g, part = (k.as_py() for k in key)
            _, own, some = sent[g]
            a, b = bounds[g][part:part + 2]
            cells = np.zeros((3, len(own) * (b - a)))
            whole = np.zeros((3, len(own)))
            # in a fixed order, so that rounding does not depend on which task came first
            for at, sums, every in sorted(zip(*(t.column(c).to_pylist() for c in ("cells", "sums", "whole")))):
                at = np.frombuffer(at, np.int64)
                cells[:, at] += np.frombuffer(sums).reshape(3, -1)
                whole += np.frombuffer(every).reshape(3, -1)
            if some is None:
                end, allowed = ends.value[a:b] - a, np.ones((len(own), b - a), bool)
            else:
                end, allowed = np.searchsorted(terms[g], terms[g], side="right"), masks[g]
            found = ([(-1.0, 0, np.zeros(3))] * len(own) if a == b else
                     best_splits(cells.reshape(3, len(own), -1).transpose(1, 2, 0), whole.T, end, allowed))
            return pa.table({"grp": pa.array([g] * len(own), pa.int32()), "node": pa.array(own, pa.int64()),
                             "gain": [x[0] for x in found],
                             "number": pa.array([int(a) + x[1] if some is None or a == b else int(some[x[1]]) for x in found], pa.int64()),
                             "right": pa.array([x[2].tolist() for x in found], pa.list_(pa.float64())),
                             "whole": pa.array(whole.T.tolist(), pa.list_(pa.float64()))})
        found = (self.blocks.mapInArrow(add, "grp int, part int, cells binary, sums binary, whole binary")
                 .groupBy("grp", "part").applyInArrow(
                     choose, "grp int, node long, gain double, number long, right array<double>, whole array<double>")
                 .collect())
        ends.destroy()
        out: dict = {}
        for r in sorted(found, key=lambda r: (-r.gain, r.number)):
            out.setdefault((groups[r.grp][0], r.node), (r.gain, r.number, np.asarray(r.right), np.asarray(r.whole)))
        return out

    def grow(self, count: int, target, subset=None) -> list[Tree]:
        """``count`` trees, level by level and together."""
        trees = [Tree(self.depth) for _ in range(count)]
        nodes = [(t, 1) for t in range(count)]
        for level in range(self.depth):
            allowed = subset and {x: subset(*x) for x in nodes}
            found, nodes = self._level(trees, nodes, target, allowed), []
            for (t, k), (gain, number, right, whole) in sorted(found.items()):
                tree = trees[t]
                tree.sums[k] = whole
                if gain <= 0:
                    continue
                tree.split[k], tree.gain[k] = number, gain
                for child, sums in ((2 * k, whole - right), (2 * k + 1, right)):
                    tree.sums[child] = sums
                    if level + 1 < self.depth and sums[2] - sums[1] * sums[1] / sums[0] > 1e-12 * sums[0]:
                        nodes.append((t, child))
            if not nodes:
                break
        return trees


class Labels:
    """The target of a classifier: the label, each tree with its own weights if ``bagged``."""
    earlier: tuple = ()

    def __init__(self, trees: int = 0, rate: float = 1.0, seed: int = 0):
        self.trees, self.rate, self.seed = trees, rate, seed

    def of(self, label: np.ndarray, nodes: list[np.ndarray]) -> np.ndarray:
        return label

    def weights(self, block: int, rows: int) -> np.ndarray | None:
        if not self.trees:
            return None
        return np.random.default_rng([self.seed & 0xFFFFFFFF, block]).poisson(self.rate, (rows, self.trees))


class Residuals(Labels):
    """The target of boosting: the label as -1 or 1, then the log loss's negative
    gradient at the sum of the trees before."""

    def __init__(self, earlier: list[Tree], step: float):
        super().__init__()
        self.earlier = [t.split for t in earlier]
        self.means = [t.mean() * (step if i else 1.0) for i, t in enumerate(earlier)]

    def of(self, label: np.ndarray, nodes: list[np.ndarray]) -> np.ndarray:
        y = 2.0 * label - 1.0
        if not self.means:
            return y
        return 4.0 * y / (1.0 + np.exp(2.0 * y * sum(m[n] for m, n in zip(self.means, nodes))))


# ------------------------------------------------------------------- models

def _node(tree: Tree, k: int, learner: Learner, jvm, gateway, binary: bool):
    """An MLlib node; equal leaves are merged, as in MLlib."""
    n, s, q = map(float, tree.sums[k])
    stats = gateway.new_array(gateway.jvm.double, 2 if binary else 3)
    for i, x in enumerate((n - s, s) if binary else (n, s, q)):
        stats[i] = x
    calculators = jvm.org.apache.spark.mllib.tree.impurity
    held = (calculators.GiniCalculator if binary else calculators.VarianceCalculator)(stats, int(n))
    prediction, impurity = held.predict(), held.calculate()
    make = jvm.org.apache.spark.ml.tree
    if tree.split[k] < 0:
        return make.LeafNode(prediction, impurity, held), prediction
    (left, a), (right, b) = (_node(tree, c, learner, jvm, gateway, binary) for c in (2 * k, 2 * k + 1))
    if a is not None and a == b:
        return make.LeafNode(a, impurity, held), a
    number = int(tree.split[k])
    cut = make.ContinuousSplit(int(learner.term[number]), float(learner.splits["threshold"].iloc[number]))
    gain = tree.gain[k] * (2.0 if binary else 1.0)  # Gini is twice the variance of a 0/1 label
    return make.InternalNode(prediction, impurity, gain, left, right, cut, held), None


def fit(estimator, data: DataFrame):
    """The MLlib model of a ``DecisionTreeClassifier``, ``RandomForestClassifier`` or
    ``GBTClassifier`` with its parameters, fitted on sparse vectors and labels 0 and 1."""
    spark = ready(data.sparkSession)
    gateway = spark.sparkContext._gateway
    jvm = gateway.jvm
    name = type(estimator).__name__
    learner = Learner(data, estimator.getFeaturesCol(), estimator.getLabelCol(), estimator.getMaxBins(),
                      estimator.getMaxDepth())
    models = jvm.org.apache.spark.ml

    def array(kind, items):
        out = gateway.new_array(kind, len(items))
        for i, x in enumerate(items):
            out[i] = x
        return out

    def roots(trees, binary):
        return [_node(t, 1, learner, jvm, gateway, binary)[0] for t in trees]
    make = models.classification.DecisionTreeClassificationModel
    if name == "DecisionTreeClassifier":
        (root,) = roots(learner.grow(1, Labels()), True)
        made = make(estimator.uid, root, learner.width, 2)
    elif name == "RandomForestClassifier":
        seed, k = estimator.getSeed(), int(np.ceil(np.sqrt(learner.width)))
        trees = learner.grow(estimator.getNumTrees(), Labels(estimator.getNumTrees(), estimator.getSubsamplingRate(), seed),
                             lambda t, node: np.random.default_rng([seed & 0xFFFFFFFF, t, node]).choice(
                                 learner.width, k, replace=False, shuffle=False))
        own = [make(f"dtc_{estimator.uid}_{i}", r, learner.width, 2) for i, r in enumerate(roots(trees, True))]
        made = models.classification.RandomForestClassificationModel(estimator.uid, array(make, own), learner.width, 2)
    else:
        trees: list[Tree] = []
        for _ in range(estimator.getMaxIter()):
            trees += learner.grow(1, Residuals(trees, estimator.getStepSize()))
        make = models.regression.DecisionTreeRegressionModel
        own = [make(f"dtr_{estimator.uid}_{i}", r, learner.width) for i, r in enumerate(roots(trees, False))]
        steps = array(jvm.double, [1.0] + [float(estimator.getStepSize())] * (len(own) - 1))
        made = models.classification.GBTClassificationModel(estimator.uid, array(make, own), steps, learner.width, 2)
    estimator._transfer_params_to_java()
    made = estimator._java_obj.copyValues(made, estimator._java_obj.extractParamMap())
    return estimator._copyValues(estimator._create_model(made))
