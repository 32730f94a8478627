"""Hard negatives by threshold joins: an inverted index that leaves out what suffix norms cover, with thresholds lowered until windows fill."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm.common import cut

#: Bytes of vectors in a block, and rows of a block at most; anchors of a block at most; dimensions whose postings are taken at once.
BLOCK_BYTES, ROWS, ANCHORS, STEP = 16 << 20, 4096, 1024, 8
#: How far below a window's top the threshold lies, as shares of the window, in the order tried.
LOWERED = (0.125, 0.5, 1.0)


def suffix_norms(rows: np.ndarray) -> np.ndarray:
    """Norms of what is left from each dimension on: column m for dimensions m and later, the last column 0. Rounded up."""
    out = np.zeros((len(rows), rows.shape[1] + 1))
    out[:, :-1] = np.sqrt(np.cumsum((rows * rows)[:, ::-1], axis=1))[:, ::-1]
    return out * (1 + 1e-9)


def exact_scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products of rows, exact: in 64 bits where they fit, else in whole numbers of any size, held to the range of a long."""
    most = [int(np.abs(x).max(initial=0)) for x in (left, right)]
    if most[0] * most[1] * max(left.shape[1], 1) < 1 << 53:
        return np.einsum("ij,ij->i", left, right).astype(np.int64)
    limit = (1 << 63) - 1
    return np.array([max(-limit, min(limit, sum(int(x) * int(y) for x, y in zip(a, b, strict=True)))) for a, b in zip(left, right, strict=True)], np.int64)


class ThresholdIndex:
    """Postings by dimension, those with the most energy first.

    A row's dimensions from m on are left out where the norms of what is left there, its own and the largest of the anchors, stay
    below the least threshold: a pair that meets in no posting cannot reach it.
    """

    def __init__(self, rows: np.ndarray):
        self.order = np.argsort(-(rows * rows).sum(axis=0), kind="stable")
        self.exact, self.rows = rows, np.ascontiguousarray(rows[:, self.order])
        self.rest = suffix_norms(self.rows)

    def search(self, anchors: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all pairs with a score of at least the anchor's threshold."""
        found = []
        for low in range(0, len(anchors), 128):
            found.append(self._search(anchors[low : low + 128], thresholds[low : low + 128], low))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3

    def _search(self, exact, thresholds, base):
        anchors = exact[:, self.order]
        ahead, width = suffix_norms(anchors), anchors.shape[1]
        least = thresholds.min()
        covered = self.rest * ahead.max(axis=0) < least
        covered[:, -1] = True
        kept = np.minimum(-(-covered.argmax(axis=1) // STEP) * STEP, width)  # whole steps of dimensions are posted
        rows = np.argsort(-kept, kind="stable")
        if least > 0:
            rows = rows[kept[rows] > 0]  # no posting at all: never met
        partial = np.zeros((len(anchors), len(rows)))
        slack = 1e-9 * ahead[:, 0].max() * self.rest[:, 0].max(initial=0) + 1e-6
        for d in range(0, width, STEP):
            posted = int(np.searchsorted(-kept[rows], -d, "left"))  # rows with a posting here stand first
            if not posted:
                break
            e = min(d + STEP, width)
            partial[:, :posted] += anchors[:, d:e] @ self.rows[rows[:posted], d:e].T
            at = np.minimum(kept[rows], e)
            hope = (partial + ahead[:, at] * self.rest[rows, at] >= thresholds[:, None] - slack).any(axis=0)
            if not hope.all():
                rows, partial = rows[hope], partial[:, hope]
        at = kept[rows]
        i, j = np.nonzero(partial + ahead[:, at] * self.rest[rows, at] >= thresholds[:, None] - slack)
        j = rows[j]
        scores = [exact_scores(exact[i[k : k + 65536]], self.exact[j[k : k + 65536]]) for k in range(0, len(i), 65536)]
        scores = np.concatenate(scores) if scores else np.zeros(0, np.int64)
        good = scores >= thresholds[i]
        return i[good] + base, j[good], scores[good]


def _matrix(lists, width: int) -> np.ndarray:
    """Rows of numbers; what a list lacks is zero."""
    out = np.zeros((len(lists), width))
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def _best(found, ids: np.ndarray):
    """The pairs by anchor, best first: (anchor, row, score) in order of anchor, score downwards, id."""
    i, j, s = found
    order = np.lexsort((ids[j], -s, i))
    return i[order], j[order], s[order]


def _positives(wanted: int):
    """For two blocks of one label: each anchor's best rows in the block, itself left out."""

    def run(anchors, rows):
        import pyarrow as pa

        ids, own = rows.column("vec_id").to_numpy(), anchors.column("vec_id").to_numpy()
        lists, queries = rows.column("vector").to_pylist(), anchors.column("vector").to_pylist()
        width = max([1, *map(len, lists), *map(len, queries)])
        matrix, queries = _matrix(lists, width), _matrix(queries, width)
        thresholds = np.full(len(own), -np.inf)
        first = matrix[:256]  # the wanted-th best of some rows is a bound for all
        if len(first) > wanted:
            bound = queries @ first.T
            bound[own[:, None] == ids[None, : len(first)]] = -np.inf
            thresholds = np.partition(bound, -wanted, axis=1)[:, -wanted]
            thresholds -= 1e-9 * np.abs(thresholds) + 1e-6
        i, j, s = ThresholdIndex(matrix).search(queries, thresholds) if len(own) and len(ids) else (np.zeros(0, np.int64),) * 3
        other = own[i] != ids[j]
        i, j, s = _best((i[other], j[other], s[other]), ids)
        top = np.arange(len(i)) - np.searchsorted(i, i) < wanted
        return pa.table({"anchor_id": own[i[top]], "positive_id": ids[j[top]], "positive_score": s[top]})

    return run


def _negatives(wanted: int, low: int, high: int):
    """For two blocks: the best rows of another label in each window of each anchor. Thresholds begin near the windows' tops and go down for those anchors whose windows the block has not filled."""

    def run(anchors, rows):
        import pyarrow as pa

        ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        own, own_label = anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy()
        lists, queries = rows.column("vector").to_pylist(), anchors.column("vector").to_pylist()
        width = max([1, *map(len, lists), *map(len, queries)])
        index, queries = ThresholdIndex(_matrix(lists, width)), _matrix(queries, width)
        # whole scores n with low * positive <= 100 * n <= high * positive
        windows = [(a, w["positive_id"], p, -(-low * p // 100), high * p // 100) for a, ws in enumerate(anchors.column("windows").to_pylist()) for w in ws if (p := w["positive_score"]) >= 0]
        out: list[tuple] = []
        for share in LOWERED:
            if not windows or not len(ids):
                break
            floors = [max(lo, hi - int(share * (hi - lo) + 0.5)) if share < 1 else lo for _, _, _, lo, hi in windows]
            active = np.unique([w[0] for w in windows])
            thresholds = np.full(len(own), np.inf)
            np.minimum.at(thresholds, [w[0] for w in windows], floors)
            i, j, s = index.search(queries[active], thresholds[active])
            i = active[i]
            other = own_label[i] != labels[j]
            i, j, s = _best((i[other], j[other], s[other]), ids)
            bounds = np.searchsorted(i, np.arange(len(own) + 1))
            left = []
            for window, floor in zip(windows, floors, strict=True):
                a, positive, p, lo, hi = window
                x, y = bounds[a], bounds[a + 1]
                x += np.searchsorted(-s[x:y], -hi, "left")
                y = min(x + wanted, x + np.searchsorted(-s[x:y], -floor, "right"))
                if y - x == wanted or floor == lo:
                    out += [(own[a], positive, p, ids[j[k]], s[k]) for k in range(x, y)]
                else:
                    left.append(window)
            windows = left
        names = ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")
        return pa.table({c: pa.array([int(r[k]) for r in out], pa.int64()) for k, c in enumerate(names)})

    return run


def _dealt(key: str, parts) -> F.Column:
    return F.pmod(F.xxhash64("vec_id", F.lit(key)), parts).cast("int")


def _pieces(n, most: int) -> F.Column:
    return F.greatest(F.lit(1), F.ceil(n / most)).cast("int")


def hard_negatives(vectors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """For each anchor and each of its positives, up to ``negatives`` rows of another label whose score lies between ``low`` and ``high`` percent of the positive's: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors``: vec_id, label, vector (whole numbers), anchor (boolean); other columns are ignored. A score is the inner product
    with the anchor; higher ones come first, equal ones by vec_id. An anchor's positives are its first other rows of its label.

    Anchors and rows are dealt into blocks of bounded bytes, and each pair of blocks is a task's group: one of equal labels for
    positives, any for negatives, so that neither a hot label nor a group of copies meets in one task. Within blocks a
    ``ThresholdIndex`` finds pairs; thresholds begin near the windows' tops and go down only for anchors with windows that are
    not filled. Each block hands on the few best rows of a window, and the best of these are the result. The work is anchors times rows less what norms exclude.

    Rows whose vec_id, label or vector is null, or whose vector holds null, take no part; shorter vectors count as filled up with
    zeros; rows of a repeated vec_id count as one, the least. An anchor without positives or windows without rows give no rows,
    an empty table none. Scores beyond a long are held to its range.
    """
    rows = vectors.where("vec_id is not null and label is not null and vector is not null and not exists(vector, x -> x is null)")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("vector").cast("array<double>").alias("vector"), F.coalesce("anchor", F.lit(False)).alias("anchor"))
    rows = cut(rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector", "anchor")).alias("r")).select("vec_id", "r.*"))
    n, n_anchors, width = rows.agg(F.count("*"), F.count(F.when(F.col("anchor"), 1)), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
    fit = max(16, BLOCK_BYTES // (8 * max(1, width)))
    most_rows, most_anchors = min(ROWS, fit), min(ANCHORS, fit)
    anchors = rows.where("anchor").select(*[F.col(c).alias(c) for c in ("vec_id", "label", "vector")])  # columns of their own, as both sides stem from one table

    sizes = cut(rows.groupBy("label").agg(_pieces(F.count("*"), most_rows).alias("parts"), _pieces(F.count(F.when(F.col("anchor"), 1)), most_anchors).alias("anchor_parts"), F.max("anchor").alias("any")).where("any"))
    each = lambda parts: F.explode(F.sequence(F.lit(0), parts - 1))
    sized = lambda df: df.select("vec_id", "label", "vector").join(sizes, "label")
    left = sized(anchors).select("label", each(F.col("parts")).alias("part"), _dealt("a", F.col("anchor_parts")).alias("anchor_part"), "vec_id", "vector")
    right = sized(rows).select("label", _dealt("r", F.col("parts")).alias("part"), each(F.col("anchor_parts")).alias("anchor_part"), "vec_id", "vector")
    block = ["label", "part", "anchor_part"]
    found = left.groupBy(*block).cogroup(right.groupBy(*block)).applyInArrow(_positives(positives), "anchor_id long, positive_id long, positive_score long")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    chosen = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= positives)
    windows = cut(chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("windows")))

    parts, anchor_parts = (F.lit(max(1, -(-k // most))) for k, most in ((n, most_rows), (n_anchors, most_anchors)))
    left = anchors.join(windows, "vec_id").select(each(parts).alias("part"), _dealt("a", anchor_parts).alias("anchor_part"), "vec_id", "label", "vector", "windows")
    right = rows.select(_dealt("r", parts).alias("part"), each(anchor_parts).alias("anchor_part"), "vec_id", "label", "vector")
    block = ["part", "anchor_part"]
    found = left.groupBy(*block).cogroup(right.groupBy(*block)).applyInArrow(_negatives(negatives, low, high), "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
