"""Toxicity from the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, distance-weighted votes, calibrated scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.llm.common import SLICE, cut, small_side, span_hashes, text_blocks
from tallyflow.llm.labelled import fold, logistic, training_rows

#: Bytes of letters; all others separate words. Bytes of other scripts count as letters.
_LETTER = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])
#: Distinct terms that a task counts before it hands them on.
_FLUSH = 400_000


def term_sets(column):
    """For each text of an Arrow string array, in order: the sorted 64-bit hashes of its distinct lower-cased words, and how often each occurs."""
    import pyarrow.compute as pc

    for _, data, offsets in text_blocks(column, change=pc.utf8_lower):
        letter = np.zeros(len(data) + 2, np.int8)
        letter[1:-1] = _LETTER[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        change = np.diff(letter)
        starts = np.flatnonzero((change > 0) | (first & (letter[1:] > 0)))
        ends = np.flatnonzero((change < 0) | (first & (letter[:-1] > 0)))
        hashes = span_hashes(data, starts, ends)
        bounds = np.searchsorted(starts, offsets)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield np.unique(hashes[a:b], return_counts=True)


def _frequencies(batches):
    """(term, toxic, clean): in how many toxic and clean training texts each term occurs."""
    import pyarrow as pa

    held: list[list[np.ndarray]] = [[], []]

    def rows():
        parts = [np.unique(np.concatenate([np.zeros(0, np.uint64), *h]), return_counts=True) for h in held]
        terms = np.union1d(parts[0][0], parts[1][0])
        out = [np.zeros(len(terms), np.int64) for _ in parts]
        for column, (t, n) in zip(out, parts, strict=True):
            column[np.searchsorted(terms, t)] = n
        held[0].clear()
        held[1].clear()
        return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(out[1]), pa.array(out[0])], ["term", "toxic", "clean"])

    size = 0
    for batch in batches:
        for label, (terms, _) in zip(batch.column("label").to_pylist(), term_sets(batch.column("text")), strict=True):
            held[label > 0].append(terms)
            size += len(terms)
            if size >= _FLUSH:
                yield rows()
                size = 0
    yield rows()


class BlockMaxIndex:
    """Inverted lists of unit vectors (term numbers, weights), in blocks of ids. Long lists are kept as rows, with their largest weight in each block; short ones as postings."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int, block: int = 64, long: int = 12):
        self.n, self.block = len(vectors), block
        self.blocks = -(-self.n // block)
        term = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in vectors)])
        weight = np.concatenate([np.zeros(0), *(w for _, w in vectors)])
        ids = np.repeat(np.arange(self.n), [len(t) for t, _ in vectors])
        order = np.argsort(term, kind="stable")
        term, self.weights, self.ids = term[order], weight[order], ids[order]
        self.first = np.searchsorted(term, np.arange(terms + 1))
        length = np.diff(self.first)
        kept = np.flatnonzero(length * long >= max(self.n, 8 * long))
        self.row = np.full(terms, -1)
        self.row[kept] = np.arange(len(kept))
        self.rows = np.zeros((len(kept), self.blocks * block))
        for r, t in enumerate(kept.tolist()):
            part = slice(self.first[t], self.first[t + 1])
            self.rows[r, self.ids[part]] = self.weights[part]
        self.space = np.zeros((32, self.blocks * block))
        self.maxima = self.rows.reshape(len(kept), self.blocks, block).max(axis=2) if self.blocks else np.zeros((len(kept), 0))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (cosines, ids) above 0, exactly; equal cosines (to 12 digits) by id. Blocks whose bound is below the k-th best are not opened."""
        if not self.n:
            return np.zeros(0), np.zeros(0, int)
        row = self.row[terms]
        short = terms[row < 0]
        first, length = self.first[short], self.first[short + 1] - self.first[short]
        ends = np.cumsum(length)
        at = np.repeat(first - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)
        sums = np.bincount(self.ids[at], self.weights[at] * np.repeat(weights[row < 0], length), self.blocks * self.block)
        long, q = row[row >= 0], weights[row >= 0]
        bound = sums.reshape(self.blocks, self.block).max(axis=1) + q @ self.maxima[long]
        order = np.argsort(-bound, kind="stable")
        start = max(1, -(-4 * k // self.block))
        opened = order[:start]
        cosines = self._open(opened, sums, long, q)
        least = np.partition(cosines, len(cosines) - k)[len(cosines) - k] if len(cosines) >= k else 0.0
        more = order[start:][bound[order[start:]] >= max(least - 1e-9, 1e-12)]
        if len(more):
            cosines, opened = np.concatenate([cosines, self._open(more, sums, long, q)]), np.concatenate([opened, more])
        ids = (opened[:, None] * self.block + np.arange(self.block)).ravel()
        best = np.lexsort((ids, -cosines))[:k] if len(ids) < 256 else self._best(cosines, ids, k)
        best = best[cosines[best] > 0]
        return cosines[best], ids[best]

    @staticmethod
    def _best(cosines: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
        some = np.flatnonzero(cosines >= np.partition(cosines, len(cosines) - k)[len(cosines) - k])
        return some[np.lexsort((ids[some], -cosines[some]))[:k]]

    def _open(self, blocks: np.ndarray, sums: np.ndarray, long: np.ndarray, q: np.ndarray) -> np.ndarray:
        shape = (self.blocks, self.block)
        if len(blocks) * 2 > self.blocks:  # then the rows are read as they lie, some at a time
            exact = np.zeros(self.rows.shape[1])
            for at in range(0, len(long), len(self.space)):
                some = long[at : at + len(self.space)]
                exact += q[at : at + len(some)] @ np.take(self.rows, some, axis=0, out=self.space[: len(some)], mode="clip")
            exact = exact.reshape(shape)[blocks]
        else:
            exact = (q @ self.rows.reshape(-1, *shape)[long[:, None], blocks].reshape(len(long), len(blocks) * self.block)).reshape(len(blocks), self.block)
        return np.round((sums.reshape(shape)[blocks] + exact).ravel(), 12)


#: Weights that the prior may have beside the cosines of the neighbours; the first without rows to choose by.
PULLS = (1.0, 0.25, 0.5, 2.0, 4.0)


class Model:
    """Examples of known label, their index, and the curve from votes to scores."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, examples: list[tuple[int, int, np.ndarray, np.ndarray]], prior: float, k: int = 15):
        self.terms, self.weights, self.prior, self.k = terms, weights, prior, k
        self.pull, self.slope, self.offset, self.share = PULLS[0], None, 0.0, None
        vectors = [self.vector(e[2], e[3]) for e in examples]
        # neighbours in the order of their heaviest terms share blocks, which keeps the bounds tight
        order = sorted(range(len(examples)), key=lambda i: (vectors[i][0][np.argsort(-vectors[i][1], kind="stable")[:4]].tolist(), examples[i][0]))
        self.ids, self.labels = np.array([examples[i][0] for i in order], np.int64), np.array([examples[i][1] for i in order], float)
        self.index = BlockMaxIndex([vectors[i] for i in order], len(terms))

    def vector(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unit TF-IDF vector over the terms of the examples, as term numbers and weights; empty if it has none."""
        if not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        known = self.terms[at] == hashes
        at = at[known]
        raw = (1 + np.log(counts[known])) * self.weights[at]
        norm = float(np.sqrt(raw @ raw))
        return (at, raw / norm) if norm else (at[:0], raw[:0])

    def neighbours(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[float, float, np.ndarray]:
        """The sum of the cosines of the nearest examples, that of the toxic ones alone, and their ids."""
        near, ids = self.index.nearest(*self.vector(hashes, counts), self.k)
        return float(near.sum()), float(near @ self.labels[ids]), self.ids[ids]

    def vote(self, total, toxic):
        """Share of toxic labels among the nearest examples, weighted by cosine, with the prior at the weight ``pull``: far neighbours leave it near the prior."""
        return (toxic + self.pull * self.prior) / (total + self.pull)

    def calibrate(self, total: np.ndarray, toxic: np.ndarray, labels: np.ndarray) -> None:
        """Chooses ``pull`` and the curve from votes to scores that tell the labels (1 and -1) of training rows set aside best, by logarithmic loss."""
        found = []
        for pull in PULLS:
            self.pull = pull
            slope, offset = logistic(self.vote(total, toxic), labels)
            margin = labels * (slope * self.vote(total, toxic) + offset)
            found.append((float(np.logaddexp(0, -margin).mean()), pull, slope, offset))
        _, self.pull, self.slope, self.offset = min(found)

    def scorer(self, spark: SparkSession):
        """A function of (terms, counts) for tasks: (score, ids of the nearest). The model itself is broadcast once."""
        share, pull, prior, slope, offset = self.shared(spark), self.pull, self.prior, self.slope, self.offset

        def score(terms: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray]:
            total, toxic, near = share.value.neighbours(terms, counts)
            vote = (toxic + pull * prior) / (total + pull)
            return (vote if slope is None else float(1 / (1 + np.exp(-np.clip(slope * vote + offset, -30, 30))))), near

        return score

    def shared(self, spark: SparkSession):
        self.share = self.share or spark.sparkContext.broadcast(self)
        return self.share


def _terms_of_rows(batches):
    import pyarrow as pa

    for batch in batches:
        sets = list(term_sets(batch.column("text")))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array([t.tobytes() for t, _ in sets], pa.binary()), pa.array([n.astype("<i4").tobytes() for _, n in sets], pa.binary())], ["doc_id", "label", "terms", "counts"])


def _unpacked(rows) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    return [(r["doc_id"], int(r["label"] > 0), np.frombuffer(r["terms"], np.uint64), np.frombuffer(r["counts"], "<i4")) for r in rows]


def drawn(train: DataFrame, most: int, seed: int) -> DataFrame:
    """The terms of at most ``most`` training rows, by hash of the id: of equal texts with one label the first alone, and of either label a tenth of ``most`` at least, if there are so many."""
    texts = cut(train.groupBy((F.col("label") > 0).alias("toxic"), F.xxhash64("text").alias("h"), F.crc32(F.col("text").cast("binary")).alias("c")).agg(F.min("doc_id").alias("doc_id")))
    n = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    take = {t: max(round(most * x / sum(n.values())), min(x, most // 10)) for t, x in n.items()}
    order = [F.xxhash64("doc_id", F.lit(seed)), F.col("doc_id")]
    ids = None
    for t, x in sorted(take.items()):
        part = texts.where(F.col("toxic") == t).orderBy(*order).limit(x)
        ids = part if ids is None else ids.union(part)
    if ids is None:
        return train.select("doc_id", "label").where("false").withColumns({"terms": F.lit(b""), "counts": F.lit(b"")})
    ids = cut(ids.select("doc_id", "h").distinct())
    some = train.withColumn("h", F.xxhash64("text")).join(F.broadcast(ids), ["doc_id", "h"], "left_semi").dropDuplicates(["doc_id", "h"])
    return some.select("doc_id", "label", "text").mapInArrow(_terms_of_rows, "doc_id long, label int, terms binary, counts binary")


def fit(train: DataFrame, examples: int = 4096, aside: int = 2048, smooth: float = 10.0, seed: int = 5, **how) -> Model:
    """The model from training rows (doc_id, text, label).

    An eighth of the rows, by hash of the id, is set aside: at most ``aside`` of them calibrate the scores and choose the prior's weight. Of the others at
    most ``examples`` (a bounded part, by hash of the id) are the index, with all their terms and whatever their label. In how many toxic
    and clean texts a term occurs is counted over all rows that are not set aside. A term weighs (1 + log of its count) * idf *
    the absolute log of how much more often it occurs in one class than in the other, shrunk by ``smooth`` texts of the prior:
    with idf alone, words of a topic outweigh the few toxic ones.
    """
    apart = F.pmod(F.xxhash64("doc_id", F.lit(77)), F.lit(8)) == 0
    sizes = train.groupBy(apart.alias("aside"), (F.col("label") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()
    n = {(r["aside"], r["toxic"]): r["n"] for r in sizes}
    calibrated = all(n.get((True, t), 0) >= 10 and n.get((False, t), 0) for t in (True, False))
    toxic, clean = (n.get((False, t), 0) + (0 if calibrated else n.get((True, t), 0)) for t in (True, False))
    if not toxic or not clean:
        return Model(np.zeros(0, np.uint64), np.zeros(0), [], float(toxic > 0), **how)
    used = train.where(~apart) if calibrated else train
    rows = _unpacked(drawn(used, examples, seed).orderBy("doc_id", "label", "terms").collect())
    terms = np.unique(np.concatenate([t for _, _, t, _ in rows]))
    counts = cut(used.mapInArrow(_frequencies, "term long, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")))
    spark = train.sparkSession
    wanted = cut(spark.createDataFrame(_column(terms), "term long"))
    found = counts.join(small_side(wanted, 2_000_000, 64 << 20), "term").toArrow()
    at = np.searchsorted(terms, found.column("term").to_numpy().view(np.uint64))
    a, b = np.zeros(len(terms)), np.zeros(len(terms))
    a[at], b[at] = found.column("a").to_numpy(), found.column("b").to_numpy()
    total, prior = toxic + clean, toxic / (toxic + clean)
    idf = np.log((1 + total) / (1 + a + b)) + 1
    odds = np.log((a + smooth * prior) / (toxic + smooth)) - np.log((b + smooth * (1 - prior)) / (clean + smooth))
    odds -= np.log(prior * (clean + smooth) / ((1 - prior) * (toxic + smooth)))  # of a term that no text holds: 0
    model = Model(terms, idf * np.abs(odds), rows, prior, **how)
    if calibrated:
        share = model.shared(spark)

        def near(batches):
            import pyarrow as pa

            for batch in batches:
                found = [share.value.neighbours(np.frombuffer(t, np.uint64), np.frombuffer(c, "<i4")) for t, c in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist(), strict=True)]
                sums = [pa.array([x[i] for x in found], pa.float64()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), *sums], ["doc_id", "label", "total", "toxic"])

        rows = cut(drawn(train.where(apart), aside, seed)).mapInArrow(near, "doc_id long, label int, total double, toxic double").orderBy("doc_id", "label", "total", "toxic").collect()
        model.calibrate(*(np.array([r[c] for r in rows]) for c in ("total", "toxic")), np.array([1.0 if r["label"] > 0 else -1.0 for r in rows]))
    return model


def _column(terms: np.ndarray):
    import pyarrow as pa

    return pa.table({"term": terms.view(np.int64)})


def toxicity_scores(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted and evidence, the ids of the three nearest examples. Other columns are ignored.

    Learns ``labels.toxic`` from rows whose crc32(doc_id) mod 5 is not 0 and scores every whole text, however long, by the
    votes of its nearest examples (``fit``). Words are runs of letters, lower-cased; the space is that of the examples' words,
    as others match none. A text without any of them (so also a null or empty one) gets the prior for a vote. Of examples with
    equal cosines the first in the index counts. Without labels of both classes all get the only label, or 0; with few, votes
    are not calibrated. Repeated rows are scored each; rows without doc_id are scored and not held out.
    """
    score = fit(training_rows(docs, labels, "toxic", 0, 5), **how).scorer(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [score(*x) for x in term_sets(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([s for s, _ in found], pa.float64()), pa.array([e[:3].tolist() for _, e in found], pa.list_(pa.int64()))], ["doc_id", "score", "evidence"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double, evidence array<long>")
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **how) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, with all their columns; the order of columns stays."""
    score = fit(training_rows(docs, labels, "toxic", 0, 5), **how).scorer(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                part = batch.slice(low, SLICE)
                yield part.filter(pa.array([score(*x)[0] < threshold for x in term_sets(part.column("text"))], pa.bool_()))
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, docs.schema)
