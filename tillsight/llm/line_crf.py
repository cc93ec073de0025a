"""Document quality from a linear-chain conditional random field over lines (operator 7).

Every line of a text has features of its own (length, signs, capitals, repeated
words ...) and those of its neighbours.  A chain with two states, bad and good,
weighs each line's features and each pair of neighbouring states.  It is fitted by
conditional maximum likelihood on a sample of labelled documents, whose lines take
the document's label; forward-backward gives every line's probability of being
good, and a document's score is their mean weighted by line length.

The sample has at most TRAIN_DOCS labelled documents of the training folds, those
with the smallest hash of their id; it is the only data that reaches the driver.
All documents are scored whole, in Arrow batches, by one pass over the table.

Defined results: a null or empty text is one empty line and gets that line's
probability; blank lines count with length 1; repeated rows get equal scores; without
labelled rows of both kinds all scores are 0.5; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm import scan
from tillsight.llm.staging import join_small, prepare, read

#: The model is fitted on at most so many labelled documents, and on the first lines of each.
TRAIN_DOCS = 3000
TRAIN_LINES = 256
SCORE_DIGITS = 9
STEPS, RATE, PENALTY = 300, 0.1, 1e-3
GOOD = 0.7
_UPPER, _DIGIT = scan.table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), scan.table(b"0123456789")
_SIGN = scan.table(b"#*$%&|<>!@^~=+_{}[]\\/")
_STOP, _PIPE, _BANG = scan.table(b".,;:?"), scan.table(b"|"), scan.table(b"!")


def own_features(c: scan.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, length in bytes and own features of each line of a chunk."""
    c.ranges()
    doc, a, b = c.lines()
    size = np.maximum(b - a, 1)
    start, end = c.words()
    h, word_doc = c.hash(start, end), c.doc(start)
    lo, hi = np.searchsorted(start, a), np.searchsorted(start, b)
    n = np.maximum(hi - lo, 1)

    def share(flags: np.ndarray) -> np.ndarray:
        sums = scan.prefix(flags[c.data])
        return (sums[b] - sums[a]) / size

    def words(flags: np.ndarray) -> np.ndarray:
        sums = scan.prefix(flags)
        return (sums[hi] - sums[lo]) / n

    again = np.zeros(len(h), bool)
    for back in (1, 2):
        again[back:] |= (h[back:] == h[:-back]) & (word_doc[back:] == word_doc[:-back])
    last = c.data[end - 1] if len(end) else np.zeros(0, np.uint8)
    first = c.data[start] if len(start) else np.zeros(0, np.uint8)
    salt = scan.mix(np.arange(1, c.n + 1, dtype=np.uint64))
    _, repeat = scan.repeated(scan.mix(c.hash(a, b) ^ salt[doc]))
    word_size = (end - start).astype(np.int64)
    columns = [share(_UPPER), share(_DIGIT), 4 * share(_SIGN), 4 * share(_PIPE), 4 * share(_BANG), 4 * share(_STOP),
               words(again), words(_SIGN[last]), words(_SIGN[first]), words(_UPPER[first]),
               words(word_size > 12), words(word_size < 4), np.log1p(b - a) / 8, np.log1p(hi - lo) / 6,
               (hi == lo).astype(float), repeat & (hi > lo)]
    return doc, size, np.column_stack(columns).astype(np.float64)


def with_neighbours(doc: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Own features, those of the lines before and after (0 at the ends), and 1."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    same = (doc[1:] == doc[:-1])[:, None]
    before[1:] = own[:-1] * same
    after[:-1] = own[1:] * same
    return np.hstack([own, before, after, np.ones((len(own), 1))])


def forward_backward(doc: np.ndarray, pull: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of chains: P(good) of each line, expected pairs (2 x 2 sums), log partition sum.

    ``pull`` is each line's score for good against bad; ``pair[x, y]`` scores
    neighbours in states x, y.  Lines of all texts at one place in their text are
    handled together, so there are as many steps as the longest text has lines.
    """
    n = len(doc)
    if not n:
        return np.zeros(0), np.zeros((2, 2)), 0.0
    begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    size = np.diff(np.r_[begin, n])
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    alive = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")  # texts with at least that many lines
    node = np.column_stack([np.zeros(n), pull])
    fwd, bwd = node.copy(), np.zeros((n, 2))
    for t in range(1, size[0]):
        at = begin[:alive[t]] + t
        fwd[at] += np.logaddexp(fwd[at - 1, :1] + pair[0], fwd[at - 1, 1:] + pair[1])
    for t in range(size[0] - 2, -1, -1):
        at = begin[:alive[t + 1]] + t
        ahead = bwd[at + 1] + node[at + 1]
        bwd[at] = np.logaddexp(ahead[:, :1] + pair[:, 0], ahead[:, 1:] + pair[:, 1])
    last = begin + size - 1
    log_z = np.logaddexp(fwd[last, 0], fwd[last, 1])
    both = fwd + bwd
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700)))
    pairs = np.zeros((2, 2))
    inner = np.flatnonzero(np.r_[False, doc[1:] == doc[:-1]])
    z_line = np.repeat(log_z[np.argsort(order)], np.diff(np.r_[np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]), n]))
    for x in (0, 1):
        for y in (0, 1):
            pairs[x, y] = np.exp(fwd[inner - 1, x] + pair[x, y] + node[inner, y] + bwd[inner, y] - z_line[inner]).sum()
    return good, pairs, float(log_z.sum())


def fit(doc: np.ndarray, x: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray] | None:
    """Weights by gradient ascent (Adam) on the mean conditional log-likelihood."""
    if len(np.unique(label)) < 2:
        return None
    mean, scale = x.mean(0), x.std(0)
    mean[-1], scale[scale < 1e-9] = 0.0, 1.0
    x = (x - mean) / scale
    n_docs = len(np.unique(doc))
    inner = np.r_[False, doc[1:] == doc[:-1]]
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[:-1][inner[1:]], label[1:][inner[1:]]), 1)
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, STEPS + 1):
        good, pairs, _ = forward_backward(doc, x @ theta[:-4], theta[-4:].reshape(2, 2))
        grad = np.r_[x.T @ (label - good), (seen - pairs).ravel()] / n_docs - PENALTY * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta = theta + RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return {"mean": mean, "scale": scale, "weights": theta[:-4], "pair": theta[-4:].reshape(2, 2)}


def weighted(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted sum of each row's features, added up in one order however many rows there are."""
    total = np.zeros(len(x))
    for k, w in enumerate(weights):
        total += x[:, k] * w
    return total


def score_texts(texts: pa.Array, model: dict[str, np.ndarray] | None) -> np.ndarray:
    """Length-weighted mean of the lines' probabilities of being good."""
    out = []
    for c in scan.chunks(texts):
        if model is None:
            out.append(np.full(c.n, 0.5))
            continue
        doc, size, own = own_features(c)
        x = (with_neighbours(doc, own) - model["mean"]) / model["scale"]
        good, _, _ = forward_backward(doc, weighted(x, model["weights"]), model["pair"])
        out.append(np.bincount(doc, weights=good * size, minlength=c.n) / np.bincount(doc, weights=size, minlength=c.n))
    return np.round(np.clip(np.concatenate(out), 0.0, 1.0), SCORE_DIGITS) if out else np.zeros(0)


def held_out(doc_id: Column) -> Column:
    """The fold that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> dict[str, np.ndarray] | None:
    """Model fitted on at most ``most`` labelled documents outside the held-out fold.

    Where texts share a doc_id, the first of them in order stands for it.
    """
    few = (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    rows = join_small(docs.select("doc_id", "text"), few, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels_ = batch.column("doc_id"), batch.column("label").to_numpy(zero_copy_only=False)
            for c in scan.chunks(batch.column("text")):
                doc, _, own = own_features(c)
                line = np.arange(len(doc)) - np.searchsorted(doc, doc)
                few_lines = line < TRAIN_LINES
                x, doc, line = with_neighbours(doc, own)[few_lines], doc[few_lines], line[few_lines]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(doc + c.lo)), pa.array(line), pa.array(labels_[c.lo:c.hi][doc]),
                     pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "line", "label", "x"])

    lines = rows.mapInArrow(features, "doc_id long, line long, label int, x array<double>").toArrow()
    if not len(lines):
        return None
    lines = lines.sort_by([("doc_id", "ascending"), ("line", "ascending")]).combine_chunks()
    x = lines["x"].combine_chunks().flatten().to_numpy().reshape(len(lines), -1)
    return fit(lines["doc_id"].to_numpy(), x, lines["label"].to_numpy())


def score(docs: DataFrame, model: dict[str, np.ndarray] | None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score_texts(batch.column("text"), shared.value), pa.float64())],
                names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= GOOD).cast("int").alias("predicted")))


def op7_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, train(docs, read(spark, sf_dir, "labels").select("doc_id", "quality")))
