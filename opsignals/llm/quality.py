"""Quality classifier: Naive Bayes support vectors (operator 10).

Features are indicators of n-grams: words, and runs of one to three word shapes (case, marks, and
whether a word repeats one of the two before it), hashed to a fixed width. Class log-count ratios
come from every labelled row. A linear hinge-loss model is then fitted by dual coordinate descent on
at most ``fit_rows`` labelled rows, its inputs being the indicators times the ratios, and a part of
those rows held back from it turns margins into probabilities. Scoring is one pass over the texts
without a shuffle.

A null or empty text has no features and gets the score of the bias. Labels that are null are no
labels; a document with several keeps the lowest. Without rows of both classes every score is the
smoothed share of label 1. Repeated rows are scored each. Other columns are left behind.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsignals.llm.common import slices, small_batches, table, texts, written
from opsignals.llm.counting import chunk_batch, summed
from opsignals.llm.words import hashed, mixed, runs, split_words

WIDTH = 1 << 18
FIT_ROWS = 12_000
ACCEPT = 0.7
_MARKED = re.compile(r"^(\W*)(.*?)(\W*)$", re.DOTALL)


class Model(NamedTuple):
    """score = 1 / (1 + exp(-(slope * (weights over the indicators + bias) + shift)))."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float


def shape(word: str) -> str:
    """The marks around a word, and its case or kind in place of its letters."""
    before, core, after = _MARKED.match(word).groups()
    if not core:
        kind = ""
    elif core.isdigit():
        kind = "0"
    elif core.isalpha():
        kind = "A" if core.isupper() and len(core) > 1 else "Aa" if core[0].isupper() else "a"
    else:
        kind = "x"
    return f"{before[:4]}{kind}{after[:4]}"


def indicators(batch_texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text, joined, and where each text's begin (one more at the end)."""
    rows, codes, words = split_words(batch_texts)
    whole = hashed([w.lower() for w in words])[codes] if len(words) else np.empty(0, np.uint64)
    shapes = hashed([shape(w) for w in words])[codes] if len(words) else np.empty(0, np.uint64)
    echo = np.zeros(len(codes), np.uint64)
    for back in (1, 2):
        echo[back:] |= np.where(codes[back:] == codes[:-back], np.uint64(back), np.uint64(0))
    starts = rows[:-1]
    for back in (1, 2):  # what stands before a text's first words is another text
        first = starts[(starts + back - 1) < rows[1:]] + back - 1
        echo[first] &= np.uint64(0) if back == 1 else np.uint64(1)
    shapes = mixed(shapes + echo)
    owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    found = [(owner.astype(np.int64) << 20) | (mixed(whole) % np.uint64(WIDTH)).astype(np.int64)]
    for size in (1, 2, 3):
        grams = runs(shapes, size)
        same = owner[: len(grams)] == owner[size - 1 :]
        cells = (mixed(grams[same] + np.uint64(size)) % np.uint64(WIDTH)).astype(np.int64)
        found.append((owner[: len(grams)][same].astype(np.int64) << 20) | cells)
    both = np.unique(np.concatenate(found))
    return (both & ((1 << 20) - 1)).astype(np.int32), np.searchsorted(both >> 20, np.arange(len(rows)))


def descend(rows: list[np.ndarray], scale: np.ndarray, positive: np.ndarray, epochs: int = 12, cost: float = 1.0) -> tuple[np.ndarray, float]:
    """Linear hinge-loss weights by dual coordinate descent; inputs are ``scale`` at each row's
    features, at unit length, and a constant. Both classes weigh the same in total."""
    rng = np.random.default_rng(0)
    n = len(rows)
    inputs = [scale[r] for r in rows]
    inputs = [x / (np.sqrt(x @ x) or 1.0) for x in inputs]
    sign = np.where(positive, 1.0, -1.0)
    bound = cost * n / (2 * np.where(positive, max(1, positive.sum()), max(1, (~positive).sum())))
    square = np.array([x @ x + 1.0 for x in inputs])
    weights, bias, dual = np.zeros(len(scale)), 0.0, np.zeros(n)
    for _ in range(epochs):
        for i in rng.permutation(n):
            x, at = inputs[i], rows[i]
            slope = sign[i] * (weights[at] @ x + bias) - 1.0
            new = min(max(dual[i] - slope / square[i], 0.0), bound[i])
            if step := (new - dual[i]) * sign[i]:
                weights[at] += step * x
                bias += step
            dual[i] = new
    return weights, bias


def calibrated(margins: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through margins and classes, by Newton steps on
    targets smoothed by one row of each class."""
    n1, n0 = positive.sum(), (~positive).sum()
    target = np.where(positive, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    slope, shift = 1.0, float(np.log((n1 + 1) / (n0 + 1)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -40, 40)))
        w = p * (1 - p) + 1e-9
        g = np.array([(p - target) @ margins, (p - target).sum()])
        h = np.array([[w @ margins**2 + 1e-6, w @ margins], [w @ margins, w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(slope, 0.0)), float(shift)


def margins_of(weights: np.ndarray, length: np.ndarray, features: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Weights over each row's features, by the row's length; 0 without features."""
    total = np.concatenate(([0.0], np.cumsum(weights[features])))
    norm = np.concatenate(([0.0], np.cumsum(length[features])))
    square = np.maximum(norm[ends[1:]] - norm[ends[:-1]], 1e-12)
    return (total[ends[1:]] - total[ends[:-1]]) / np.sqrt(square)


class Fitted(NamedTuple):
    """``learnt`` is False where labels of one kind, or none, leave nothing but a constant score."""

    model: Model
    ratios: np.ndarray
    learnt: bool = True


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Fitted:
    """docs (doc_id, text) and labels (doc_id, label 0/1): ratios over all, hinge loss over at most ``fit_rows``."""
    spark = docs.sparkSession
    small_batches(spark)
    known = labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = min(1.0, fit_rows / max(1, sum(counts.values())))
    # Labels may be many: a merge join at every size, and not a broadcast while they happen to be few.
    joined = texts(docs).join(known.hint("merge"), "doc_id").select("label", F.xxhash64("doc_id").alias("draw"), "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(2 * WIDTH + 2, np.int64)
        for batch in slices(batches, "text"):
            found, ends = indicators(batch.column("text"))
            label = batch.column("label").to_numpy().astype(np.int64)
            owner = np.repeat(label, np.diff(ends))
            totals[: 2 * WIDTH] += np.bincount(found + owner * WIDTH, minlength=2 * WIDTH)
            totals[2 * WIDTH :] += np.bincount(label, minlength=2)
            draws = batch.column("draw").to_numpy()
            for i in np.flatnonzero((draws.view(np.uint64) >> np.uint64(11)) / float(1 << 53) < share).tolist():
                row = [[-1], [found[ends[i] : ends[i + 1]].astype("<i4").tobytes()], [int(label[i])], [int(draws[i])]]
                kinds = [pa.int32(), pa.binary(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], ["chunk", "counts", "label", "draw"])
        parts = chunk_batch(totals)
        none = pa.nulls(parts.num_rows)
        yield pa.RecordBatch.from_arrays([*parts.columns, none.cast(pa.int32()), none.cast(pa.int64())], ["chunk", "counts", "label", "draw"])

    made = written(joined.mapInArrow(features, "chunk int, counts binary, label int, draw long"), "features")
    totals = summed(made.filter("chunk >= 0").select("chunk", "counts"), 2 * WIDTH + 2)
    n0, n1 = totals[2 * WIDTH :]
    prior = (n1 + 1) / (n0 + n1 + 2)
    flat = Model(np.zeros(WIDTH), 0.0, 0.0, float(np.log(prior / (1 - prior))))
    p, q = totals[WIDTH : 2 * WIDTH] + 1.0, totals[:WIDTH] + 1.0
    ratios = np.log((p / (n1 + 2)) / (q / (n0 + 2)))
    # At most fit_rows rows of some kilobytes each come to the driver.
    sample = made.filter("chunk < 0").orderBy("draw").limit(fit_rows).select("counts", "label").collect()
    rows = [np.frombuffer(bytes(r.counts), "<i4") for r in sample]
    positive = np.array([r.label == 1 for r in sample], bool)
    if not len(rows) or positive.all() or not positive.any():
        return Fitted(flat, ratios, False)
    back = np.arange(len(rows)) % 4 == 3
    if positive[~back].all() or not positive[~back].any():
        back[:] = False
    weights, bias = descend([r for r, b in zip(rows, back) if not b], ratios, positive[~back])
    held = back if back.any() else ~back
    kept = [r for r, h in zip(rows, held) if h]
    ends = np.concatenate(([0], np.cumsum([len(r) for r in kept])))
    margins = margins_of(weights * ratios, ratios**2, np.concatenate(kept), ends) + bias
    slope, shift = calibrated(margins, positive[held])
    return Fitted(Model(weights * ratios, bias, slope, shift), ratios)


def score_quality(docs: DataFrame, fitted: Fitted, name: str = "score") -> DataFrame:
    """The rows of docs (with ``text`` and whatever else they have) with a column of scores, 0 to 1."""
    spark = docs.sparkSession
    small_batches(spark)
    model = fitted.model
    weights, squares = model.weights.astype(np.float32), (fitted.ratios**2).astype(np.float32)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            array, out = pa.array(part, pa.large_string()), []
            at = 0
            while at < len(array):
                upto, size = at, 0
                while upto < len(array) and (upto == at or size < 6 << 20):
                    size += len(array[upto].as_py())
                    upto += 1
                found, ends = indicators(array.slice(at, upto - at))
                margin = margins_of(weights, squares, found, ends) + model.bias
                out.append(1 / (1 + np.exp(-np.clip(model.slope * margin + model.shift, -40, 40))))
                at = upto
            yield pd.Series(np.concatenate(out) if out else np.empty(0))

    return docs.withColumn(name, score(F.coalesce(F.col("text"), F.lit(""))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learn = labels.filter(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))
    scored = score_quality(texts(docs), fit_quality(docs.filter(~held_out(F.col("doc_id"))), learn))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted")
    )
