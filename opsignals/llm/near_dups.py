"""MinHash near-duplicates by improved consistent weighted sampling (operator 6).

A document is a weighted set of its runs of five words: how often a run occurs, times the mean idf
of its words. Document frequencies are counted over all documents into a table of fixed width, and
idf is scaled to 1..2, so that a group of thousands of copies can't make its own common words
weightless. Each of 30 hash functions draws one element by improved consistent weighted sampling;
two documents agree in a draw with a probability equal to their weighted Jaccard similarity. Three
draws make a band, and documents that share one of ten bands are candidates: 0.8 alike, they share
one with a probability of 0.999.

Texts of one digest are one node. A pair of a band is verified if its sets agree in enough of the 30
draws, as they do but for one pair in a million that is alike. Bands of up to ``PAIRED`` nodes are
compared as they are. In a larger one every node is compared with a leader, and then with the most
likely of a few others that aren't in its component, as long as one pair in ten turns out alike. That joins groups of copies at little cost and finds no links for certain; the nodes of larger
bands that hold several components are then joined by prefixes of their weighted sets
(``crowded_pairs``), which leaves out no pair of two components that is alike. A verified pair has a weighted Jaccard similarity of
``threshold`` or more over the whole texts. Links give components.

A null text is an empty one; texts without words are near-duplicates of equal texts only, and texts
of fewer than five words have one run of all. Repeated rows and repeated ids stay in the result;
null ids too, and a class takes its smallest id. Other columns are left behind.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opsignals.llm.common import slices, small_batches, table, texts, written
from opsignals.llm.components import components, merged
from opsignals.llm.counting import chunk_batch, summed
from opsignals.llm.words import hashed, mixed, runs, split_words

RUN, THRESHOLD = 5, 0.8
BANDS, ROWS = 10, 3
WIDTH = 1 << 20
PAIRED, LEADERS = 16, 8
# A run in more sets than FEW is joined by classes of the sets' weights, each wider than the last by
# CLASS; a key of more rows than CELL is joined in several cells.
FEW, CLASS, CELL = 64, 1.03, 256
# How many of the keys before it a row carries, to pass over pairs that met at one of them.
EARLY = 64
_DRAWS = 1 << 16


def node_of(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def document_frequency(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each of WIDTH cells of word hashes occurs, and how many there are."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(WIDTH + 1, np.int64)
        for batch in slices(batches, "text"):
            rows, codes, words = split_words(batch.column("text"))
            cells = (hashed(words) % np.uint64(WIDTH)).astype(np.int64)
            owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
            once = np.unique(owner << 20 | cells[codes]) if len(codes) else np.empty(0, np.int64)
            totals[:WIDTH] += np.bincount(once & (WIDTH - 1), minlength=WIDTH)
            totals[WIDTH] += len(rows) - 1
        yield chunk_batch(totals)

    totals = summed(texts(docs).mapInArrow(count, "chunk int, counts binary"), WIDTH + 1)
    return totals[:WIDTH], int(totals[WIDTH])


def scaled_idf(frequency: np.ndarray, documents: int) -> np.ndarray:
    """1 for a word of every document up to 2 for a word of none."""
    return (1 + np.log((1 + documents) / (1 + frequency)) / max(np.log(1 + documents), 1e-9)).astype(np.float32)


def weighted_runs(batch_texts: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct runs in order of their hash, their weights, and where each text's begin."""
    rows, codes, words = split_words(batch_texts)
    of_word = hashed(words)
    weight = idf[(of_word % np.uint64(WIDTH)).astype(np.int64)] if len(words) else np.empty(0, np.float32)
    values, weight = of_word[codes], weight[codes]
    whole = runs(values, RUN)
    mean = sum((weight[j : j + len(whole)] for j in range(RUN)), np.zeros(len(whole), np.float32)) / np.float32(RUN)
    keys, weights, ends = [], [], [0]
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        if b - a >= RUN:
            key, first, times = np.unique(whole[a : b - RUN + 1], return_index=True, return_counts=True)
            keys.append(key)
            weights.append(mean[a : b - RUN + 1][first] * times.astype(np.float32))
        elif b > a:
            keys.append(runs(values[a:b], b - a) + np.uint64(b - a))
            weights.append(weight[a:b].mean(keepdims=True))
        ends.append(ends[-1] + (len(keys[-1]) if b > a else 0))
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.float32), np.array(ends)
    return np.concatenate(keys), np.concatenate(weights), np.array(ends)


class Sampler:
    """The draws of improved consistent weighted sampling; their random numbers come from tables
    that a run's hash indexes afresh for each draw."""

    def __init__(self, draws: int = BANDS * ROWS):
        rng = np.random.default_rng(6)
        self.step = rng.gamma(2, 1, (draws, _DRAWS)).astype(np.float32)
        self.log_c = np.log(rng.gamma(2, 1, (draws, _DRAWS))).astype(np.float32)
        self.beta = rng.random((draws, _DRAWS), np.float32)
        self.odd = rng.integers(1 << 62, 1 << 63, draws, np.uint64) | np.uint64(1)

    def draw(self, keys: np.ndarray, weights: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A row of drawn elements for each set; sets may not be empty."""
        starts, sizes = ends[:-1], np.diff(ends)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        log_weight = np.log(weights)
        out = np.empty((len(sizes), len(self.odd)), np.uint64)
        for k, odd in enumerate(self.odd):
            at = ((keys * odd) >> np.uint64(48)).astype(np.intp)
            step, beta = self.step[k][at], self.beta[k][at]
            level = np.floor(log_weight / step + beta)
            cost = self.log_c[k][at] - step * (level - beta + np.float32(1))
            least = np.minimum.reduceat(cost, starts)
            hits = np.flatnonzero(cost == least[owner])
            first = hits[np.searchsorted(owner[hits], np.arange(len(sizes)))]
            out[:, k] = mixed(keys[first] ^ mixed(level[first].astype(np.int64).view(np.uint64) + np.uint64(k)))
        return out


def weighted_jaccard(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> float:
    keys, at, at_other = np.intersect1d(one[0], other[0], assume_unique=True, return_indices=True)
    total = float(one[1].sum(dtype=np.float64)) + float(other[1].sum(dtype=np.float64))
    shared = float(np.minimum(one[1][at], other[1][at_other]).sum(dtype=np.float64))
    return shared / (total - shared) if total > shared else 1.0


def least_agreement(threshold: float, draws: int = BANDS * ROWS, lost: float = 1e-6) -> int:
    """In how many draws a pair must agree so that at most ``lost`` of the pairs that are alike do not."""
    below = 0.0
    for k in range(draws):
        below += math.comb(draws, k) * threshold**k * (1 - threshold) ** (draws - k)
        if below > lost:
            return k
    return draws


def agreement(one: Column, other: Column) -> Column:
    """In how many draws two sketches agree."""
    same = F.zip_with(one, other, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda n, x: n + x)


def signatures(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """doc_id, node (digest of the text), bands and sketch (16 bits of each draw) of every document;
    no bands without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch in slices(batches, "text", 2 << 20):
            keys, weights, ends = weighted_runs(batch.column("text"), idf)
            filled = np.flatnonzero(np.diff(ends))
            bands: list = [[] for _ in range(batch.num_rows)]
            sketch: list = [[] for _ in range(batch.num_rows)]
            if len(filled):
                drawn = sampler.draw(keys, weights, np.append(ends[filled], ends[-1]))
                band = runs_of_rows(drawn)
                short = (drawn >> np.uint64(48)).astype(np.uint16).view(np.int16)
                for i, row, marks in zip(filled.tolist(), band.view(np.int64).tolist(), short.tolist(), strict=True):
                    bands[i], sketch[i] = row, marks
            nodes = [hashlib.sha256(t.encode()).digest()[:16] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(nodes, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int16()))],
                ["doc_id", "node", "bands", "sketch"],
            )

    return texts(docs).mapInArrow(sign, "doc_id long, node binary, bands array<long>, sketch array<short>")


def runs_of_rows(drawn: np.ndarray) -> np.ndarray:
    """The band keys of each row of draws."""
    out = np.zeros((len(drawn), BANDS), np.uint64)
    for j in range(ROWS):
        out = mixed(out * np.uint64(31) + drawn[:, j::ROWS] + np.arange(BANDS, dtype=np.uint64))
    return out


def texts_of(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node and text, once, of nodes (node, and doc_id of one of its documents)."""
    whole = texts(docs).select(F.col("doc_id").alias("id"), "text")
    found = whole.join(nodes, F.col("id").eqNullSafe(F.col("doc_id"))).filter(node_of(F.col("text")) == F.col("node"))
    return found.groupBy("node").agg(F.first("text").alias("text"))


def verified(pairs: DataFrame, chosen: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are alike."""
    one = chosen.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    other = chosen.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_b", 2 << 20):
            sides = []
            for side in ("a", "b"):
                coded = batch.column(f"text_{side}").dictionary_encode()
                keys, weights, ends = weighted_runs(coded.dictionary, idf)
                sides.append([(keys[ends[i] : ends[i + 1]], weights[ends[i] : ends[i + 1]]) for i in coded.indices.to_pylist()])
            alike = [weighted_jaccard(x, y) >= threshold for x, y in zip(*sides, strict=True)]
            kept = batch.filter(pa.array(alike, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["a", "b"])

    return pairs.join(one, "a").join(other, "b").select("a", "b", "text_a", "text_b").mapInArrow(verify, "a binary, b binary")


def run_frequency(nodes: DataFrame, idf: np.ndarray) -> np.ndarray:
    """In how many of the nodes' texts each of WIDTH cells of run hashes occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(WIDTH, np.int64)
        for batch in slices(batches, "text", 2 << 20):
            keys, _, ends = weighted_runs(batch.column("text"), idf)
            owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            once = np.unique(owner << 20 | (keys % np.uint64(WIDTH)).astype(np.int64))
            totals += np.bincount(once & (WIDTH - 1), minlength=WIDTH)
        yield chunk_batch(totals)

    return summed(nodes.select("text").mapInArrow(count, "chunk int, counts binary"), WIDTH)


def prefixes(nodes: DataFrame, idf: np.ndarray, frequency: np.ndarray, threshold: float) -> DataFrame:
    """The runs of each node (node, own, text) that a set of ``threshold`` or more may share first.

    Runs are in order of their frequency, rare ones first. ``rest`` is the weight from a run on; two
    sets alike overlap by t / (1 + t) of their weights' sum, so they have a run in common from which
    on both have that much left. A run of up to FEW sets is a key; more frequent ones are a key for
    each two classes of weights in which that can be true. ``early`` are the first ``EARLY`` keys before it.
    """
    wide = math.ceil(math.log(1 / threshold) / math.log(CLASS)) + 1
    share, slack = threshold / (1 + threshold), 1 - 1e-6
    frequency = np.minimum(frequency, FEW + 1).astype(np.uint8)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            keys, weights, ends = weighted_runs(batch.column("text"), idf)
            found = []
            for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
                often = frequency[(keys[a:b] % np.uint64(WIDTH)).astype(np.intp)]
                order = np.lexsort((keys[a:b], often))
                rest = np.cumsum(weights[a:b][order][::-1], dtype=np.float64)[::-1]
                if not len(rest):
                    continue
                total = float(rest[0])
                first = int((rest >= threshold * total * slack).sum())
                run, rest, often = keys[a:b][order][:first], rest[:first], often[order][:first]
                rare = (often > 1) & (often <= FEW)
                early = run[rare]
                found.append((i, early, rest[rare], total, 0, False, early, 0))
                run, rest = run[often > FEW], rest[often > FEW]
                own = math.floor(math.log(total) / math.log(CLASS))
                for other in range(own - wide, own + wide + 1) if len(run) else ():
                    may = rest >= share * (total + max(CLASS**other, threshold * total)) * slack
                    two = np.uint64(min(own, other) + (1 << 20) << 24 | max(own, other) + (1 << 20))
                    own_keys = mixed(run[may] ^ mixed(np.array([two])))
                    found.append((i, own_keys, rest[may], total, own, other != own, np.concatenate((early, own_keys)), len(early)))
            found = [f for f in found if len(f[1])]
            at, sizes = [f[0] for f in found], [len(f[1]) for f in found]
            of = np.repeat(np.array(at, np.int64), sizes)
            # Two sets meet at each key they share; what came before tells the first of these.
            n_early = np.concatenate([np.empty(0, np.int64), *[np.minimum(f[7] + np.arange(len(f[1])), EARLY) for f in found]])
            before = [f[6][:k] for f in found for k in np.minimum(f[7] + np.arange(len(f[1])), EARLY).tolist()]
            offsets = np.concatenate(([0], np.cumsum(n_early))).astype(np.int32)
            earlier = np.concatenate([np.empty(0, np.uint64), *before]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.empty(0, np.uint64), *[f[1] for f in found]]).view(np.int64)),
                    batch.column("node").take(pa.array(of)),
                    batch.column("own").take(pa.array(of)),
                    pa.array(np.concatenate([np.empty(0), *[f[2] for f in found]])),
                    *[pa.array(np.repeat(np.array([f[c] for f in found], t), sizes)) for c, t in ((3, np.float64), (4, np.int32), (5, np.bool_))],
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(earlier)),
                ],
                ["run", "node", "own", "rest", "total", "class", "far", "early"],
            )

    return nodes.select("node", "own", "text").mapInArrow(emit, "run long, node binary, own binary, rest double, total double, class int, far boolean, early array<long>")


def crowded_pairs(many: DataFrame, roots: DataFrame, chosen: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """All pairs (a, b) of two components among the nodes of large bands that may be alike."""
    placed = many.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("own"))
    apart = placed.groupBy("key").agg(F.min("own").alias("low"), F.max("own").alias("high")).filter("low != high")
    nodes = placed.join(apart, "key").select("node", "own").distinct()
    held = written(chosen.join(nodes, "node"), "crowded")
    rows = written(prefixes(held, idf, run_frequency(held, idf), threshold), "prefixes")
    # A key's pairs are of a row outside its most frequent component and any other row: a component
    # of thousands never meets itself.
    per_own = rows.groupBy("run", "own").agg(F.count(F.lit(1)).alias("n"))
    sizes = per_own.groupBy("run").agg(F.sum("n").alias("n"), F.max_by("own", F.struct("n", "own")).alias("main"), F.count(F.lit(1)).alias("owns"))
    sizes = sizes.filter("owns > 1").select("run", "main", F.ceil(F.col("n") / CELL).cast("int").alias("cells"))
    rows = rows.join(sizes, "run").withColumn("minor", F.col("own") != F.col("main")).drop("main")
    # Each row is in one cell of its key and a row outside the main component goes to all of them, so
    # that no task holds a whole hot key.
    every = F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell")
    one = rows.filter("minor").select(*[F.col(c).alias(f"{c}_a") for c in rows.columns], every)
    other = rows.select(*[F.col(c).alias(f"{c}_b") for c in rows.columns], F.pmod(F.xxhash64("node"), F.col("cells")).cast("int").alias("cell_b"))
    needed = (F.col("total_a") + F.col("total_b")) * (threshold / (1 + threshold) * (1 - 1e-6))
    met = one.join(
        other,
        (F.col("run_a") == F.col("run_b"))
        & (F.col("cell") == F.col("cell_b"))
        & (F.col("own_a") != F.col("own_b"))
        & (~F.col("minor_b") | (F.col("node_a") < F.col("node_b")))
        & (F.col("far_a") == (F.col("class_a") != F.col("class_b")))
        & (F.col("rest_a") >= needed)
        & (F.col("rest_b") >= needed)
        & (F.least("total_a", "total_b") >= F.greatest("total_a", "total_b") * (threshold * (1 - 1e-6)))
        & ~F.arrays_overlap("early_a", "early_b"),
    )
    return met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def likeliest(placed: DataFrame, lead: DataFrame) -> DataFrame:
    """For each node of ``placed`` (key, node, own, sketch) the one of ``lead`` under one of its keys, and of
    another component, whose draws agree most: node and best (times, lead).

    The few of a band come to its rows as one list, so a row is met once and not once for each of them.
    """
    entry = F.struct("node", "own", "sketch")
    leads = lead.groupBy("key").agg(F.min("own").alias("low"), F.max("own").alias("high"), F.collect_list(entry).alias("leads"))
    met = F.transform(
        F.filter("leads", lambda x: x["own"] != F.col("own")),
        lambda x: F.struct(agreement(F.col("sketch"), x["sketch"]).alias("times"), x["node"].alias("lead")),
    )
    apart = placed.join(leads, "key").filter((F.col("own") != F.col("low")) | (F.col("own") != F.col("high")))
    return apart.select("node", F.array_max(met).alias("best")).groupBy("node").agg(F.max("best").alias("best"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class), node (digest of the text) and root (the class)
    of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    idf = scaled_idf(*document_frequency(docs))
    signed = written(signatures(docs, idf), "signatures")
    nodes = signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    keyed = nodes.select("node", "sketch", F.posexplode("bands").alias("band", "hash")).select(
        "node", "sketch", F.xxhash64("band", "hash").alias("key")
    )
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = written(keyed.join(sizes, "key"), "bands")
    # Every node that may be verified, fetched once.
    members = shared.select("node").distinct().join(nodes.select("node", "doc_id"), "node")
    chosen = written(texts_of(members, docs), "candidates")
    least = least_agreement(threshold)

    few, many = shared.filter(F.col("size") <= PAIRED), shared.filter(F.col("size") > PAIRED)
    leaders = many.groupBy("key").agg(F.min(F.struct("node", "sketch")).alias("lead")).select("key", "lead.*")
    first = few.select("key", "node", "sketch").unionByName(leaders)
    pairs = first.select("key", F.col("node").alias("a"), F.col("sketch").alias("sketch_a")).join(
        shared.select("key", F.col("node").alias("b"), "sketch"), "key"
    )
    pairs = pairs.filter((F.col("a") < F.col("b")) & (agreement(F.col("sketch_a"), F.col("sketch")) >= least)).select("a", "b")
    tested = written(pairs.distinct(), "pairs")
    links = written(verified(tested, chosen, idf, threshold), "links")
    roots = components(links)

    # A few nodes of each large band and the one with most links meet the nodes of other components; each
    # of these is compared with the one whose draws agree most, as long as one pair in ten is alike.
    turn, found = 0, 1.0
    while found >= 0.1:
        turn += 1
        degree = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
        placed = many.join(degree, "node", "left").join(roots, "node", "left").select(
            "key", "node", "sketch", "size", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("own")
        )
        some = F.pmod(F.xxhash64("node", "key", F.lit(turn)), F.col("size")) < LEADERS
        hub = placed.groupBy("key").agg(F.max(F.struct("links", "node", "own", "sketch")).alias("top")).select("key", "top.node", "top.own", "top.sketch")
        lead = placed.filter(some).select("key", "node", "own", "sketch").union(hub)
        likely = likeliest(placed, lead)
        fresh = likely.filter(F.col("best.times") >= math.ceil(BANDS * ROWS * threshold) - 2)
        fresh = fresh.select(F.least("best.lead", "node").alias("a"), F.greatest("best.lead", "node").alias("b")).distinct()
        fresh = written(fresh, "pairs")
        more = written(verified(fresh, chosen, idf, threshold), "links")
        n_fresh, n_more = fresh.count(), more.count()
        found = n_more / n_fresh if n_fresh else 0.0
        tested, links = tested.union(fresh), links.union(more)
        if n_more:
            roots = merged(roots, more)
    # What is apart still is held against one another without a limit.
    crowded = crowded_pairs(many, roots, chosen, idf, threshold).join(tested, ["a", "b"], "left_anti")
    left = written(crowded, "pairs")
    more = written(verified(left, chosen, idf, threshold), "links")
    if not more.isEmpty():
        roots = merged(roots, more)
    classed = signed.select("doc_id", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = classed.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return classed.join(least, "root").select("doc_id", "class_id", "node", "root")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs without near-duplicates: of each class the row with its smallest id (a null
    id counts as the smallest), and of equal rows one."""
    at = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    classed = near_duplicates(docs, threshold)
    first = classed.groupBy("root").agg(F.min(F.struct(at.alias("at"), "node")).alias("k")).select("k.at", F.col("k.node").alias("kept"))
    # The caller's row travels as one column, so none of its names can clash.
    rows = docs.select(F.struct("*").alias("row"), at.alias("at"), node_of(F.coalesce("text", F.lit(""))).alias("node"))
    number = F.row_number().over(W.partitionBy("at", "node").orderBy(F.lit(0)))
    kept = rows.join(first, "at").filter(F.col("node") == F.col("kept")).withColumn("number", number).filter("number = 1")
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id")
