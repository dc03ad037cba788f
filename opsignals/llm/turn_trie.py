"""The trie of conversation prefixes (operator 13), by peeling turns off from the greatest depth.

A conversation is its sequence of turns; a node stands for each distinct sequence of first turns. The
trie is never built from its root. Work begins at the greatest depth: the conversations that end
there are grouped into nodes, every node gives up its last turn, and what is left is regrouped at
the depth above together with the conversations that end there, down to the root without turns. A
group's sums are complete when it is formed, so one pass finds the nodes and what their subtrees hold.

A turn is an entry of 24 bytes, a 128-bit digest that also covers all turns before it and the number
of words in its text, and a path is its entries joined: the last entry names the node, and peeling
is a substring. Texts are digested where they are read and shuffled never. Regrouping is a sum with a
partial step, so a first turn that a third of all conversations share is one row per task.

Most conversations are short and a few are very long. A level that more than ``THIN`` conversations
reach is one Spark job. Levels with fewer are taken together in one, as far as no more than
``THIN`` turns lie in them: their paths are dealt out by their node at the stretch's upper end and
peeled there, so the memory of a task is bounded by ``THIN`` entries, whatever the groups are.

Members that end at a node are digested in the order of their ids without gathering them: ids are
sorted over all tasks and written as text in chunks, and one task a node reads its chunks in order.

Turns are in order of their number, null first; rows of one number in order of their digest; equal
rows are turns of their own. A null role or text is an empty one. Rows without conv_id take no part;
further columns are left behind. Without any conversation there is no node. A conversation's own
entries (24 bytes a turn) are held by one task; its texts, of any length, are not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsignals.llm.common import small_batches, table, tasks, written

ENTRY = 24
THIN = 1 << 14
CHUNK = 1 << 16
WORD = r"[^\x20\x09-\x0D]++"

_STATE = "path binary, conv_id long, n_convs long, n_children long, leaves long, saved long"
_NODE = "depth int, path binary, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def _wide(number: Column) -> Column:
    return F.unhex(F.lpad(F.hex(number.cast("long")), 16, "0"))


def conversations_as_turns(rows: DataFrame) -> DataFrame:
    """conv_id and turns, an array of (digest, words) in order, of a table of conv_id, turn, role, text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    turn = F.struct(F.col("turn").alias("turn"), digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    kept = rows.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    # sort_array puts nulls first.
    return kept.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def rebuilt(turns: DataFrame, every: int = 20, most: int = 3) -> DataFrame:
    """Conversations whose first turns are those of the conversation at the last multiple of ``every``:
    the first h of it, all if it has fewer, and their own after the first h, with h the CRC-32 of the
    decimal id modulo ``most + 1``."""
    h = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")
    heads = turns.select(F.col("conv_id").alias("of"), F.slice("turns", 1, most).alias("head"))
    # The last multiple is divided towards zero, as SQL does.
    placed = turns.withColumns({"of": F.col("conv_id") - F.col("conv_id") % every, "h": h})
    none = F.filter("turns", lambda _: F.lit(False))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    joined = placed.join(heads, "of", "left")
    return joined.select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), own).alias("turns"))


def paths(turns: DataFrame) -> DataFrame:
    """conv_id, depth and path of every conversation."""

    def longer(path: Column, turn: Column) -> Column:
        # A digest covers the digest before it, so it stands for all turns up to its own.
        before = F.substring(path, -ENTRY, 16)
        digest = F.unhex(F.substring(F.sha2(F.concat(before, turn["digest"]), 256), 1, 32))
        return F.concat(path, digest, _wide(turn["words"]))

    path = F.aggregate("turns", F.lit(b"").cast("binary"), longer)
    return turns.select("conv_id", F.size("turns").alias("depth"), path.alias("path"))


def _reach(ended: DataFrame) -> list[int]:
    """How many conversations have d turns or more, by d: a number for each turn of the longest one."""
    found = {r.depth: r.n for r in ended.groupBy("depth").agg(F.count(F.lit(1)).alias("n")).collect()}
    out, total = [], 0
    for d in range(max(found, default=-1), -1, -1):
        total += found.get(d, 0)
        out.append(total)
    return out[::-1]


def stretches(reach: list[int], thin: int) -> Iterator[tuple[int, int]]:
    """(lower, upper) depths that are peeled in one job, the greatest first; the root comes alone."""
    high = len(reach) - 1
    while high >= 1:
        low, held = high, reach[high]
        while low > 1 and held + reach[low - 1] <= thin:
            low -= 1
            held += reach[low]
        yield low, high
        high = low - 1
    if reach:
        yield 0, 0


def _words_of(path: Column) -> Column:
    return F.coalesce(F.conv(F.hex(F.substring(path, -8, 8)), 16, 10).cast("long"), F.lit(0).cast("long"))


def _level(state: DataFrame, depth: int) -> DataFrame:
    """The nodes of one depth, from what was left of those below and the conversations that end there."""
    key = F.substring("path", -ENTRY, ENTRY) if depth else F.lit(b"").cast("binary")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "leaves", "saved")]
    formed = state.groupBy(key.alias("key")).agg(F.first("path").alias("path"), F.min("conv_id").alias("conv_id"), *sums)
    own = (F.col("n_convs") - 1) * (_words_of(F.col("path")) if depth else F.lit(0))
    return formed.select(
        F.lit(depth).alias("depth"), "path", "conv_id", "n_convs", "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("leaves")).cast("long").alias("n_leaves"),
        (F.col("saved") + own).alias("saved_tokens"),
    )


def _stretch(state: DataFrame, low: int, high: int) -> DataFrame:
    """The nodes of several depths that few turns lie in, peeled where their node at ``low`` is."""

    def nodes(group: dict[int, dict[bytes, list]]) -> Iterator[tuple]:
        for depth in range(high, low - 1, -1):
            for key, (path, conv, convs, children, leaves, saved) in group.pop(depth, {}).items():
                leaves = leaves if children else 1
                saved += (convs - 1) * int.from_bytes(key[16:], "big")
                yield depth, path[: ENTRY * depth], conv, convs, children, leaves, saved
                if depth > low:
                    merge(group, depth - 1, path, conv, convs, 1, leaves, saved)

    def merge(group: dict, depth: int, path: bytes, conv: int, *sums: int) -> None:
        key = path[ENTRY * (depth - 1) : ENTRY * depth]
        held = group.setdefault(depth, {}).setdefault(key, [path, conv, 0, 0, 0, 0])
        held[1] = min(held[1], conv)
        for i, n in enumerate(sums, 2):
            held[i] += n

    names = [c.split()[0] for c in _NODE.split(", ")]
    kinds = [pa.int32(), pa.binary(), *[pa.int64()] * 5]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def peel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor, group, out = None, {}, []
        for rows in batches:
            for row in rows.to_pylist():
                if row["floor"] != floor:
                    out.extend(nodes(group))
                    floor, group = row["floor"], {}
                    if len(out) >= 1024:
                        yield batch(out)
                        out = []
                sums = (row[c] for c in ("n_convs", "n_children", "leaves", "saved"))
                merge(group, len(row["path"]) // ENTRY, row["path"], row["conv_id"], *sums)
        out.extend(nodes(group))
        if out:
            yield batch(out)

    keyed = state.withColumn("floor", F.substring("path", ENTRY * (low - 1) + 1, ENTRY))
    dealt = keyed.repartition(tasks(state.sparkSession), "floor").sortWithinPartitions("floor")
    return dealt.mapInArrow(peel, _NODE)


def member_digests(ended: DataFrame) -> DataFrame:
    """node (last entry of a path) and the SHA-256 of the ids that end there, joined by commas."""
    spark = ended.sparkSession
    node = F.when(F.col("depth") == 0, F.lit(b"").cast("binary")).otherwise(F.substring("path", -ENTRY, ENTRY))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, node, first, ids, size = [], None, None, [], 0

        def batch() -> pa.RecordBatch:
            kinds = (pa.binary(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["node", "first", "ids"])

        held = 0
        for rows in batches:
            for key, conv in zip(rows.column("node").to_pylist(), rows.column("conv_id").to_pylist(), strict=True):
                if ids and (key != node or size >= CHUNK):
                    out.append((node, first, b",".join(ids)))
                    held, ids, size = held + size, [], 0
                    if held >= 1 << 20 or len(out) >= 4096:
                        yield batch()
                        out, held = [], 0
                if not ids:
                    node, first = key, conv
                ids.append(b"%d" % conv)
                size += len(ids[-1]) + 1
        if ids:
            out.append((node, first, b",".join(ids)))
            yield batch()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, done = None, None, []
        for rows in batches:
            for key, ids in zip(rows.column("node").to_pylist(), rows.column("ids").to_pylist(), strict=True):
                if sha is None or key != node:
                    if sha is not None:
                        done.append((node, sha.hexdigest()))
                    node, sha = key, hashlib.sha256(ids)
                else:
                    sha.update(b",")
                    sha.update(ids)
            if len(done) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["node", "ends_sha256"])
                done = []
        if sha is not None:
            done.append((node, sha.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["node", "ends_sha256"])

    members = ended.select(node.alias("node"), "conv_id")
    dealt = members.repartitionByRange(tasks(spark), "node", "conv_id").sortWithinPartitions("node", "conv_id")
    packed = dealt.mapInArrow(chunks, "node binary, first long, ids binary")
    gathered = packed.repartition(tasks(spark), "node").sortWithinPartitions("node", "first")
    return gathered.mapInArrow(digest, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, *, thin: int = THIN) -> DataFrame:
    """A row for each node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256, and ``node``, 16 bytes that stand for its sequence of turns.

    turns: conv_id and turns, an array of (digest, words), as :func:`conversations_as_turns` gives them.
    """
    spark = turns.sparkSession
    small_batches(spark, 4096)
    # In order of depth, so that a level reads the row groups of its own conversations.
    ended = written(paths(turns).sortWithinPartitions("depth"), "paths")
    levels: list[DataFrame] = []
    for low, high in stretches(_reach(ended), thin):
        zero = F.lit(0).cast("long")
        state = ended.filter(F.col("depth").between(low, high)).select(
            "path", "conv_id", F.lit(1).cast("long").alias("n_convs"), zero.alias("n_children"), zero.alias("leaves"), zero.alias("saved")
        )
        if levels:
            peeled = F.substring("path", 1, ENTRY * high)
            above = levels[-1].filter(F.col("depth") == high + 1)
            state = state.unionByName(
                above.select(peeled.alias("path"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
            )
        formed = _level(state, high) if low == high else _stretch(state, low, high)
        levels.append(written(formed, "nodes"))
    if not levels:
        levels = [spark.createDataFrame([], _NODE)]
    nodes = levels[0]
    for more in levels[1:]:
        nodes = nodes.unionByName(more)

    def entry(back: int) -> Column:
        there = F.col("depth") >= back
        return F.when(there, F.substring(F.col("path"), ENTRY * (F.col("depth") - back) + 1, F.lit(ENTRY))).otherwise(F.lit(b"").cast("binary"))

    named = nodes.withColumns({"node": entry(1), "above": F.when(F.col("depth") > 0, entry(2))}).drop("path")
    parents = named.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        named.join(member_digests(ended), "node", "left")
        .join(parents, "above", "left")
        .select(
            "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"), F.substring("node", 1, 16).alias("node"),
        )
    )


def op13_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(conversations_as_turns(table(spark, sf_dir, "conversations")))).drop("node")


ORACLE = r"""
WITH own AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns,
           xor(4294967295, list_reduce(
               list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
               lambda crc, byte: list_reduce(range(8), lambda r, k: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END,
                                             xor(crc, byte)),
               4294967295)) % 4 AS h
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
    FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
members AS (
    SELECT conv_id, d, turns[1:d] AS seq, len(turns) = d AS ends FROM rebuilt, unnest(range(len(turns) + 1)) AS r(d)),
nodes AS (
    SELECT seq, d, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
           CASE WHEN d > 0 THEN len(regexp_extract_all(seq[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
    FROM members GROUP BY seq, d),
children AS (SELECT seq[1:d - 1] AS seq, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
counted AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (seq, d)),
-- A node lies under each prefix of its smallest member that is as short as it or shorter.
subtrees AS (
    SELECT m.seq, m.d, CAST(sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
           CAST(sum((n.n_convs - 1) * n.words) AS BIGINT) AS saved_tokens
    FROM counted n JOIN members m ON m.conv_id = n.conv_id AND m.d <= n.d GROUP BY m.seq, m.d)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM counted n JOIN subtrees s ON s.seq = n.seq AND s.d = n.d
LEFT JOIN counted p ON n.d > 0 AND p.d = n.d - 1 AND p.seq = n.seq[1:n.d - 1]
"""
