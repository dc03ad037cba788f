"""The trie of conversation prefixes against a plain trie built from its root."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from opsignals.llm import turn_trie
from opsignals.llm.turn_trie import conversations_as_turns, prefix_trie, rebuilt, stretches

SCHEMA = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("path", "depth", "node", "key", "floor", "h", "of", "turns", "n_convs", "leaves")]
)


def table(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 10) for r in rows], SCHEMA)


def digest(role, text):
    data = f"{len(role.encode())}:{role}{text}".encode()
    return hashlib.sha256(data).digest()[:16]


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = own.get(c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20)), [])
        whole[c] = tuple(base[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    below = defaultdict(list)
    for seq in members:
        if seq:
            below[seq[:-1]].append(seq)
    leaves, saved = {}, {}
    for seq in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", seq[-1][1])) if seq else 0
        leaves[seq] = sum(leaves[s] for s in below[seq]) if below[seq] else 1
        saved[seq] = sum(saved[s] for s in below[seq]) + (len(members[seq]) - 1) * words
    out = []
    for seq, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(seq))
        parent = min(members[seq[:-1]]) if seq else None
        out.append((min(convs), len(seq), parent, len(convs), len(below[seq]), leaves[seq], saved[seq], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(seed=1, conversations=120):
    rng = random.Random(seed)
    opening = [("system", "be kind \x0b and  brief"), ("user", "hello there you")]
    rows = []
    for c in range(conversations):
        turns = opening[: rng.randint(0, 2)] + [("user" if i % 2 else "assistant", f"word {rng.randint(0, 2)}\tmore") for i in range(rng.randint(0, 5))]
        rows += [(c * 3 - 40, i, *t) for i, t in enumerate(turns)]
    rows += [(7000 + c, i, "user", f"turn {i}") for c in range(3) for i in range(60 - c)]  # long ones that part late
    rows += [(9000 + c, i, "user", "the same") for c in range(40) for i in range(2)]
    rows += [(8001, None, None, None), (8001, 3, "user", None), (8001, 3, None, "three"), (8001, 3, None, "three"), (8001, -1, "user", "")]
    rows += [(None, 1, "user", "no conversation"), (8002, 1, "user", "long " * 20_000), (8003, 0, "a:b", "c"), (8004, 0, "a", ":bc")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("thin", [1, 100, 1 << 14])
def test_equal_to_a_plain_trie(spark, thin, monkeypatch):
    monkeypatch.setattr(turn_trie, "CHUNK", 16)
    rows = rows_of(thin)
    if thin == 1:
        rows = [r for r in rows if not 7000 <= (r[0] or 0) < 7003 or r[1] < 6]
    got = prefix_trie(rebuilt(conversations_as_turns(table(spark, rows))), thin=thin)
    nodes = got.collect()
    assert sorted((tuple(r)[:-1] for r in nodes), key=repr) == brute(rows)
    assert len({bytes(r.node) for r in nodes}) == len(nodes)


def test_conversations_without_turns_are_members_of_the_root(spark):
    # crc32("1") % 4 is 3: the conversation takes three turns of number 0, which isn't there, and has no more.
    assert zlib.crc32(b"1") % 4 == 3
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b")]
    got = prefix_trie(rebuilt(conversations_as_turns(table(spark, rows)))).drop("node").collect()
    assert [tuple(r) for r in got] == brute(rows) == [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]


def test_empty_table(spark):
    assert prefix_trie(rebuilt(conversations_as_turns(table(spark, [])))).collect() == []


def test_stretches_cover_each_depth_once_and_stay_thin():
    rng = random.Random(2)
    for thin in (1, 7, 50):
        reach = sorted((rng.randint(1, 20) for _ in range(30)), reverse=True)
        found = list(stretches(reach, thin))
        assert [d for low, high in found for d in range(high, low - 1, -1)] == list(range(29, -1, -1))
        assert all(low == high or sum(reach[low : high + 1]) <= thin for low, high in found)
    assert list(stretches([], 5)) == []
