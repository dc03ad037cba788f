"""Exact duplicates against a plain loop, with hashes that collide too."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from opsignals.llm.exact_dups import CELL, content_hash, exact_duplicates


def brute(rows, smallest=False):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        low_first = sorted(ids, key=lambda i: (i is not None, i or 0))
        keep, seen = low_first[0 if smallest else -1], False
        for i in low_first:
            kept = i == keep and not seen
            seen |= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


HASHES = {"content": content_hash, "length": lambda t: F.length(t).cast("string").cast("binary"), "constant": lambda t: F.lit(b"x")}


@pytest.mark.parametrize("hashed", HASHES)
@pytest.mark.parametrize("smallest", [False, True])
def test_equal_to_a_plain_loop(documents, odd_rows, hashed, smallest):
    rows = odd_rows + [(100 + i, f"copy of {i % 7}") for i in range(60)] + [(3 * CELL * i, "far apart") for i in range(9)]
    rows += [(None, "only nulls"), (None, "only nulls"), (-5, "below zero"), (-4, "below zero")]
    got = exact_duplicates(documents(rows), smallest=smallest, hashed=HASHES[hashed])
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, smallest)


def test_empty_table(documents):
    assert exact_duplicates(documents([])).collect() == []


def test_no_python_in_the_plan_and_texts_are_shuffled_once(documents):
    got = exact_duplicates(documents([(i, f"text {i % 5}") for i in range(50)]))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan
