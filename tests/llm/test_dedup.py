"""Repeated bytes, near-duplicates and licences against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opsignals.llm import known_licences, near_dups, suffix_dedup
from opsignals.llm.components import components
from opsignals.llm.licences import KNOWN, known_digests, licence_scan


def brute_spans(rows, length=100):
    """(doc_id, text) in order to the bytes covered by an earlier string."""
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).digest())):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            part = data[i : i + length]
            if part in seen:
                gone[i : i + length] = True
            seen.add(part)
        out.append((doc, text, gone))
    return out


def test_repeats_equal_brute_force(documents, odd_rows):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "über", "naïve", "x"]
    shared = " ".join(rng.choice(words) for _ in range(60))
    rows = odd_rows + [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 90))) + shared[rng.randint(0, 99) : rng.randint(100, 300)]) for i in range(60)]
    found = suffix_dedup.repeated_spans(documents(rows)).collect()
    got = {(r.doc_id, bytes(r.sha)): ([(s.start, s.stop) for s in r.spans], bytes(r.kept)) for r in found}
    copies = set()
    for doc, text, gone in brute_spans(rows):
        data = (text or "").encode()
        sha = hashlib.sha256(data).digest()
        if sha in copies:  # a later copy goes as a whole
            assert gone.all() or len(data) < 100
            continue
        copies.add(sha)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0])))).reshape(-1, 2)
        spans, kept = got.pop((doc, sha), ([], data))
        assert spans == [tuple(e) for e in edges.tolist()], doc
        assert kept == bytes(np.frombuffer(data, np.uint8)[~gone])
    assert not got


def test_texts_without_their_repeats(documents, odd_rows):
    docs = documents(odd_rows)
    out = suffix_dedup.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(odd_rows)
    whole = sum(len((t or "").encode()) for _, t in odd_rows) - sum(g.sum() for *_, g in brute_spans(odd_rows))
    assert sum(len((r.text or "").encode()) for r in out.collect()) == whole
    assert suffix_dedup.without_repeats(documents([])).count() == 0


def words(rng, n):
    return [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randint(0, 400)}" for _ in range(n)]


def edited(rng, text, share):
    return [w if rng.random() > share else f"new{rng.randint(0, 99999)}" for w in text]


def jaccard(a, b):
    one, other = ({tuple(x[i : i + 5]) for i in range(max(1, len(x) - 4))} for x in (a, b))
    return len(one & other) / len(one | other)


def test_near_duplicates_meet(documents, odd_rows):
    rng = random.Random(7)
    rows, texts = list(odd_rows), {}
    for g in range(30):
        base = words(rng, 150)
        for k in range(3):
            texts[1000 + 10 * g + k] = edited(rng, base, 0.005 * k)
    hub = words(rng, 200)  # more variants than a band pairs up
    for k in range(60):
        texts[5000 + k] = edited(rng, hub, 0.01) if k else hub
    for k in range(100):
        texts[9000 + k] = words(rng, 120)
    rows += [(i, " ".join(t)) for i, t in texts.items()]
    found = near_dups.near_duplicates(documents(rows)).collect()
    assert len(found) == len(rows)
    cls = {r.doc_id: r.class_id for r in found if r.doc_id in texts}
    pairs = [(a, b) for a in texts for b in texts if a < b and a // 1000 == b // 1000]
    close = [(a, b) for a, b in pairs if jaccard(texts[a], texts[b]) >= 0.85]
    assert len(close) > 300 and all(cls[a] == cls[b] for a, b in close)
    assert len({cls[i] for i in cls if i >= 9000}) == 100
    assert all(cls[a] != cls[b] for a, b in pairs if jaccard(texts[a], texts[b]) < 0.3 and a < 5000)
    own = defaultdict(set)
    for r in found:
        own[bytes(r.node)].add(r.class_id)
    assert all(len(c) == 1 for c in own.values())
    kept = near_dups.one_of_each(documents(rows))
    assert kept.count() == len({bytes(r.root) for r in found})
    assert near_dups.near_duplicates(documents([])).count() == 0


def test_pairs_of_one_template_meet(documents):
    """Documents share a passage of 85% of their weight; planted pairs share more."""
    rng = random.Random(11)
    passage, texts = words(rng, 114), {}
    for k in range(1200):
        texts[k] = passage + [f"own{k}x{j}" for j in range(10)]
    planted = [(2 * k, 2 * k + 1) for k in range(300)]
    for a, b in planted:
        texts[b] = passage + texts[a][114:121] + [f"own{b}y{j}" for j in range(3)]
    found = near_dups.near_duplicates(documents([(i, " ".join(t)) for i, t in texts.items()])).collect()
    cls = {r.doc_id: r.class_id for r in found}
    assert [p for p in planted if cls[p[0]] != cls[p[1]]] == []
    assert len(set(cls.values())) == 900


def test_a_row_meets_the_few_of_its_band_once(spark):
    rng = random.Random(9)
    rows = [(k % 3, bytes([k]), bytes([k % 50]), [rng.randint(0, 2) for _ in range(30)]) for k in range(240)]
    placed = spark.createDataFrame(rows, "key long, node binary, own binary, sketch array<short>")
    lead = placed.filter(F.hex("node") < "24")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        best = near_dups.likeliest(placed, lead)
        got = {bytes(r.node): (r.best.times, bytes(r.best.lead)) for r in best.collect()}
        plan, made = [best._jdf.queryExecution().executedPlan()], []
        while plan:
            node = plan.pop()
            plan += [node.children().apply(i) for i in range(node.children().size())]
            if node.nodeName().endswith("Join"):
                made.append(node.metrics().apply("numOutputRows").value())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    want = {}
    for key, node, own, sketch in rows:
        others = [(sum(map(int.__eq__, sketch, s)), n) for k, n, o, s in rows if k == key and n < bytes([0x24]) and o != own]
        want[node] = max(others)
    assert got == want and len(made) == 1 and made[0] <= len(rows)


def test_prefixes_leave_out_no_pair_alike(spark):
    rng = random.Random(12)
    base, texts = words(rng, 120), []
    for k in range(90):  # of many lengths and degrees of likeness, with runs both rare and in most texts
        texts.append(edited(rng, base[: rng.randint(60, 120)], rng.choice([0, 0.005, 0.01, 0.03])) + words(rng, rng.randint(0, 30)))
    texts = [" ".join(t) for t in texts]
    rows = [(i.to_bytes(2), t) for i, t in enumerate(texts)]
    chosen = spark.createDataFrame(rows, "node binary, text string")
    many = spark.createDataFrame([(n, 1) for n, _ in rows], "node binary, key long")
    idf = np.ones(near_dups.WIDTH, np.float32)
    pairs = near_dups.crowded_pairs(many, spark.createDataFrame([], "node binary, root binary"), chosen, idf, 0.8).collect()
    sets = [near_dups.weighted_runs(pa.array([t]), idf)[:2] for t in texts]
    alike = {(i, j) for i in range(90) for j in range(i + 1, 90) if near_dups.weighted_jaccard(sets[i], sets[j]) >= 0.8}
    got = {(int.from_bytes(p.a), int.from_bytes(p.b)) for p in pairs}
    assert len(alike) > 20 and alike <= got and len(got) < 90 * 89 / 4


def test_draws_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 1 << 63, 3000, np.uint64)
    weights = rng.random(3000).astype(np.float32) + 0.5
    sampler = near_dups.Sampler(draws=400)
    one, other = np.sort(keys[:2000]), np.sort(keys[500:2500])
    of = dict(zip(keys.tolist(), weights.tolist()))
    sets = [(k, np.array([of[int(x)] for x in k], np.float32)) for k in (one, other)]
    drawn = sampler.draw(np.concatenate([one, other]), np.concatenate([s[1] for s in sets]), np.array([0, 2000, 4000]))
    assert abs((drawn[0] == drawn[1]).mean() - near_dups.weighted_jaccard(*sets)) < 0.08


def test_components_follow_chains(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert roots == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("kind", ["whole", "line"])
def test_licences_in_any_spelling(spark, documents, odd_rows, kind):
    mit = dict(reversed(KNOWN))["MIT"]
    spelt = "Copyright (c) 2001 Someone\n(c) another\n\n" + next(t for n, t in KNOWN if n == "ISC").upper().replace(",", " ,")
    rows = {1: "first line\nRELEASED under the MIT Licence!\nlast", 2: spelt, 3: mit, 4: "nothing of the kind", 5: None}
    found = {r.doc_id: r for r in licence_scan(documents([*rows.items(), (1, "more of one")]), known_digests(spark)).collect()}
    assert len(found) == 5
    if kind == "whole":
        assert [found[i].licence for i in (1, 2, 3, 4, 5)] == [None, "ISC", "MIT", None, None]
    else:
        assert [(found[i].n_notices, found[i].notices) for i in (1, 3, 4, 5)] == [(1, "MIT"), (1, "MIT"), (0, ""), (0, "")]
    assert licence_scan(documents([]), known_digests(spark)).count() == 0


def test_licences_as_published(spark, documents):
    mit, isc = ([t for n, t in KNOWN if n == name][-1] for name in ("MIT", "ISC"))
    whole = {n: t for n, t in known_licences.PUBLISHED if len(t) > 1000}
    cases = [
        ("MIT", "MIT License\n\nCopyright (c) 2020 A\n\n" + mit),
        ("MIT", "The MIT License (MIT)\r\n\r\nCopyright (c) 2020 A\r\n\r\n" + mit),
        ("ISC", "ISC License\n\nCopyright 2020 A\n" + isc),
        ("BSD-2-Clause", "BSD 2-Clause License\n\nCopyright (c) 2020, A\nAll rights reserved.\n\n" + whole["BSD-2-Clause"]),
        ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, A\n\n" + next(t for n, t in known_licences.PUBLISHED if n == "BSD-3-Clause" and len(t) > 1000)),
    ]
    for name, title in {"Apache-2.0": 3, "GPL-2.0": 2, "GPL-3.0": 2, "LGPL-2.1": 2, "LGPL-3.0": 2, "MPL-2.0": 2, "CC0-1.0": 3}.items():
        text = next(t for n, t in known_licences.PUBLISHED if n == name and len(t) > 1000)
        cases += [(name, text), (name, "\n".join(text.strip().split("\n")[title:]))]
    notices = [("GPL-2.0", "// SPDX-License-Identifier: GPL-2.0-or-later"), ("BSD-3-Clause", "# SPDX-License-Identifier: BSD-3-Clause"), ("MPL-2.0", "Licensed under the Mozilla Public License, v. 2.0.")]
    rows = dict(enumerate([t for _, t in cases] + [f"a\n{t}\nb" for _, t in notices]))
    found = {r.doc_id: r for r in licence_scan(documents(rows.items()), known_digests(spark)).collect()}
    assert [found[i].licence for i in range(len(cases))] == [n for n, _ in cases]
    assert [found[len(cases) + i].notices for i in range(len(notices))] == [n for n, _ in notices]
