"""Conversation trie, ranked lexical search and license scans against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from faceoff.llm import conversation_trie as trie
from faceoff.llm import lexical_search as lexical
from faceoff.llm import license_scan as licenses
from faceoff.llm import queries

CONV = "conv_id long, turn long, role string, text string, part int, a long"


# --------------------------------------------------------------- the trie
def slow_trie(rows):
    conv = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            conv[c].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    conv = {c: [(r, x) for _, _, r, _, x in sorted(t)] for c, t in conv.items()}
    built = {}
    for c, own in conv.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        built[c] = tuple(conv.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, said in built.items():
        for d in range(len(said) + 1):
            members[said[:d]].append(c)
    out = set()
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        leaves = [q for q in below if not any(len(o) == len(q) + 1 and o[: len(q)] == q for o in below)]
        ends = ",".join(str(c) for c in sorted(m) if built[c] == p)
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), sum(len(q) == len(p) + 1 for q in below), len(leaves),
                 sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def odd_conversations():
    rows = [(c, t, "user" if t % 2 else "assistant", f"t{t if t < 4 else t * (c % 3)}") for c in range(-120, 330, 7) for t in range(abs(c) % 9 + 1)]
    rows += [(100 * k, t, "user", f"b{t}") for k in range(4) for t in range(k * 3)]
    rows += [(5, None, None, None), (5, None, "user", "x"), (5, 0, "user", "x"), (5, 0, "user", "x"), (6, 1, "user", ""), (6, 1, None, "é" * 5000),
             (None, 0, "user", "lost"), (7, 0, "us", "erx"), (8, 0, "user", "x"), (9, 0, "user", "x")]
    # a long conversation and its copies, which share a path
    return rows + [(c, t, "user", f"long {t}") for c in (1000, 1003, 1017) for t in range(300)]


@pytest.mark.parametrize("shard_weight", [200_000, 40, 1])
def test_trie_equals_brute_force(spark, shard_weight):
    rows = odd_conversations()
    found = trie.trie(spark.createDataFrame([(*r, 1, 2) for r in rows], CONV).repartition(7), shard_weight=shard_weight)
    got = [tuple(r)[:8] for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == slow_trie(rows)


def test_trie_of_nothing(spark):
    assert trie.trie(spark.createDataFrame([], CONV)).count() == 0
    assert trie.trie(spark.createDataFrame([(None, 0, "user", "x", 1, 2)], CONV)).count() == 0


def test_trie_of_turnless_conversations(spark):
    few = [c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1]
    rows = [(c, 0, "user", "gone") for c in few]
    found = [tuple(r)[:8] for r in trie.trie(spark.createDataFrame([(*r, 1, 2) for r in rows], CONV)).collect()]
    assert set(found) == slow_trie(rows) and found[0][:6] == (min(few), 0, None, len(few), 0, 1)


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 2**64, (2, 50_000), np.uint64, endpoint=False)
    table = trie.NodeTable(a[:40_000], b[:40_000])
    assert sorted(table.slots(a[:40_000], b[:40_000])) == list(range(40_000))
    assert (table.slots(a[40_000:], b[40_000:]) == -1).all()
    with pytest.raises(ValueError):
        trie.NodeTable(a[[1, 1]], b[[1, 1]])


def test_equal_digests_of_different_prefixes_fail(spark):
    schema = "conv long, depth long, n long, code long, a long, b long, pa long, pb long, fa long, fb long"
    rows = [(1, 1, 1, 3, 9, 9, 0, 0, 5, 5), (2, 1, 1, 3, 9, 9, 0, 0, 5, 6)]
    with pytest.raises(Exception, match="share a digest"):
        trie.nodes_of(spark.createDataFrame(rows, schema)).collect()


# --------------------------------------------------------- lexical search
def slow_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow_search(docs, asked, top):
    said = [(k, slow_terms(x)) for k, x in docs]
    said = [(k, w) for k, w in said if w]
    n_docs, n_terms = len(said), sum(len(w) for _, w in said)
    df = Counter(t for _, w in said for t in set(w))
    items = defaultdict(set)
    for i, x in asked:
        items[i] |= set(slow_terms(x))
    out = set()
    for i, held in items.items():
        scored = []
        for k, w in said:
            m, tf = 100 - 50 + (50 * len(w) * n_docs) // n_terms, Counter(w)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m))
                        for t in held if tf[t])
            if score > 0:
                scored.append((-score, k is None, k or 0, k))
        out |= {(i, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:top], 1)}
    return out


def odd_documents():
    rng = np.random.default_rng(5)
    words = np.array([f"w{k}" for k in range(60)] + ["Ünï", "K", "9a", "é"])
    texts = [" ".join(rng.choice(words, int(n), p=(p := 1 / np.arange(1, 65)) / p.sum())) for n in rng.integers(1, 40, 700)]
    docs = [(k, x) for k, x in enumerate(texts)] + [(900 + k, texts[0]) for k in range(40)] + [(1, texts[1]), (None, texts[2]), (2, None), (3, "")]
    docs += [(5000, "w1 w2, W3-w3 é " * 9000), (5001, "!?; :"), (5002, "İ K k")]
    asked = [(k, " ".join(rng.choice(words, 6))) for k in range(12)] + [(1, "w1 w1 w40"), (None, "k w7"), (50, None), (51, "..."), (52, "nowhere")]
    return docs, asked


@pytest.mark.parametrize("block_bytes", [4 << 20, 60])
def test_search_equals_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block_bytes)
    docs, asked = odd_documents()
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, id int, terms string").repartition(5)
    q = spark.createDataFrame([(*r, 1) for r in asked], "item_id long, text string, query int")
    found = [tuple(r) for r in lexical.search(d, q, top=20).collect()]
    assert len(found) == len(set(found)) and set(found) == slow_search(docs, asked, 20)


def test_search_of_nothing(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for docs, asked in ((d.limit(0), q), (d, q.limit(0)), (d, spark.createDataFrame([(1, None)], "item_id long, text string"))):
        found = lexical.search(docs, asked)
        assert found.columns == ["query_id", "rank", "id", "score"] and found.count() == 0


def test_buckets_are_pruned():
    rng = np.random.default_rng(7)
    weights = np.sort(rng.integers(1, 9000, 200))[::-1].copy()
    q = lexical.Queries([np.sort(rng.choice(200, 8, replace=False)) for _ in range(10)], weights, 20_000, 800_000)
    sizes = rng.integers(5, 80, 20_000)
    held = [np.sort(rng.choice(200, min(int(n) // 3 + 1, 30), replace=False)) for n in sizes]
    at = np.concatenate([[0], np.cumsum([len(h) for h in held])])
    flat = np.concatenate(held)
    batch = lexical.Batch(q, np.arange(20_000), np.zeros(20_000, bool), sizes, at, flat, np.ones(len(flat), np.int64))
    best = [lexical.Best(20, 0) for _ in range(10)]
    assert lexical.search_batch(q, batch, best) < 0.2 * 10 * 20_000  # rescored, of all pairs
    m = 100 - 50 + (50 * sizes * 20_000) // 800_000
    for k, mine in enumerate(best):
        mask = np.isin(flat, q.terms[k])
        part = np.where(mask, weights[flat] * (10**9 // (1000 + 20 * m[np.repeat(np.arange(20_000), np.diff(at))])), 0)
        total = np.add.reduceat(part, at[:-1])
        order = np.lexsort((np.arange(20_000), -total))[:20]
        assert mine.ids.tolist() == order.tolist() and mine.scores.tolist() == total[order].tolist()


# ---------------------------------------------------------- license scans
def slow_scan(text):
    said = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    joined = " ".join(said)
    starts = {}
    for phrase, label in licenses.BASE_PHRASES.items():
        p = phrase.split()
        starts[label] = [k for k in range(len(said)) if said[k : k + len(p)] == p]
    found = []
    for r in licenses.rules():
        for m in re.finditer(r["pattern"], joined, re.ASCII | re.IGNORECASE):
            s = joined[: m.start()].count(" ")
            found.append((s, s + m[0].count(" ") + 1, r["priority"], r["rank"], r["label"]))
    kept = [x for x in found if not any(
        y[0] <= x[0] and y[1] >= x[1] and (y[2] < x[2] or y[2] == x[2] and ((y[1] - y[0], -y[3]) > (x[1] - x[0], -x[3]))) for y in found if y is not x)]
    base = [k for v in starts.values() for k in v]
    own = {label for label, v in starts.items() if v}
    score = max([licenses.BASE_WEIGHT if base else 0.0, *(licenses.WEIGHTS[x[2]] for x in kept)])
    spans = sorted((s, e, p, r, label) for s, e, p, r, label in kept)
    return (len(said), len(base), min(base, default=None), max(base, default=None), ",".join(sorted(own)),
            ",".join(sorted(own | {x[4] for x in kept})), score), spans


TEXTS = [
    None, "", " \n.,", "nothing to see", "Released under the MIT License.", "under the mit\nLICENSE, under the MIT license",
    "Licensed under the Apache License, Version 2.0 (the \"License\")", "SPDX-License-Identifier: GPL-2.0-or-later",
    "This work is licensed under the GNU General Public License, version 3.", "the GNU Lesser General Public License, v2.1 or later",
    "cc by nc cc by nc cc by nc", "Licensed under CC BY-NC 4.0. All rights reserved.", "CC BY-NC-SA 4.0 and CC-BY 3.0 or CC0 1.0 Universal",
    "see https://www.apache.org/licenses/LICENSE-2.0 and https://opensource.org/licenses/MIT", "Copyright (c) 2019-2021 by A. B.",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "under the mit licenses", "xunder the mit license",
    "gnu general public license", "distributed by us to you under the terms of the BSD 3-Clause License", "été © 2020 Ünder the MIT License",
    "released into the public domain; the Unlicense", "Confidential and proprietary. Unauthorized copying of this file is strictly prohibited",
    "the mit license agreement and the Apache 2 license, MPL 2.0, EPL v1.0, WTFPL, LGPLv3, zlib license", "9 under the mit license 2",
    "K under the mit license", " ".join(["under the mit license or gpl v3 or the apache license version 2"] * 800),
]


def test_scan_equals_brute_force(spark, monkeypatch):
    rows = [(k // 2, x, "here", 1) for k, x in enumerate([*TEXTS, "Released under the MIT License."])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, joined string, doc int")
    found = licenses.scan(docs.repartition(3)).select("doc.*", "n_words", "base", "detections").collect()
    by_text = {x: slow_scan(x) for x in TEXTS}
    assert len(found) == len(rows)
    for r in found:
        flat, spans = by_text[r["text"]]
        assert [tuple(x) for x in sorted(r["detections"])] == spans
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    got = sorted((tuple(r) for r in queries.op13_license_scan(spark, "").collect()), key=str)
    assert got == sorted(((k, *by_text[x][0]) for k, x, *_ in rows), key=str)
    assert licenses.scan(docs.limit(0)).count() == 0


def test_scan_is_native_and_narrow(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert len(licenses.rules()) > 300 and len({r["pattern"] for r in licenses.rules()}) == len(licenses.rules())


def test_many_matches_in_one_text(spark):
    text = "mit license and the apache license version 2 0 " * 30_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = licenses.scan(docs).selectExpr("n_words", "size(base) b", "size(detections) d").first()
    assert tuple(r) == (270_000, 30_000, 90_000)
