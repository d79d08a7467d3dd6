"""SimHash, decontamination and substring dedup against brute force."""

import random
import time
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from faceoff.llm import chunk_dedup, decontaminate, simhash
from faceoff.llm.common import table

SF = "/root/testdata/sf0.001"
ODD_ROWS = [
    (1, "one two three four five six", "a"), (2, "one two three four five six", "b"), (2, "another text altogether here", None),
    (3, None, "c"), (4, "", "d"), (None, "one two three four five six", "e"), (None, None, None),
    (5, "word", "f"), (5, "word", "f"), (6, "x " * 30_000, "g"), (7, " \t\n ", "h"),
]
ODD_SCHEMA = "doc_id long, text string, n_words string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, ODD_SCHEMA)


# ---------------------------------------------------------------- SimHash
def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\v\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(values, distance):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in combinations(sorted(root), 2):
        if bin(a ^ b).count("1") <= distance:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {v: find(v) for v in root}


def test_fingerprint_is_the_definition():
    texts = [None, "", "  ", "One", "A b C", "a b c d", "É É É É É a b \x1c x", "the cat " * 70_000]
    for text in texts[:-1]:
        assert simhash.fingerprint(text) == slow_fingerprint(text)
    assert simhash.fingerprint(texts[-1]) == slow_fingerprint("the cat " * 2000)  # same majority


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4, 5])
@pytest.mark.parametrize("lead", [0, 3, 6])
def test_buckets_find_all_links(distance, lead, monkeypatch):
    monkeypatch.setattr(simhash, "STEP_VARIANTS", 40_000)  # forces slices
    rng = random.Random(distance * 10 + lead)
    fps = {rng.getrandbits(64) for _ in range(25)}
    for v in list(fps):
        for _ in range(3):
            v ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6)))
            fps.add(v)
    fps = sorted(fps)
    far, links = (distance + 1) // 2, []
    for bucket in range(1 << lead):
        here = [v for v in fps if bin((v >> (64 - lead)) ^ bucket).count("1") <= far]
        u, v = simhash.forest(np.array(here, np.uint64).view(np.int64), bucket, lead, distance)
        links += zip(u.view(np.uint64).tolist(), v.view(np.uint64).tolist())
    root = {v: v for v in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    want = slow_classes(fps, distance)
    assert {v: find(v) for v in fps} == want


def brute_components(rows):
    fps = {r: slow_fingerprint(r[1]) for r in rows}
    classes = slow_classes(set(fps.values()), 4)
    least = {}
    for r, fp in fps.items():
        if r[0] is not None:
            least[classes[fp]] = min(r[0], least.get(classes[fp], r[0]))
    return [(r[0], fps[r], least.get(classes[fps[r]])) for r in rows]


def test_components_of_a_table(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_FINGERPRINTS", 16)  # several buckets
    docs = table(spark, SF, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    assert got == sorted(brute_components(rows))


def test_components_of_odd_rows(odd):
    key = lambda r: tuple((x is None, x) for x in r)
    got = sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(odd).collect()), key=key)
    want = [x for r in ODD_ROWS for x in brute_components(ODD_ROWS) if x[0] == r[0] and x[1] == slow_fingerprint(r[1])]
    assert sorted(set(got), key=key) == sorted(set(want), key=key) and len(got) == len(ODD_ROWS)
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


def test_clashing_column_names(odd):
    names = ["key", "own_key", "__key", "text_key", "__text_key", "kept_id", "first_keys", "scan_hit", "_item"]
    docs = odd.select("doc_id", "text", *(F.lit(n).alias(n) for n in names))
    bench = odd.sparkSession.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    for found in (simhash.keep_one(docs), chunk_dedup.dedup(docs), decontaminate.remove_contaminated(docs, bench)):
        assert found.columns == docs.columns
        assert {tuple(r)[2:] for r in found.collect()} == {tuple(names)}
    assert chunk_dedup.dedup(docs, report=True).count() == len(ODD_ROWS)


def test_one_of_each_group_stays(odd):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(r[0] for r in rows) == [1, 2, 3, 5, 6]
    assert (2, "another text altogether here") in rows
    assert simhash.keep_one(odd.limit(0)).count() == 0


# -------------------------------------------------------- decontamination
def slow_words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if c > "\x7f" or "0" <= c <= "9" or "a" <= c <= "z":
            word += c
        else:
            out += [word] if word else []
            word = ""
    return out


def slow_hits(text, items, size=13):
    words, hit, names = slow_words(text), set(), set()
    for name, item in items:
        other = slow_words(item)
        k = min(size, len(other))
        windows = {tuple(other[i : i + k]) for i in range(len(other) - k + 1)} if k else set()
        for i in range(len(words) - k + 1):
            if tuple(words[i : i + k]) in windows:
                hit |= set(range(i, i + k))
                names.add(str(name))
    return len(words), len(hit), sorted(names)


def test_contamination_is_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    say = lambda n: " ".join(rng.choice(["a", "B", "c", "dé", "7"]) for _ in range(n))
    items = [(k, say(rng.choice([0, 1, 4, 13, 14, 30]))) for k in range(12)] + [(12, None), (3, say(13))]
    rows = []
    for k in range(60):
        parts = [say(rng.randint(0, 20))]
        if k % 2:
            parts.append(rng.choice(items)[1] or "")
        rows.append((k, "zz ".join(parts + [say(5)]).replace(" ", rng.choice([" ", "-", "\n"])), k))
    rows += [(60, None, 0), (61, "", 0), (61, "x", 0), (None, items[3][1], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_hit int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(((r[0] is None, r[0], *slow_hits(r[1], items)) for r in rows), key=str)
    for block in (1 << 20, 60):  # one block, many blocks
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        found = decontaminate.contamination(docs, bench).collect()
        assert sorted(((r["doc_id"] is None, r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in found), key=str) == want
        kept = decontaminate.remove_contaminated(docs, bench)
        assert kept.columns == docs.columns
        clean = [r for r in rows if not (slow_hits(r[1], items)[1] and 20 * slow_hits(r[1], items)[1] >= slow_hits(r[1], items)[0])]
        assert sorted(map(tuple, kept.collect()), key=str) == sorted(clean, key=str)


def test_longest_matches(spark):
    words = [f"w{k}" for k in range(40)]
    docs = spark.createDataFrame(
        [(1, " ".join(words[:20])), (2, "x y " + " ".join(words[3:33])), (3, " ".join(words[5:18]) + " " + " ".join(words[5:18]))],
        "doc_id long, text string",
    )
    bench = spark.createDataFrame([(9, " ".join(words)), (8, "none of it")], "item_id long, text string")
    bench = bench.union(spark.createDataFrame([(None, " ".join(words[5:18]))], bench.schema))
    rows = decontaminate.longest_matches(docs, bench).collect()
    found = {r["item_start"]: (r["length"], r["match_id"], r["match_start"]) for r in rows if r["item"] == "9"}
    assert found[0] == (20, 1, 0) and found[3] == (30, 2, 2) and found[5] == (28, 2, 4) and found[20] == (13, 2, 19)
    assert set(found) == set(range(21)) and len(rows) == 25
    nameless = sorted((r["match_id"], r["match_start"], r["length"]) for r in rows if r["item"] is None)
    assert nameless == [(1, 5, 13), (2, 4, 13), (3, 0, 13), (3, 13, 13)]


def slow_longest(text, items, size=13):
    words, best = slow_words(text), (0, None)
    for _, item in items:
        other = slow_words(item)
        for p in range(len(words)):
            for q in range(len(other)):
                n = 0
                while p + n < len(words) and q + n < len(other) and words[p + n] == other[q + n]:
                    n += 1
                if n and n >= min(size, len(other)) and (n > best[0] or n == best[0] and p < best[1]):
                    best = (n, p)
    return best


def test_longest_match_of_a_document_is_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice("abcde") for _ in range(n))
    items = [(None, say(30)), (1, say(40)), (1, say(5)), (2, "a " * 20), (3, say(17))]
    rows = [(k, " ".join([say(9), *(i for _, i in rng.sample(items, k % 3)), "zz", say(rng.randint(0, 40))])) for k in range(40)]
    rows += [(90, items[0][1]), (91, "a " * 50), (92, None), (93, "")]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {k: slow_longest(text, items) for k, text in rows}
    for block in (1 << 20, 60):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        found = {r["doc_id"]: r for r in decontaminate.contamination(docs, bench).collect()}
        assert {k: (r["longest_words"], r["longest_at"]) for k, r in found.items()} == want
        assert found[90]["n_hit"] == 30 and "None" not in found[90]["items"]  # an item without an id has windows


def test_a_long_item_takes_linear_time():
    words = " ".join(f"w{k % 5000}x{k}" for k in range(16_000))
    began = time.perf_counter()
    _, hit, _, longest = decontaminate.hits(["before " + words + " after"], decontaminate.TestSuffixes([("1", words)]))
    assert hit.sum() == 16_000 and longest.tolist() == [[16_000, 1]]
    assert time.perf_counter() - began < 3


def test_no_benchmark_and_no_documents(spark, odd):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.remove_contaminated(odd, empty).count() == len(ODD_ROWS)
    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert decontaminate.remove_contaminated(odd.limit(0), bench).count() == 0
    assert decontaminate.remove_contaminated(odd, bench).count() == len(ODD_ROWS) - 3


# -------------------------------------------------------- substring dedup
def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnoprstuvwéñ") for _ in range(rng.randint(1, 9))) for _ in range(n))


def test_cuts_cover_the_text_and_resist_shifts():
    rng = random.Random(1)
    data = prose(rng, 3000).encode()
    ends = chunk_dedup.cuts(data)
    assert ends[-1] == len(data) and all(0 < b - a <= chunk_dedup.MAX_CHUNK for a, b in zip([0, *ends], ends))
    assert 18 < len(data) / len(ends) < 32
    own = set(chunk_dedup.digests(data, ends).tolist())
    moved = b"inserted words " + data
    other = chunk_dedup.digests(moved, chunk_dedup.cuts(moved)).tolist()
    assert sum(d not in own for d in other) <= 4
    assert chunk_dedup.cuts(b"") == [] and chunk_dedup.cuts(b"a" * 1000)[-1] == 1000


def test_shared_passages_are_cut_from_later_documents(spark):
    rng = random.Random(2)
    passages = [prose(rng, rng.randint(51, 90)) for _ in range(60)]
    rows = [(k, prose(rng, 30) + " " + passages[k % 60] + " " + prose(rng, 30), k) for k in range(240)]
    rows += [(900, prose(rng, 400), 0), (901, None, 0), (902, "", 0), (None, passages[0], 0), (903, passages[0], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, removed_words int").repartition(5)
    got = {r["doc_id"]: r["text"] for r in chunk_dedup.dedup(docs).collect()}
    assert len(got) == len(rows)
    caught = 0
    for k, text, _ in rows[:240]:
        head, tail = text.split(passages[k % 60])
        if k < 60:
            assert got[k] == text  # the first keeps it
        else:
            caught += passages[k % 60] not in got[k]
            assert got[k].startswith(head) and got[k].endswith(tail)  # nothing else goes
    assert caught >= 178  # of 180
    assert got[900] == rows[240][1] and got[901] is None and got[902] == ""
    assert docs.columns == chunk_dedup.dedup(docs).columns
    told = chunk_dedup.dedup(docs.drop("removed_words"), report=True).filter("doc_id = 60").first()
    assert told["first_keys"] == [0] and 16 <= told["removed_words"] <= 90


def test_dedup_of_odd_rows(odd):
    rows = sorted(((r["doc_id"], r["text"]) for r in chunk_dedup.dedup(odd).collect()), key=str)
    assert len(rows) == len(ODD_ROWS)
    assert rows == sorted(((r[0], r[1]) for r in ODD_ROWS), key=str)
    assert chunk_dedup.dedup(odd.limit(0)).count() == 0


def test_every_shared_passage_goes_to_its_ends(spark):
    rng = random.Random(8)
    passages = [prose(rng, 51) for _ in range(60)] + [" ".join(rng.choices("abcdefgh", k=51)) for _ in range(20)]
    for size in (1, 2, 3, 5, 8):  # phrases that repeat
        passages += [" ".join(([*prose(rng, size).split()] * 60)[:60]) for _ in range(20)]
    n = len(passages)
    rows = [(k, f"{prose(rng, rng.randint(5, 60))} Q{k} {passages[k % n]} Z{k} {prose(rng, 30)}") for k in range(2 * n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["text"] for r in chunk_dedup.dedup(docs).collect()}
    assert [got[k] for k in range(n)] == [text for _, text in rows[:n]]
    want = [text.replace(f"{passages[k % n]} ", "") for k, text in rows[n:]]
    assert [got[k] for k in range(n, 2 * n)] == want


def test_text_stitched_from_several_documents_stays(spark):
    rng = random.Random(9)
    texts = [prose(rng, 200) for _ in range(40)]
    pieces = []
    for text in texts:
        data, ends = text.encode(), chunk_dedup.cuts(text.encode())
        chunks = [data[a:b] for a, b in zip(ends, ends[1:-1]) if 16 <= b - a]
        pieces.append(rng.choice(chunks).decode(errors="replace"))
    stitched = "".join(p for p in pieces if "�" not in p)
    assert len(stitched.split()) > 100
    docs = spark.createDataFrame([*enumerate(texts), (99, stitched)], "doc_id long, text string").repartition(4)
    assert {r["doc_id"]: r["text"] for r in chunk_dedup.dedup(docs).collect()} == dict([*enumerate(texts), (99, stitched)])
