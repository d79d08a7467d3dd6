"""Benchmark decontamination with suffix arrays over the training words.

Every task takes its documents in shards (one Arrow batch each, whole texts)
and builds a suffix array of the shard's words.  Words that no benchmark item
has cannot match, so they become separators, and runs of other words that are
shorter than the shortest window are left out before sorting.  Every suffix of
every item is then binary-searched in the shard, all at once: the range of
suffixes that agree is narrowed word by word until it agrees on a window.  The
longest verbatim matches come from the same suffixes of the hit documents ranked together
with those of the items: two neighbours in that order share the most words, which
ranks by powers of two tell without reading them.

The benchmark comes to the tasks in blocks of at most ``BLOCK_BYTES`` of text;
the documents pass through one mapper a block inside one stage, and nothing is
shuffled.

Defined results: null or empty text has no words and is never contaminated;
null or empty items match nothing; an item without an id has windows but no name; an item of fewer words than a window is one
window; items that repeat (same id) count once; an empty benchmark keeps all
documents; extra columns are passed through whatever their names are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faceoff.llm.common import fresh

WINDOW_WORDS = 13
BLOCK_BYTES = 32 << 20
# a document is contaminated if hit words * HIT_SHARE >= words
HIT_SHARE = 20

# A-Z to a-z; every other ASCII character that is no digit or small letter separates words.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class TestSuffixes:
    """The items of one block as word ids, and all their suffixes."""

    def __init__(self, items: list[tuple], window: int = WINDOW_WORDS):
        self.vocabulary: dict[bytes, int] = {}
        ids, self.names, bounds = [], [], [0]
        for name, text in items:
            found = words_of(text)
            if found:
                ids += [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in found]
                self.names.append(name)
                bounds.append(len(ids))
        lengths = np.diff(bounds).astype(np.int64)
        self.ids = np.array(ids, np.int64)
        self.item = np.repeat(np.arange(len(lengths)), lengths)
        self.start = np.arange(len(ids)) - np.repeat(np.array(bounds[:-1], np.int64), lengths)
        self.left = np.repeat(lengths, lengths) - self.start
        # words that a suffix must match for one window; short items count whole only
        self.need = np.repeat(np.minimum(lengths, window), lengths)
        self.size = window
        self.shortest = int(self.need.min()) if len(ids) else 0
        self.window = int(self.need.max()) if len(ids) else 0


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``ids`` ordered by the next ``depth`` values (prefix doubling)."""
    rank, done = ids.astype(np.int64), 1
    while done < depth:
        shifted = np.concatenate((rank[done:], np.zeros(min(done, len(rank)), np.int64)))[: len(rank)]
        rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + shifted, return_inverse=True)[1].astype(np.int64)
        done *= 2
    return np.argsort(rank, kind="stable")


class Shard:
    """Suffix array over the words of some documents that could match a block."""

    def __init__(self, texts: list, tests: TestSuffixes):
        get, known, counts = tests.vocabulary.get, [], []
        for text in texts:
            found = words_of(text)
            known.append(np.array([get(w, 0) for w in found], np.int64))
            counts.append(len(found))
        self.n_words = np.array(counts, np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.n_words + 1)))[:-1]
        # documents end with a separator
        ids = np.concatenate([x for k in known for x in (k, [0])]) if known else np.zeros(0, np.int64)
        self.total = len(ids)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], (ids > 0).astype(np.int8), [0]))))
        begins, ends = edge[::2], edge[1::2]
        long_enough = ends - begins >= max(1, tests.shortest)
        begins, ends = begins[long_enough], ends[long_enough]
        sizes = ends - begins + 1  # one separator after each run
        offset = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        self.at = np.repeat(begins - offset, sizes) + np.arange(int(sizes.sum()))
        self.ids = ids[self.at] if len(self.at) else ids[:0]
        self.array = suffix_array(self.ids, tests.window)

    def ranges(self, tests: TestSuffixes):
        """For every test suffix the range of the suffix array that matches ``need`` words
        (empty for suffixes shorter than that)."""
        q, n = len(tests.ids), len(self.array)
        window = np.zeros((q, 2), np.int64)
        live = np.flatnonzero(tests.left >= tests.need) if n else np.zeros(0, np.int64)
        low, high = np.zeros(len(live), np.int64), np.full(len(live), n, np.int64)
        padded, step = np.append(self.ids, np.zeros(tests.window + 1, np.int64)), 0
        while len(live):
            want = tests.ids[live + step]
            bounds = []
            for side in (0, 1):
                a, b = low.copy(), high.copy()
                while (open_ := a < b).any():
                    mid = (a + b) // 2
                    word = padded[self.array[np.minimum(mid, n - 1)] + step]
                    right = (word < want) if side == 0 else (word <= want)
                    a, b = np.where(open_ & right, mid + 1, a), np.where(open_ & ~right, mid, b)
                bounds.append(a)
            low, high = bounds
            found = low < high
            live, low, high = live[found], low[found], high[found]
            step += 1
            full = tests.need[live] == step
            window[live[full]] = np.stack([low, high], 1)[full]
            live, low, high = live[~full], low[~full], high[~full]
        return window

    def with_items(self, tests: TestSuffixes, docs: np.ndarray, items: np.ndarray) -> Joint:
        """The words of some documents and some items ranked together."""
        mine = np.flatnonzero(np.isin(self.doc_of(self.at), docs))
        theirs = np.flatnonzero(np.isin(tests.item, items))
        return Joint(self.ids[mine], mine, tests, theirs)

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, position, "right") - 1


class Joint:
    """Some words of a shard and of items, with ranks by their next 1, 2, 4, ... words."""

    def __init__(self, ids: np.ndarray, mine: np.ndarray, tests: TestSuffixes, theirs: np.ndarray):
        last = tests.left[theirs] == 1
        slot = np.arange(len(theirs)) + np.cumsum(last) - last  # after each item a word that no document has
        words = np.full(len(theirs) + int(last.sum()), len(tests.vocabulary) + 1, np.int64)
        words[slot] = tests.ids[theirs]
        self.mine, self.theirs = mine, theirs
        self.item_at = len(ids) + 1 + slot
        rank = np.unique(np.concatenate((ids, [0], words)), return_inverse=True)[1].astype(np.int64)
        self.ranks, depth = [rank], int(tests.left[theirs].max(initial=1)) + 1
        while 1 << (len(self.ranks) - 1) < depth:
            step = min(1 << (len(self.ranks) - 1), len(rank))
            after = np.concatenate((rank[step:] + 1, np.zeros(step, np.int64)))
            rank = np.unique(rank * (int(rank.max(initial=0)) + 2) + after, return_inverse=True)[1].astype(np.int64)
            self.ranks.append(rank)

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words the suffixes at ``a`` and ``b`` share from their beginning."""
        out, n = np.zeros(len(a), np.int64), len(self.ranks[0])
        for k in reversed(range(len(self.ranks))):
            x, y, rank = a + out, b + out, self.ranks[k]
            same = (x < n) & (y < n) & (rank[np.minimum(x, n - 1)] == rank[np.minimum(y, n - 1)])
            out += same.astype(np.int64) << k
        return out

    def nearest(self, asked: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each asked suffix the most words that one of ``others`` shares, and the range of those in their order."""
        rank = self.ranks[-1]
        others = others[np.argsort(rank[others], kind="stable")]
        place = np.searchsorted(rank[others], rank[asked])
        n = len(others)
        share = lambda k: np.where((k >= 0) & (k < n), self.shared(asked, others[np.clip(k, 0, n - 1)]), 0)
        most = np.maximum(share(place - 1), share(place))
        ends = []
        for sign in (-1, 1):  # neighbours share ever less on either side
            near, far = np.zeros(len(asked), np.int64), place if sign < 0 else n - place
            while (open_ := near < far).any():
                mid = (near + far) // 2
                inside = share(place - 1 - mid if sign < 0 else place + mid) >= most
                near, far = np.where(open_ & inside, mid + 1, near), np.where(open_ & ~inside, mid, far)
            ends.append(place + sign * near)
        return most, np.stack(ends, 1), others


def _expanded(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, index) for every index of every range."""
    sizes = high - low
    which = np.repeat(np.arange(len(low)), sizes)
    return which, np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[which]


def hits(texts: list, tests: TestSuffixes) -> tuple[Shard, np.ndarray, list[set], np.ndarray]:
    """The shard, which of its words are hit, the items each document has windows of, and each
    document's longest verbatim match as (words, first place); none is (0, -1)."""
    shard = Shard(texts, tests)
    covered, items = np.zeros(shard.total + 1, np.int64), [set() for _ in texts]
    longest = np.tile(np.array([0, -1], np.int64), (len(texts), 1))
    if len(shard.array):
        window = shard.ranges(tests)
        asked = np.flatnonzero(window[:, 1] > window[:, 0])
        keys = np.stack([window[asked, 0], window[asked, 1], tests.need[asked]], 1)
        ranges, which = np.unique(keys, axis=0, return_inverse=True) if len(asked) else (keys, asked)
        of_range = [set() for _ in ranges]
        for k, i in zip(which.reshape(-1).tolist(), tests.item[asked].tolist()):
            if tests.names[i] is not None:
                of_range[k].add(tests.names[i])
        r, index = _expanded(ranges[:, 0], ranges[:, 1])
        start = shard.at[shard.array[index]]
        np.add.at(covered, start, 1)
        np.add.at(covered, start + ranges[r, 2], -1)
        for d, k in np.unique(np.stack([shard.doc_of(start), r], 1), axis=0).tolist():
            items[d] |= of_range[k]
        if len(asked):
            begun, back = np.unique(shard.array[index], return_inverse=True)
            whole = np.zeros(len(begun), np.int64)
            np.maximum.at(whole, back, ranges[r, 2])
            doc = shard.doc_of(shard.at[begun])
            joint = shard.with_items(tests, np.unique(doc), np.unique(tests.item[asked]))
            most, _, _ = joint.nearest(np.searchsorted(joint.mine, begun), joint.item_at)
            most = np.where(most >= tests.size, most, whole)  # where no full window begins, a short item does
            best = np.lexsort((begun, -most, doc))
            best = best[np.flatnonzero(np.concatenate(([True], np.diff(doc[best]) > 0)))]
            longest[doc[best]] = np.stack([most[best], shard.at[begun[best]] - shard.first[doc[best]]], 1)
    return shard, np.cumsum(covered)[:-1] > 0, items, longest


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> list:
    """Broadcast blocks of the benchmark, each of at most about BLOCK_BYTES of text."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).filter("text is not null").distinct()
    n_bytes = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = n_bytes // BLOCK_BYTES + 1
    blocks = []
    for k in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        rows = sorted(((r["item"], r["text"]) for r in part.toLocalIterator()), key=lambda r: (r[0] is None, r[0] or "", r[1]))
        blocks.append(spark.sparkContext.broadcast(TestSuffixes(rows, window)))
    return blocks


def _scanned(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text_col: str, window: int):
    """``docs`` with six more columns: words, hit words, the hit ones as packed bits, items, longest match and its place."""
    names = tuple(fresh(docs.columns, c) for c in ("scan_words", "scan_hit", "scan_bits", "scan_items", "scan_longest", "scan_at"))
    zero, none = F.lit(0).cast("long"), F.lit(None)
    new = dict(zip(names, (zero, zero, none.cast("binary"), F.array().cast("array<string>"), zero, none.cast("long"))))
    out = docs.withColumns(new)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in out.schema])
    text_at, n_old = docs.columns.index(text_col), len(docs.columns)
    for block in _blocks(benchmark, item_col, item_text_col, window):

        def scan(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for rows in batches:
                before = [rows.column(n_old + k).to_pylist() for k in (2, 3, 4, 5)]
                shard, hit, items, longest = hits(rows.column(text_at).to_pylist(), block.value)
                bits, n_hit = [], []
                for first, n, old in zip(shard.first.tolist(), shard.n_words.tolist(), before[0]):
                    now = hit[first : first + n]
                    if old is not None:
                        now = now | np.unpackbits(np.frombuffer(old, np.uint8), count=n).astype(bool)
                    n_hit.append(int(now.sum()))
                    bits.append(np.packbits(now).tobytes() if n_hit[-1] else None)
                # the longest match so far; of equal ones the first
                best = [
                    (n, at) if n > m or n == m and n and at < place else (m, place)
                    for m, place, (n, at) in zip(before[2], before[3], longest.tolist())
                ]
                state = (shard.n_words, n_hit, bits, [sorted({*b, *i}) for b, i in zip(before[1], items)],
                         [n for n, _ in best], [at for _, at in best])
                types = rows.schema.types[n_old:]
                yield pa.RecordBatch.from_arrays(
                    rows.columns[:n_old] + [pa.array(x, t) for x, t in zip(state, types)], names=rows.schema.names
                )

        out = out.mapInArrow(scan, schema)
    return out, names


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW_WORDS) -> DataFrame:
    """(id, n_words, n_hit, items, longest_words, longest_at) of every document.

    ``items`` are the ids, as sorted strings, that have a window in it; ``longest_words`` is its longest verbatim
    match with an item, if that is a window or more (else 0), and ``longest_at`` the first word of the first such.
    """
    rows, (n, hit, _, items, longest, at) = _scanned(docs.select(id_col, text_col), benchmark, text_col, item_col, item_text_col, window)
    return rows.select(
        id_col, F.col(n).alias("n_words"), F.col(hit).alias("n_hit"), F.col(items).alias("items"),
        F.col(longest).alias("longest_words"), F.col(at).alias("longest_at"),
    )


def contaminated(n_hit="n_hit", n_words="n_words"):
    return (F.col(n_hit) > 0) & (F.col(n_hit) * HIT_SHARE >= F.col(n_words))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                        item_text_col: str = "text", window: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` without the contaminated ones."""
    rows, (n, hit, *_) = _scanned(docs, benchmark, text_col, item_col, item_text_col, window)
    return rows.filter(~contaminated(hit, n)).select(*docs.columns)


def longest_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW_WORDS) -> DataFrame:
    """Per test suffix (item, item_start) its longest verbatim match of at least a
    window over all shards: length in words, and a row for each location (match_id, match_start: word position)."""
    found = None
    id_type = docs.schema[id_col].dataType.simpleString()
    for block in _blocks(benchmark, item_col, item_text_col, window):

        def search(batches: Iterator[pd.DataFrame], block=block) -> Iterator[pd.DataFrame]:
            tests = block.value
            for rows in batches:
                shard = Shard(rows[text_col].tolist(), tests)
                window = shard.ranges(tests)
                asked = np.flatnonzero(window[:, 1] > window[:, 0])
                if not len(asked):
                    continue
                _, index = _expanded(window[asked, 0], window[asked, 1])
                docs_hit = np.unique(shard.doc_of(shard.at[shard.array[index]]))
                joint = shard.with_items(tests, docs_hit, np.unique(tests.item[asked]))
                most, best, order = joint.nearest(joint.item_at[np.searchsorted(joint.theirs, asked)], np.arange(len(joint.mine)))
                which, index = _expanded(best[:, 0], best[:, 1])
                start = shard.at[joint.mine[order[index]]]
                doc = shard.doc_of(start)
                yield pd.DataFrame({
                    "item": [tests.names[i] for i in tests.item[asked][which]],
                    "item_start": tests.start[asked][which], "length": most[which],
                    "match_id": rows[id_col].iloc[doc].to_numpy(), "match_start": start - shard.first[doc],
                })

        part = docs.select(id_col, text_col).mapInPandas(
            search, f"item string, item_start long, length long, match_id {id_type}, match_start long"
        )
        found = part if found is None else found.union(part)
    most = found.groupBy(F.col("item").alias("_item"), F.col("item_start").alias("_start")).agg(F.max("length").alias("_most"))
    same = F.col("item").eqNullSafe(F.col("_item")) & (F.col("item_start") == F.col("_start")) & (F.col("length") == F.col("_most"))
    return found.join(most, same).select("item", "item_start", "length", "match_id", "match_start").distinct()
