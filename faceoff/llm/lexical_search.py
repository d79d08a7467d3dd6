"""Ranked lexical search over norm buckets: the best documents of every query, exactly.

A document's impact vector has a coordinate for each query term it holds; a query's vector
has the terms' weights.  Both are scaled by the root of the weight, which leaves their
products alone and makes common terms short.  A batch of documents is sorted by the
length of its vectors and cut into buckets.  For a query, buckets are visited from the
longest down: by Cauchy-Schwarz no document of a bucket scores more than
the query's length times the bucket's greatest length, so the visit ends where that falls below the
score to beat.  Inside a bucket the query's largest coordinates are multiplied out; what the
others can add is bounded by the lengths of the two remainders and by the bucket's largest
value of each, and only documents whose bound reaches the score to beat are rescored, in integers, from
all coordinates.

The score to beat is the k-th best found so far.  It starts from the k-th best of a
sample of the documents, which can only be lower than the k-th best of all, so nothing
that belongs to the result is lost and tasks hand on few rows.

Corpus statistics cover all documents.  The first pass writes, for each document with a query
term, its length and the query terms' counts; everything after reads that table.  Queries are taken in
blocks of bounded size (``BLOCK_BYTES`` of text), each of which is broadcast and set against all documents.

Defined results: rows of one query id are one query, and null is an id; a null text has no terms; a
query without terms, or whose terms no document holds, has no rows; each row of
``docs`` is a document, so repeated ids are ranked one by one; equal scores are in ascending order of
the id, null last; empty tables give an empty result; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faceoff.llm.common import ship_code, written

TOP = 50
TERM = rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # of UTF-8: every byte of other characters is above 7F
BLOCK_BYTES = 4 << 20
SAMPLE_SHARE = 32  # one of so many documents gives the first scores to beat
BATCH_DOCS = 16_384
BUCKET_DOCS = 2048
FOCUS_SHARE = 0.95  # of a query's squared length, in its largest coordinates
SLACK = 1 + 1e-9  # bounds are in doubles
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_FIND = re.compile(TERM)

VECTORS = "id long, n_terms long, terms array<int>, counts array<int>"
FOUND = "query int, id long, score long"


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, A-Z lower-cased."""
    return _FIND.findall(text.translate(_LOWER)) if text else []


def weight(n_docs: int, n_holding: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n_holding + 1)))


# ------------------------------------------------------------ first pass
def vectors(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """(id, n_terms, terms, counts) of every document with a term; the last two cover the vocabulary only."""
    known = docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(vocabulary)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = known.value
        for rows in batches:
            ids, sizes, at, held, counts = [], [], [0], [], []
            for k, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                said = terms(text)
                if not said:
                    continue
                mine = Counter(i for i in map(index.get, said) if i is not None)
                ids.append(k)
                sizes.append(len(said))
                held += mine.keys()
                counts += mine.values()
                at.append(len(held))
            lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x, pa.int32())) for x in (held, counts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], names=["id", "n_terms", "terms", "counts"]
            )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(count, VECTORS)


# ------------------------------------------------------------- the search
class Queries:
    """A block of queries: their terms, weights and scaled vectors, largest coordinates first."""

    def __init__(self, asked: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int):
        self.weights, self.n_docs, self.n_terms = weights, n_docs, n_terms
        self.root = np.sqrt(weights.astype(float))
        self.terms, self.focus, self.others, self.length, self.rest = [], [], [], [], []
        for held in asked:
            held = held[np.argsort(-weights[held], kind="stable")]
            squares = np.cumsum(weights[held].astype(float))  # of the coordinates: their weights
            whole = squares[-1] if len(held) else 0.0
            n = int(np.searchsorted(squares, FOCUS_SHARE * whole)) + 1 if len(held) else 0
            self.terms.append(held)
            self.focus.append(held[:n])
            self.others.append(held[n:])
            self.length.append(math.sqrt(whole))
            self.rest.append(math.sqrt(max(0.0, whole - squares[min(n, len(held)) - 1])) if len(held) else 0.0)


class Batch:
    """Documents sorted by the length of their scaled impact vectors, cut into buckets; the
    vectors' entries by bucket and term."""

    def __init__(self, q: Queries, ids, no_id, n_terms, at, held, counts, bucket_docs: int = BUCKET_DOCS):
        doc = np.repeat(np.arange(len(ids)), np.diff(at))
        m = 100 - 50 + (50 * n_terms * q.n_docs) // q.n_terms
        impact = (1_000_000_000 * counts) // (1000 * counts + 20 * m[doc])
        scaled = impact * q.root[held]
        length = np.sqrt(np.bincount(doc, scaled * scaled, len(ids)))
        order = np.argsort(-length, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.no_id, self.length = ids[order], no_id[order], length[order]
        self.n_known, self.bucket_docs = len(q.weights), bucket_docs
        key = place[doc] // bucket_docs * self.n_known + held
        by_key = np.argsort(key, kind="stable")
        self.key, self.doc, self.impact, self.scaled = key[by_key], place[doc][by_key], impact[by_key], scaled[by_key]
        first = np.flatnonzero(np.diff(self.key, prepend=-1))
        self.known, self.largest = self.key[first], np.maximum.reduceat(self.scaled, first) if len(first) else self.scaled

    def entries(self, bucket: int, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the bucket's entries of the terms, and the term of each."""
        wanted = bucket * self.n_known + terms
        first = np.searchsorted(self.key, wanted)
        sizes = np.searchsorted(self.key, wanted, "right") - first
        index = np.arange(sizes.sum()) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
        return index, np.repeat(terms, sizes)

    def at_most(self, q: Queries, bucket: int, terms: np.ndarray) -> float:
        """What the terms can add to a score in the bucket, by its largest value of each."""
        wanted = bucket * self.n_known + terms
        at = np.minimum(np.searchsorted(self.known, wanted), len(self.known) - 1)
        return float(np.sum(self.largest[at] * q.root[terms] * (self.known[at] == wanted))) if len(self.known) else 0.0

    def candidates(self, q: Queries, k: int, bucket: int, beat: int) -> np.ndarray:
        """Places in the bucket whose score can reach ``beat``: partial product plus the bounds of the remainder."""
        low = bucket * self.bucket_docs
        length = self.length[low : low + self.bucket_docs]
        at, term = self.entries(bucket, q.focus[k])
        doc, value = self.doc[at] - low, self.scaled[at]
        part = np.bincount(doc, value * q.root[term], len(length))
        rest = np.sqrt(np.maximum(0.0, length * length * SLACK - np.bincount(doc, value * value, len(length))))
        rest = np.minimum(q.rest[k] * rest, self.at_most(q, bucket, q.others[k]))
        return np.flatnonzero((part + rest) * SLACK >= beat) + low

    def scores(self, q: Queries, k: int, bucket: int, places: np.ndarray) -> np.ndarray:
        """Exact integer scores of places of the bucket."""
        low = bucket * self.bucket_docs
        at, term = self.entries(bucket, q.terms[k])
        total = np.zeros(self.bucket_docs, np.int64)
        np.add.at(total, self.doc[at] - low, q.weights[term] * self.impact[at])
        return total[places - low]


class Best:
    """The best documents of one query so far: at most ``top``, best first."""

    def __init__(self, top: int, beat: int):
        self.top, self.beat = top, max(1, beat)
        self.ids, self.no_id, self.scores = np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)

    def add(self, ids, no_id, scores) -> None:
        stay = scores >= self.beat
        ids, no_id, scores = (np.concatenate([a, b[stay]]) for a, b in ((self.ids, ids), (self.no_id, no_id), (self.scores, scores)))
        order = np.lexsort((ids, no_id, -scores))[: self.top]
        self.ids, self.no_id, self.scores = ids[order], no_id[order], scores[order]
        if len(order) == self.top:
            self.beat = max(self.beat, int(self.scores[-1]))


def search_batch(q: Queries, batch: Batch, best: list[Best]) -> int:
    """Adds the batch's documents to ``best``; the number rescored."""
    rescored = 0
    for k, mine in enumerate(best):
        for bucket, low in enumerate(range(0, len(batch.ids), batch.bucket_docs)):
            if q.length[k] * batch.length[low] * SLACK < mine.beat:
                break  # no later bucket holds a longer vector
            places = batch.candidates(q, k, bucket, mine.beat)
            if len(places):
                mine.add(batch.ids[places], batch.no_id[places], batch.scores(q, k, bucket, places))
                rescored += len(places)
    return rescored


def _search(found: DataFrame, q: Queries, beat: list[int], top: int) -> DataFrame:
    """(query, id, score): each task's best documents of each query that reach ``beat``."""
    state = found.sparkSession.sparkContext.broadcast((q, beat))

    def flat(rows: pa.RecordBatch) -> Batch:
        ids, n_terms, held, counts = rows.columns
        at = held.offsets.to_numpy().astype(np.int64)
        at = at - at[0]
        return Batch(
            state.value[0], ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False),
            n_terms.to_numpy(), at, held.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy().astype(np.int64),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, beat = state.value
        best, waiting, n = [Best(top, b) for b in beat], [], 0
        for rows in batches:
            waiting.append(rows)
            n += rows.num_rows
            if n >= BATCH_DOCS:
                search_batch(q, flat(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]), best)
                waiting, n = [], 0
        if n:
            search_batch(q, flat(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]), best)
        for k, mine in enumerate(best):
            if len(mine.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(mine.ids), k, np.int32)), pa.array(mine.ids, mask=mine.no_id), pa.array(mine.scores)],
                    names=["query", "id", "score"],
                )

    return found.mapInArrow(run, FOUND)


def _first_of(rows: DataFrame, top: int) -> DataFrame:
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)


def _blocks(queries: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """(query id, text) rows in blocks of whole queries, of at most about ``BLOCK_BYTES`` of text."""
    asked = queries.select(F.col(id_col).alias("query_id"), F.col(text_col).cast("binary").alias("text")).filter("text is not null").distinct()
    n_bytes = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = n_bytes // BLOCK_BYTES + 1
    for b in range(n):
        rows = asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(n)) == b).collect()  # one block
        if rows:
            yield [(r["query_id"], bytes(r["text"])) for r in rows]


def _search_block(docs: DataFrame, block: list[tuple], top: int, id_col: str, text_col: str) -> DataFrame | None:
    spark = docs.sparkSession
    asked: dict = {}
    for query, text in block:
        asked.setdefault(query, set()).update(terms(text))
    asked = {query: held for query, held in asked.items() if held}
    vocabulary = sorted(set().union(*asked.values())) if asked else []
    if not vocabulary:
        return None
    index = {t: k for k, t in enumerate(vocabulary)}
    found = written(vectors(docs, vocabulary, id_col, text_col), "lexical-vectors")
    n_docs, n_terms = found.agg(F.count("*"), F.sum("n_terms")).first()
    if not n_docs:
        return None
    # at most one row for each term of the block
    holding = dict(found.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*")).collect())
    weights = np.array([weight(n_docs, holding.get(k, 0)) for k in range(len(vocabulary))], np.int64)
    ids = list(asked)
    # terms that no document holds add nothing to any score
    q = Queries([np.array(sorted(index[t] for t in asked[i] if index[t] in holding), np.int64) for i in ids], weights, n_docs, n_terms)
    sample = found.filter(F.pmod(F.xxhash64("id", "n_terms", "terms"), F.lit(SAMPLE_SHARE)) == 0)
    first = _first_of(_search(sample, q, [0] * len(ids), top), top).filter(F.col("rank") == top)
    reached = {r["query"]: r["score"] for r in first.select("query", "score").collect()}  # one row a query of the block
    ranked = _first_of(_search(found, q, [reached.get(k, 0) for k in range(len(ids))], top), top)
    id_type = "long" if all(i is None or isinstance(i, int) for i in ids) else "string"
    names = spark.createDataFrame(list(enumerate(ids)), f"query int, query_id {id_type}")
    return ranked.join(F.broadcast(names), "query").select("query_id", "rank", "id", "score")


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           query_col: str = "item_id", query_text_col: str = "text") -> DataFrame:
    """(query_id, rank, id, score): the ``top`` highest-scoring documents of each query."""
    ship_code(docs.sparkSession)
    total = None
    for block in _blocks(queries, query_col, query_text_col):
        part = _search_block(docs, block, top, id_col, text_col)
        if part is not None:
            total = part if total is None else total.unionByName(part)
    if total is None:
        kind = queries.schema[query_col].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"query_id {kind}, rank int, id long, score long")
    return total
