"""Substring dedup by content-defined cuts.

A hash rolls over the bytes of a text; a cut is where the hash of the last ``REACH`` bytes is
the least of any ``STRETCH`` places in a row (equal ones all are cuts, so repeating text has one in every
period).  Whether a place is a cut depends on the bytes around it alone, never on the last cut, so every passage of
``REACH + STRETCH - 1`` = 101 bytes, as 51 words have at least, holds a cut that its copies hold too.

The digest of a cut is its hash.  The document with the smallest id keeps a digest; a later
document with that digest is compared with the keeper's text byte by byte: from each shared cut the
run is followed to its exact ends.  A run of at least ``min_words`` whole words that stands
in one earlier document is cut out of the text, at word boundaries.

Defined results: null text has no cuts and stays null; rows that share an id
are one document (a passage stays in all of its rows); rows without an id
are told apart by their text; a passage that repeats only inside one document stays; an
empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faceoff.llm.common import fresh, written

# A cut is the least hash of REACH bytes among STRETCH places: every 27 bytes on average.
REACH, STRETCH = 48, 54
MAX_CHUNK = REACH + STRETCH - 1
# a copied run is cut out from this many whole words on
MIN_WORDS = 16
# odd factor of the rolling hash, and of its last mixing
BASE, MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9


def _gear() -> np.ndarray:
    """A random number per byte value (splitmix64 of the value)."""
    z = (np.arange(1, 257, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


GEAR = _gear()


def _older(h: np.ndarray, more: np.ndarray, reach: int) -> np.ndarray:
    """``h`` of the last ``reach`` bytes with ``more`` of those before them."""
    out = h.copy()
    if len(h) > reach:
        out[reach:] += more[:-reach] * np.uint64(pow(BASE, reach, 1 << 64))
    return out


def hashes(data: bytes) -> np.ndarray:
    """At each byte the hash of the ``REACH`` bytes that end with it (of all, where there are fewer)."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    for reach in (1, 2, 4, 8):
        h = _older(h, h, reach)
    h = _older(h, _older(h, h, 16), 16)  # 16 and the 32 before them
    h = (h ^ (h >> np.uint64(32))) * np.uint64(MIX)
    return h ^ (h >> np.uint64(29))


def _over(h: np.ndarray, size: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every ``size`` values in a row, by doubling."""
    have = 1
    while have < size:
        step = min(have, size - have)
        h, have = pick(h[:-step], h[step:]), have + step
    return h


def marks(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ends, digests) of the cuts of ``data``; a text shorter than ``REACH`` has one, its end."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    h = hashes(data)
    if n < REACH:
        return np.array([n]), h[-1:].view(np.int64)
    places = h[REACH - 1 :]
    size = min(STRETCH, len(places))
    least = _over(places, size, np.minimum)
    # a place is least in one of the stretches around it if their greatest minimum is its own hash
    pad = np.zeros(size - 1, np.uint64)
    at = np.flatnonzero(places == _over(np.concatenate([pad, least, pad]), size, np.maximum))
    return at + REACH, places[at].view(np.int64)


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``; the last is its length."""
    ends = marks(data)[0].tolist()
    return ends if not data or ends[-1] == len(data) else [*ends, len(data)]


def digests(data: bytes, ends: list[int]) -> np.ndarray:
    return hashes(data)[np.array(ends, np.int64) - 1].view(np.int64)


def _alike(x: np.ndarray, y: np.ndarray) -> int:
    """How many first bytes of ``x`` and ``y`` are the same."""
    n, at, step = min(len(x), len(y)), 0, 64
    while at < n:
        other = np.flatnonzero(x[at : min(at + step, n)] != y[at : min(at + step, n)])
        if len(other):
            return at + int(other[0])
        at, step = at + step, 2 * step
    return n


def _repeats(data: bytes, at: list[int]) -> list[bool]:
    """Of the places of one digest: those inside a repeating stretch, with one equal period before and one after."""
    inside = [False] * len(at)
    for k in range(1, len(at) - 1):
        a, b, c = at[k - 1 : k + 2]
        inside[k] = b - a == c - b and data[a:b] == data[b:c]
    return inside


def _places(data: bytes, wanted: np.ndarray | None = None) -> dict[int, list[tuple[int, bool]]]:
    """The cuts of each digest: (end, whether inside a repeating stretch); with ``wanted`` (sorted), all places of those digests."""
    if wanted is None:
        ends, values = marks(data)
    else:
        values = hashes(data).view(np.int64)[min(REACH, len(data)) - 1 :]
        at = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)] == values)
        ends, values = at + min(REACH, len(data)), values[at]
    found: dict[int, list[int]] = {}
    for end, d in zip(ends.tolist(), values.tolist()):
        found.setdefault(d, []).append(end)
    return {d: list(zip(at, _repeats(data, at))) for d, at in found.items()}


def slices(data: bytes, wanted: list[int], foreign: list[int]) -> list[bytes]:
    """What of a keeper's text the runs around its ``wanted`` cuts can reach, and a byte more.

    ``foreign`` are the digests of the text that an earlier document keeps.  A run that goes past a cut
    of any other digest, with all that decides whether it is one, would have made that digest wanted.
    """
    ends, values = marks(data)
    match = np.isin(values, np.array(wanted, np.int64))
    at, stops = ends[match], ends[~match & ~np.isin(values, np.array(foreign, np.int64))]
    if not len(at):
        return []
    before, after = np.searchsorted(stops, at - STRETCH + 1, "right") - 1, np.searchsorted(stops, at + STRETCH - 1)
    first = np.where(before >= 0, stops[np.maximum(before, 0)] - MAX_CHUNK, 0) if len(stops) else np.zeros_like(at)
    last = np.where(after < len(stops), stops[np.minimum(after, len(stops) - 1)] + STRETCH - 1, len(data)) if len(stops) else np.full_like(at, len(data))
    joined: list[list[int]] = []
    for a, b in zip(np.maximum(first, 0).tolist(), np.minimum(last, len(data)).tolist()):
        if joined and a <= joined[-1][1]:
            joined[-1][1] = max(b, joined[-1][1])
        else:
            joined.append([a, b])
    return [data[a:b] for a, b in joined]


def shared_runs(data: bytes, own: dict[int, list[tuple[int, bool]]], kept: bytes) -> list[tuple[int, int, int]]:
    """(start, end, shift) of the runs of ``data``, whose ``_places`` are ``own``, that stand in ``kept``, to their exact ends.

    Runs are followed from every cut of ``data`` whose bytes ``kept`` has.  Inside a stretch that repeats, its first and last
    period say all; in ``data`` the others are followed where no run has come.
    """
    x, y = np.frombuffer(data, np.uint8), np.frombuffer(kept, np.uint8)
    theirs = _places(kept, np.sort(np.array(list(own), np.int64)))
    at = sorted((end, inside, d) for d in theirs for end, inside in own[d])
    reached: dict[int, int] = {}  # by shift between the texts
    runs, covered = [], 0
    for end, inside, d in at:
        if inside and end <= covered:
            continue
        for other, deep in theirs[d]:
            if deep or reached.get(end - other, 0) >= end:
                continue
            b = end + _alike(x[end:], y[other:])
            back = _alike(x[:end][::-1], y[:other][::-1])
            reached[end - other] = b
            if back >= min(REACH, len(data)):
                runs.append((end - back, b, end - other))
                covered = max(covered, b)
    return runs


def whole_words(data: bytes, kept: bytes, a: int, b: int, shift: int) -> tuple[int, int]:
    """The run drawn in to words that are whole in both texts."""
    edge = lambda text, at: not 0 <= at < len(text) or text[at : at + 1].isspace()
    if not (edge(data, a - 1) and edge(kept, a - 1 - shift)):
        while a < b and not data[a : a + 1].isspace():
            a += 1
    if not (edge(data, b) and edge(kept, b - shift)):
        b -= 1  # what is left goes on with the space after the last whole word
        while a < b and not data[b : b + 1].isspace():
            b -= 1
    return a, max(a, b)


def copied_spans(data: bytes, keepers: list[tuple[int, bytes]], min_words: int = MIN_WORDS) -> tuple[list[tuple[int, int]], list[int]]:
    """Byte spans of ``data`` to cut out, and the keys of the ``keepers`` (key, text) that they stand in.

    A span is a run of at least ``min_words`` whole words that stands in one keeper's text; spans that overlap are joined.
    """
    own, found, keys = _places(data), [], set()
    for key, kept in keepers:
        for run in shared_runs(data, own, kept):
            a, b = whole_words(data, kept, *run)
            if len(data[a:b].split()) >= min_words:
                found.append((a, b))
                keys.add(key)
    spans: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
        else:
            spans.append((a, b))
    return spans, sorted(keys)


def _key(id_col: str, text_col: str, docs: DataFrame) -> Column:
    """Long that names a document and orders documents: its id; other than whole numbers by hash."""
    whole = docs.schema[id_col].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint")
    own = F.col(id_col).cast("long") if whole else F.when(F.col(id_col).isNotNull(), F.xxhash64(id_col))
    return F.coalesce(own, F.xxhash64(text_col))


def _chunk_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        keys, found = [], []
        for key, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
            data = text.encode("utf-8", "surrogatepass")
            own = np.unique(marks(data)[1])
            found.append(own)
            keys.append(np.full(len(own), key, np.int64))
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found)), pa.array(np.concatenate(keys))], names=["digest", "key"]
            )


def copied_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, digest, first_key): cuts of a document that one of smaller key has too."""
    chunks = (
        docs.filter(F.length(text_col) > 0)
        .select(_key(id_col, text_col, docs).alias("key"), F.col(text_col).alias("text"))
        .mapInArrow(_chunk_digests, "digest long, key long")
    )
    first = (
        chunks.groupBy("digest")
        .agg(F.min("key").alias("first_key"), F.max("key").alias("last_key"))
        .filter("first_key < last_key")
        .select("digest", "first_key")
    )
    return chunks.join(first, "digest").filter("key > first_key").select("key", "digest", "first_key")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
          report: bool = False) -> DataFrame:
    """``docs`` with copied passages cut out of the text.

    With ``report``, three more columns: ``removed_bytes``, ``removed_words``
    and ``first_keys``, the sorted keys of the documents that keep the passages (they take
    the place of columns of those names).
    """
    told_fields = T._parse_datatype_string("removed_bytes long, removed_words long, first_keys array<long>").fields
    if report:
        docs = docs.drop(*(f.name for f in told_fields))
    own, asker, mine_col, others_col, keepers_col = (
        fresh(docs.columns, c) for c in ("own_key", "asker_key", "wanted_digests", "foreign_digests", "keeper_texts")
    )
    copied = written(copied_chunks(docs, id_col, text_col), "dedup-copied")
    wanted = copied.groupBy(F.col("first_key").alias(own), F.col("key").alias(asker)).agg(F.collect_list("digest").alias(mine_col))
    foreign = copied.groupBy(F.col("key").alias(own)).agg(F.collect_list("digest").alias(others_col))
    keyed = docs.withColumn(own, _key(id_col, text_col, docs))
    # all columns go along, so that both joins read one exchange of the documents
    asked = keyed.join(wanted, own).join(foreign, own, "left").select(*docs.columns, own, asker, mine_col, others_col)
    text_at = docs.columns.index(text_col)

    def reachable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found, (first_keys, keys, digest_lists, others) = ([], [], []), (c.to_pylist() for c in rows.columns[-4:])
            for text, first_key, key, mine, other in zip(rows.column(text_at).to_pylist(), first_keys, keys, digest_lists, others):
                for kept in slices((text or "").encode("utf-8", "surrogatepass"), mine, other or []):
                    for column, value in zip(found, (key, first_key, kept)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(found, (pa.int64(), pa.int64(), pa.binary()))], names=[own, "first_key", "kept"]
            )

    per_doc = (
        asked.mapInArrow(reachable, f"{own} long, first_key long, kept binary")
        .groupBy(own).agg(F.collect_set(F.struct("first_key", "kept")).alias(keepers_col))
    )
    keyed = keyed.join(per_doc, own, "left")
    n_old = len(docs.columns)
    fields = [T.StructField(f.name, f.dataType, True) for f in docs.schema]
    if report:
        fields += told_fields

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts, told = rows.column(text_at).to_pylist(), ([], [], [])
            keepers = rows.column(rows.schema.get_field_index(keepers_col))
            for k in range(rows.num_rows):
                spans, keys, data = [], [], b""
                if texts[k] and keepers[k].is_valid:
                    data = texts[k].encode("utf-8", "surrogatepass")
                    others = [(o["first_key"], o["kept"]) for o in keepers[k].as_py()]
                    spans, keys = copied_spans(data, others, min_words)
                if report:
                    told[0].append(sum(b - a for a, b in spans))
                    told[1].append(len(b" ".join(data[a:b] for a, b in spans).split()))
                    told[2].append(keys)
                if spans:
                    kept, at = [], 0
                    for a, b in spans:
                        kept.append(data[at:a])
                        at = b
                    texts[k] = b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")
            columns = rows.columns[:n_old]
            columns[text_at] = pa.array(texts, rows.schema.types[text_at])
            more = [pa.array(x, t) for x, t in zip(told, (pa.int64(), pa.int64(), pa.list_(pa.int64())))] if report else []
            yield pa.RecordBatch.from_arrays(columns + more, names=[f.name for f in fields])

    return keyed.select(*docs.columns, own, keepers_col).mapInArrow(cut_out, T.StructType(fields))
