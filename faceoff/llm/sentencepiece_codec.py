"""SentencePiece ids by a streaming lattice search, and back to text.

Boundaries are visited from left to right; for every boundary one backpointer
survives.  Only boundaries within the longest piece's length can still be
extended; as soon as the paths from all of them run through one boundary, the ids up
to it are committed and forgotten.

The model file says which path survives at a boundary.  A unigram model: the
one of the largest sum of piece scores.  A BPE model: the one whose last two
pieces BPE would leave side by side - a sequence of pieces is the BPE
encoding exactly if that holds for each neighbouring pair, so one path survives here too.
Ids are those of the sentencepiece library in both cases.

No piece spans the start of a word mark, so a text falls into pieces of work at
its spaces; a worker keeps the ids of those it has met in a bounded cache.

Defined results: null and empty texts have no ids and decode to the empty text;
characters without a piece become byte pieces (or the unknown id); very long words
only use the window; rows are coded one by one, so repeats are alike;
extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
# Entries that a worker's caches hold before they start anew (some 200 MB in all).
CACHE_WORDS = 250_000
CACHE_SEGMENTS = 100_000
CACHE_PREFIXES = 100_000
CACHE_PAIRS = 400_000
LONGEST_CACHED = 64
PREFIX = 6
# sentencepiece's penalty of an unknown character below the worst score
UNKNOWN_PENALTY = 10.0
_RUNS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Model:
    """Pieces of a model file and the search over them."""

    def __init__(self, path: str | None = None, proto: bytes | None = None):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        if proto is None:
            with open(path, "rb") as f:
                proto = f.read()
        lib = sentencepiece.SentencePieceProcessor(model_proto=proto)
        spec = pb.ModelProto.FromString(proto)
        if spec.trainer_spec.model_type not in (spec.trainer_spec.UNIGRAM, spec.trainer_spec.BPE):
            raise ValueError("only unigram and BPE models have a lattice of pieces")
        if spec.normalizer_spec.precompiled_charsmap or spec.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models that keep the text as it is can be decoded to the same text")
        self.bpe = spec.trainer_spec.model_type == spec.trainer_spec.BPE
        self.dummy_prefix = spec.normalizer_spec.add_dummy_prefix
        self.unknown = lib.unk_id()
        n = lib.get_piece_size()
        self.byte_ids = {lib.id_to_piece(i): i for i in range(n) if lib.is_byte(i)}
        self.byte_ids = [self.byte_ids[f"<0x{b:02X}>"] for b in range(256)] if len(self.byte_ids) == 256 else None
        skip = lambda i: lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)
        self.ids = {lib.id_to_piece(i): i for i in range(n) if not skip(i)}
        self.pieces = [None if skip(i) else lib.id_to_piece(i) for i in range(n)]
        self.scores = [lib.get_score(i) for i in range(n)]
        self.longest = max(map(len, self.ids))
        # id of a piece, -1 for what is only the end of pieces
        self.tails = {p[k:]: -1 for p in self.ids for k in range(len(p))} | self.ids
        self.unknown_score = min(self.scores[i] for i in self.ids.values()) - UNKNOWN_PENALTY
        self.splits = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.lines = "\n" not in "".join(self.ids)  # then no piece spans the end of a line
        self.pairs: dict[int, bool] = {}  # by both ids
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the words known before, when there were too many
        self.segments: dict[str, bytes] = {}  # parts of words without a mark
        self.adjacent = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.prefixes: dict[str, tuple] = {}  # previous boundaries and last ids of a short prefix
        self.lengths = [len(p or "") for p in self.pieces]
        # what an id stands for in a text, and the byte of a byte piece (else -1)
        self.surfaces = [p.replace(MARK, " ") if p is not None else " ⁇ " if i == self.unknown else "" for i, p in enumerate(self.pieces)]
        self.byte_of = np.full(n, -1, np.int16)
        if self.byte_ids:
            self.byte_of[self.byte_ids] = np.arange(256)

    # ------------------------------------------------------------ the search
    def side_by_side(self, left: str, right: str) -> bool:
        """Whether BPE, merge by merge, ends with these two pieces on their joined text."""
        parts, split, ids, scores = list(left + right), len(left), self.ids, self.scores
        joined = [ids.get(parts[k] + parts[k + 1]) for k in range(len(parts) - 1)]
        while True:
            best, at = None, -1
            for k, i in enumerate(joined):
                if i is not None and (best is None or scores[i] > best):
                    best, at = scores[i], k
            if at < 0:
                return parts == [left, right]
            before = sum(map(len, parts[: at + 1]))
            if before == split:
                return False  # a merge across
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del joined[at]
            for k in (at - 1, at):
                if 0 <= k < len(joined):
                    joined[k] = ids.get(parts[k] + parts[k + 1])

    def _fits(self, left: int, right: int) -> bool:
        """Whether BPE leaves these two pieces side by side; remembered."""
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        fits = self.pairs[left * len(self.pieces) + right] = self.side_by_side(self.pieces[left], self.pieces[right])
        return fits

    def _bpe_steps(self, text: str, base: int, back: list, last: list, until: int) -> None:
        """For each boundary up to ``until`` the one piece that BPE leaves at its end."""
        tail, fits, n, longest = self.tails.get, self.pairs.get, len(self.pieces), self.longest
        for end in range(base + len(last), until + 1):
            at, chosen = end - 1, -ord(text[end - 1]) - 1
            for start in range(end - 1, max(base, end - longest) - 1, -1):
                i = tail(text[start:end])
                if i is None:
                    break
                if i >= 0:
                    before = last[start - base]
                    if before is not None and before >= 0:
                        fit = fits(before * n + i)
                        if not (self._fits(before, i) if fit is None else fit):
                            continue
                    at, chosen = start, i
                    break
            back.append(at)
            last.append(chosen)

    def _unigram_step(self, text: str, end: int, base: int, last: list, total: list) -> tuple[int, int, float]:
        """Start, id and score of the best path's piece at the end of text[:end]."""
        tails, scores, chosen = self.tails, self.scores, None
        for start in range(end - 1, max(base, end - self.longest) - 1, -1):
            i = tails.get(text[start:end])
            if i is None:
                break
            # of equals the longest piece, as in the library
            if i >= 0 and (chosen is None or total[start - base] + scores[i] >= chosen[2]):
                chosen = (start, i, total[start - base] + scores[i])
        if text[end - 1] not in self.ids:
            unknown = total[end - 1 - base] + self.unknown_score
            if chosen is None or unknown > chosen[2]:
                chosen = (end - 1, -ord(text[end - 1]) - 1, unknown)
        return chosen

    def _unigram_steps(self, text: str, base: int, back: list, last: list, total: list, until: int) -> None:
        for end in range(base + len(last), until + 1):
            for kept, found in zip((back, last, total), self._unigram_step(text, end, base, last, total)):
                kept.append(found)

    def path(self, text: str) -> Iterator[int]:
        """Ids of ``text`` (marks in place of spaces), each as soon as it is certain.

        An unknown character yields minus its code point minus one.
        """
        base, n, window = 0, len(text), 4 * self.longest  # boundaries up to base are committed
        back, last, total = [0], [None], [0.0]  # per boundary from base on: previous boundary, id, score
        if self.bpe:  # what ends in a prefix depends on that prefix alone
            known = self.prefixes.get(text[:PREFIX])
            if known is None:
                self._bpe_steps(text, 0, back, last, min(n, PREFIX))
                if len(self.prefixes) >= CACHE_PREFIXES:
                    self.prefixes.clear()
                self.prefixes[text[:PREFIX]] = tuple(back), tuple(last)
            else:
                back, last = map(list, known)
        while True:
            until = min(n, base + window + self.longest)
            if self.bpe:
                self._bpe_steps(text, base, back, last, until)
            else:
                self._unigram_steps(text, base, back, last, total, until)
            if until == n:
                break
            # the paths of all boundaries that can still be extended, walked back until they meet
            alive = set(range(until - self.longest + 1, until + 1))
            while len(alive) > 1:
                most = max(alive)
                alive.remove(most)
                alive.add(back[most - base])
            meet = alive.pop()
            if meet > base:
                yield from self._walk(back, last, base, meet)
                keep = meet - base
                back, last, total = back[keep:], last[keep:], [t - total[keep] for t in total[keep:]]
                base = meet
            else:
                window += self.longest  # not met yet: look further
        yield from self._walk(back, last, base, n)

    @staticmethod
    def _walk(back: list, last: list, base: int, end: int) -> list[int]:
        found = []
        while end > base:
            found.append(last[end - base])
            end = back[end - base]
        return found[::-1]

    # -------------------------------------------------------- text and ids
    def _word(self, word: str) -> bytes:
        found = []
        for i in self.path(word):
            if i >= 0:
                found.append(i)
            elif self.byte_ids:
                found += [self.byte_ids[b] for b in chr(-i - 1).encode("utf-8", "surrogatepass")]
            elif not found or found[-1] != self.unknown:
                found.append(self.unknown)
        return np.array(found, "<i4").tobytes()

    def encode_bytes(self, text: str | None) -> bytes:
        """Ids of a text as little-endian 32-bit numbers."""
        if not text:
            return b""
        known = self.words
        if self.dummy_prefix and self.splits and MARK not in text:
            words = (text.replace("\n", " \n") if self.lines else text).split(" ")
            if "" not in words:  # single spaces: every word has one mark before it, or starts a line without one
                found = list(map(known.get, words))
                return b"".join([x if x is not None else self._cached(w) for w, x in zip(words, found)])
        marked = (MARK if self.dummy_prefix else "") + text.replace(" ", MARK)
        return b"".join(map(self._word, _RUNS.findall(marked) if self.splits else [marked]))

    def _cached(self, word: str) -> bytes:
        """Ids of one word with a mark before it, or of a line's end and the word after it.

        Cut where two characters stand side by side that no piece has so.
        """
        ids = self.words.get(word)
        if ids is None:
            ids = self.older.get(word)
            if ids is None:
                marked, near = word if self.lines and word[0] == "\n" else MARK + word, self.adjacent
                at = [k for k in range(1, len(marked)) if marked[k - 1 : k + 1] not in near] if self.byte_ids else []
                if at:
                    cut = [marked[a:b] for a, b in zip([0, *at], [*at, len(marked)])]
                    ids = b"".join([self._cached(c[1:]) if c[0] == MARK and len(c) > 1 else self._segment(c) for c in cut])
                else:
                    ids = self._word(marked)
            if len(word) <= LONGEST_CACHED:
                if len(self.words) >= CACHE_WORDS:
                    self.words, self.older = {}, self.words
                self.words[word] = ids
        return ids

    def _segment(self, text: str) -> bytes:
        ids = self.segments.get(text)
        if ids is None:
            ids = self._word(text)
            if len(text) <= LONGEST_CACHED:
                if len(self.segments) >= CACHE_SEGMENTS:
                    self.segments.clear()
                self.segments[text] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<i4").tolist()

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """Text of the ids; bytes that are no UTF-8 become replacement characters."""
        ids = np.asarray(ids, np.int64)
        plain = self.surfaces.__getitem__
        raw = self.byte_of[ids] >= 0
        if not raw.any():
            text = "".join(map(plain, ids.tolist()))
        else:  # runs of bytes are characters of their own
            out, edges = [], [0, *(np.flatnonzero(raw[1:] != raw[:-1]) + 1).tolist(), len(ids)]
            for a, b in zip(edges, edges[1:]):
                if raw[a]:
                    out.append(self.byte_of[ids[a:b]].astype(np.uint8).tobytes().decode("utf-8", "replace"))
                else:
                    out += map(plain, ids[a:b].tolist())
            text = "".join(out)
        return text[1:] if self.dummy_prefix and text[:1] == " " else text


_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    """The worker's model of a path, loaded once."""
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that few texts have their ids in memory at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids: array<int>) of every document."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = model(path)
        for rows in _slices(batches):
            coded = [np.frombuffer(coder.encode_bytes(t), "<i4") for t in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(coded, pa.list_(pa.int32()))], names=[id_col, "ids"])

    return docs.select(id_col, text_col).mapInArrow(
        code, T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    )


def decode(coded: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``coded`` with the text of its ids."""

    @F.pandas_udf("string")
    def text_of(ids: pd.Series) -> pd.Series:
        coder = model(path)
        return pd.Series([coder.decode([] if i is None else i) for i in ids])

    return coded.withColumn(text_col, text_of(F.col(ids_col)))


def coded_both_ways(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, same_text): the ids of every document, and whether they decode to its text."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = model(path)
        for rows in _slices(batches):
            texts = rows.column(1).to_pylist()
            ids = [np.frombuffer(coder.encode_bytes(t), "<i4") for t in texts]
            same = [coder.decode(i) == (t or "") for i, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([len(i) for i in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(same)],
                names=[id_col, "n_tokens", "ids", "same_text"],
            )

    schema = T._parse_datatype_string("n_tokens long, ids array<int>, same_text boolean")
    return docs.select(id_col, text_col).mapInArrow(check, T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *schema.fields]))


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, same_text): the ids of every document, and whether they decode to its text.

    Encoded and decoded in one pass, so that no ids leave the task.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = model(path)
        for rows in _slices(batches):
            texts = rows.column(1).to_pylist()
            coded = [coder.encode_bytes(t) for t in texts]
            same = [coder.decode(np.frombuffer(c, "<i4")) == (t or "") for c, t in zip(coded, texts)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([len(c) // 4 for c in coded], pa.int64()),
                 pa.array([hashlib.sha256(c).hexdigest() for c in coded]), pa.array(same)],
                names=[id_col, "n_tokens", "ids_sha256", "same_text"],
            )

    schema = T._parse_datatype_string("n_tokens long, ids_sha256 string, same_text boolean")
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), *schema.fields]
    return docs.select(id_col, text_col).mapInArrow(check, T.StructType(fields))
