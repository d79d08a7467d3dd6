"""Token ids written to binary shards in training order.

Documents are cut into sequences of ``SEQUENCE_TOKENS`` ids (an end id closes each
document and fills its last sequence).  Sequence number i of n gets the slot
that a keyed Feistel permutation, walked until it is below n, gives to i, so
the order is random, the same in every run, and needs no sort of keys.  A
shard holds a range of ``SHARD_SEQUENCES`` slots in order, in records of one
length, so the reader goes on at any slot by multiplication.

Two passes read the documents.  The first counts the sequences of each input
partition (a few numbers a partition reach the driver, which adds them up);
the second gives out the numbers.  Both must see the same partitions, which
holds for file scans; a digest of each partition is compared, and a task fails on
a difference rather than write wrong slots.

A record is: slot, id (8 bytes each), number of the sequence in its document, ids
that are not filling (4 bytes each), the ids (2 bytes each), a line feed; all
little-endian.  Spark's text writer commits the files, so any file system that
Spark writes to will do, and a lost task leaves nothing half-written.

Defined results: null and empty texts give no sequence; a null id is written as
the least long (and that id reads back as null), a vocabulary of more than 65,535 ids is refused, ids that are no whole numbers by their hash; repeated rows are
documents of their own; an empty table writes no shards; extra columns are not read.
"""

from __future__ import annotations

import base64
import re
import sys
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.types as T
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEQUENCE_TOKENS = 256
SHARD_SEQUENCES = 8192
TASK_SHARDS = 4  # neighbouring shards that one task writes
ROUNDS = 6
NO_ID = -(1 << 63)
# The pattern of GPT-2's pre-tokenizer: only the part LOOK_AHEAD takes white space, but for one space before a word.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
LOOK_AHEAD = r"|\s+(?!\S)|\s+"
# what \s is in that pattern; Python's \s has more
WHITE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
RUN_CHARS = 64  # characters a run from which cutting saves time
RUNS = re.compile(f"({WHITE}{{2,}})")
_HEAD = np.dtype([("slot", "<i8"), ("id", "<i8"), ("sequence", "<i4"), ("n_tokens", "<i4")])


# ------------------------------------------------------------- permutation
def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finisher."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _round_keys(key: int) -> list[np.uint64]:
    return [np.uint64(xxhash.xxh64_intdigest(f"{key}:{r}".encode())) for r in range(ROUNDS)]


def slots(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Where the keyed permutation of 0..n-1 puts each index."""
    half = np.uint64(max(1, ((max(n, 2) - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys, out = _round_keys(key), index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):  # cycle walk: the domain is at most four times n
        left, right = out[todo] >> half, out[todo] & mask
        for k in keys:
            left, right = right, left ^ (_mix(right + k) & mask)
        out[todo] = left << half | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


# ------------------------------------------------------------ tokenisation
def white_runs(texts: pa.Array) -> list[int | None]:
    """How often white space stands beside white space in each text."""
    return pc.count_substring_regex(texts, RUNS.pattern).to_pylist()


class Encoder:
    """A worker's tokenizer over a rank file.

    The usual pattern ends with a look-ahead, which makes all its matching slow. It only leaves the last
    character of a run of white space to the word behind it; texts are cut there, and their parts need none.
    Texts of many runs, where the calls would take longer, and other patterns go to the library as they are.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.end = len(ranks)  # the first free id
        if self.end > 0xFFFF:
            raise ValueError(f"ids take two bytes; the vocabulary has {self.end}")
        self.library = tiktoken.Encoding("shards", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.part = self.library
        if pattern == WORDS + LOOK_AHEAD:
            self.part = tiktoken.Encoding("parts", pat_str=WORDS + r"|\s+", mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str, runs: int) -> list[int]:
        """Ids of a text that holds so many runs of white space."""
        encode = self.part.encode_ordinary
        if not runs:
            return encode(text)
        if self.part is self.library or runs * RUN_CHARS > len(text):
            return self.library.encode_ordinary(text)
        head, *rest = RUNS.split(text)
        ids = encode(head)
        for run, words in zip(rest[::2], rest[1::2]):
            # a run that ends the text is one piece
            ids += encode(run[:-1]) + encode(run[-1] + words) if words else encode(run)
        return ids

    def packed(self, text: str, runs: int) -> bytes:
        """Ids of a text, two bytes each."""
        ids = array("H", self.encode(text, runs))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


def _n_sequences(n_ids: int, length: int) -> int:
    return -(-(n_ids + 1) // length)


def sequences(ids: bytes, end: int, length: int) -> np.ndarray:
    """(sequence, position) ids of a document, closed and filled with ``end``."""
    body = np.frombuffer(ids, "<u2")
    out = np.full(_n_sequences(len(body), length) * length, end, "<u2")
    out[: len(body)] = body
    return out.reshape(-1, length)


# ------------------------------------------------------------------ writing
def stride(length: int) -> int:
    return _HEAD.itemsize + 2 * length + 1


def write_shards(docs: DataFrame, path: str, tokenizer: str, pattern: str, key: int = 1, id_col: str = "doc_id",
                 text_col: str = "text", length: int = SEQUENCE_TOKENS, shard_sequences: int = SHARD_SEQUENCES) -> int:
    """Writes the shards below ``path`` (a folder ``shard=k`` each); returns the number of sequences."""
    whole = docs.schema[id_col].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint")
    own = F.col(id_col).cast("long") if whole else F.when(F.col(id_col).isNotNull(), F.xxhash64(id_col))
    rows = docs.select(F.coalesce(own, F.lit(NO_ID)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def texts(batches: Iterator[pa.RecordBatch], count: list) -> Iterator[tuple]:
        """(id, text, its runs of white space) of the documents that have a text; their digest goes to ``count``."""
        for batch in batches:
            for name, text, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), white_runs(batch.column(1))):
                if text:
                    count[1] = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), count[1]) >> 1
                    yield name, text, runs

    def tokenised(batches: Iterator[pa.RecordBatch], count: list) -> Iterator[tuple]:
        """(id, its ids) of the documents that have a text; counts into ``count``."""
        coder = encoder(tokenizer, pattern)
        for name, text, runs in texts(batches, count):
            ids = coder.packed(text, runs)
            count[0] += _n_sequences(len(ids) // 2, length)
            yield name, ids

    def partition() -> int:
        from pyspark import TaskContext

        return TaskContext.get().partitionId()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, coder = [0, 0], encoder(tokenizer, pattern)
        for _, text, runs in texts(batches, count):
            count[0] += _n_sequences(len(coder.encode(text, runs)), length)
        yield pa.RecordBatch.from_pydict({"part": [partition()], "n": [count[0]], "digest": [count[1]]})

    counts = sorted(rows.mapInArrow(counted, "part long, n long, digest long").collect())
    total = sum(r["n"] for r in counts)
    if not total:
        return 0
    starts = np.cumsum([0] + [r["n"] for r in counts[:-1]]).tolist()
    plan = docs.sparkSession.sparkContext.broadcast({r["part"]: (s, r["n"], r["digest"]) for r, s in zip(counts, starts)})

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n, digest = plan.value[partition()]
        count, end = [0, 0], encoder(tokenizer, pattern).end
        documents = tokenised(batches, count)
        while group := list(islice(documents, 256)):
            cut = [sequences(c, end, length) for _, c in group]
            sizes = np.array([len(c) for c in cut])
            body = np.concatenate(cut)
            records = np.zeros((len(body), stride(length)), np.uint8)
            head = np.zeros(len(body), _HEAD)
            head["slot"] = slots(np.arange(first, first + len(body)), total, key)
            head["id"] = np.repeat(np.array([name for name, _ in group], np.int64), sizes)
            head["sequence"] = np.arange(len(body)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            ids = np.array([len(c) // 2 for _, c in group])
            head["n_tokens"] = np.minimum(np.repeat(ids + 1, sizes) - head["sequence"] * length, length)
            records[:, : _HEAD.itemsize] = head.view(np.uint8).reshape(len(body), -1)
            records[:, _HEAD.itemsize : -1] = np.ascontiguousarray(body).view(np.uint8).reshape(len(body), -1)
            first += len(body)
            slot = head["slot"].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot // shard_sequences), pa.array(slot),
                 pa.array([r.tobytes() for r in records[:, :-1]], pa.binary())],  # the writer adds the line feed
                names=["shard", "slot", "record"],
            )
        if tuple(count) != (n, digest):
            raise RuntimeError("the second pass saw another partition than the first; write the input to files first")

    # slots are spread evenly over known shards: their ranges need no sample of the rows
    shards = -(-total // shard_sequences)
    tasks = -(-shards // TASK_SHARDS)
    (
        rows.mapInArrow(placed, "shard long, slot long, record binary")
        .repartitionById(tasks, F.floor(F.col("shard") * tasks / shards).cast("int"))
        .sortWithinPartitions("shard", "slot")
        .select("shard", F.col("record").cast("string").alias("record"))
        .write.partitionBy("shard").option("lineSep", "\n").text(path)
    )
    return total


# ------------------------------------------------------------------ reading
def parse(content: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Heads and ids of the records of a shard's bytes."""
    records = np.frombuffer(content, np.uint8).reshape(-1, stride(length))
    head = np.ascontiguousarray(records[:, : _HEAD.itemsize]).view(_HEAD).reshape(-1)
    return head, np.ascontiguousarray(records[:, _HEAD.itemsize : -1]).view("<u2")


def read_shards(spark: SparkSession, path: str, length: int = SEQUENCE_TOKENS, shard_sequences: int = SHARD_SEQUENCES,
                from_slot: int = 0) -> DataFrame:
    """(slot, shard, position, id, sequence, n_tokens, ids: binary) from slot ``from_slot`` on.

    Shards before it are not opened; a shard is read in its order.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    files = files.filter(F.col("shard") >= from_slot // shard_sequences).select("shard", "content")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                # a shard holds every slot of its range, so the first wanted record's place is known
                skip = max(0, from_slot - shard * shard_sequences)
                head, ids = parse(content.as_buffer()[skip * stride(length):], length)
                at = np.arange(len(head))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(head["slot"][at].astype(np.int64)), pa.array(np.full(len(at), shard, np.int64)),
                     pa.array(at + skip), pa.array(head["id"][at].astype(np.int64), mask=head["id"][at] == NO_ID),
                     pa.array(head["sequence"][at].astype(np.int32)), pa.array(head["n_tokens"][at].astype(np.int32)),
                     pa.array([x.tobytes() for x in ids[at]], pa.binary())],
                    names=["slot", "shard", "position", "id", "sequence", "n_tokens", "ids"],
                )

    schema = T._parse_datatype_string(
        "slot long, shard long, position long, id long, sequence int, n_tokens int, ids binary"
    )
    return files.select(F.col("shard").cast("long").alias("shard"), "content").mapInArrow(records, schema)
