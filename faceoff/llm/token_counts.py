"""Token counts by a two-tier lookup on the map side.

Texts are cut at their spaces: where no white space stands beside a space, the
byte-level pre-tokenizer starts a pre-token with that space, so the counts of the
words (each with the space before it) add up.  Other texts, and those with special
strings, go to the tokenizer library whole.  Tier one is a broadcast table of
the counts of the most frequent words, at most ``TABLE_ENTRIES`` of them; it comes
from all documents, each task keeping a bounded summary and handing on its
``TASK_ENTRIES`` most frequent.  Tier two is a bounded cache in each worker,
filled by the library.  The table only saves time: a word is counted the same way
in either tier.  The stream of words is never shuffled.

Defined results: null counts as the empty text, which has no tokens; very
long words are counted and not cached; rows are counted one by one, so repeats are
alike; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE_ENTRIES = 32_768
TASK_ENTRIES = 2_048
SUMMARY_ENTRIES = 200_000
CACHE_ENTRIES = 1_000_000
LONGEST_CACHED = 64
BATCH = 1024
class Worker:
    """A worker's tokenizer, its special strings and its cache."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.cache: dict[str, int] = {}

    def count_all(self, texts: list[str]) -> list[int]:
        counts: list[int] = []
        for at in range(0, len(texts), BATCH):  # bounds what the library holds at once
            counts += [len(e.ids) for e in self.library.encode_batch(texts[at : at + BATCH], add_special_tokens=False)]
        return counts


_WORKERS: dict[str, Worker] = {}


def worker(path: str) -> Worker:
    """This process's tokenizer of a path, loaded once."""
    if path not in _WORKERS:
        _WORKERS[path] = Worker(path)
    return _WORKERS[path]


def plain(word: str) -> bool:
    """Whether the pre-tokenizer surely cuts before the space in front of this word."""
    return bool(word) and not word[0].isspace() and not word[-1].isspace()


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for rows in batches:
        for text in rows.column(0).to_pylist():
            seen.update((text or "").split(" "))
            if len(seen) > SUMMARY_ENTRIES:
                seen = Counter(dict(seen.most_common(SUMMARY_ENTRIES // 4)))
    top = [(x, n) for x, n in seen.most_common(TASK_ENTRIES) if plain(x) and len(x) <= LONGEST_CACHED]
    yield pa.RecordBatch.from_arrays(
        [pa.array([x for x, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["word", "n"]
    )


def frequent_counts(docs: DataFrame, path: str, text_col: str = "text", entries: int = TABLE_ENTRIES) -> dict[str, int]:
    """Token counts of the most frequent words after a space: at most ``entries`` short strings."""
    summaries = docs.select(text_col).mapInArrow(_summaries, "word string, n long")
    top = summaries.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(entries)
    words = [r["word"] for r in top.collect()]
    return dict(zip(words, worker(path).count_all([" " + w for w in words])))


def count_texts(texts: list[str], table: dict[str, int], own: Worker) -> list[int]:
    """Tokens of each text."""
    out, cache = [0] * len(texts), own.cache
    whole: list[int] = []  # texts for the library alone
    pending: list[tuple[int, list[str]]] = []  # words that neither tier has, per text
    heads: list[tuple[int, str]] = []  # first words: no space before them
    for k, text in enumerate(texts):
        if any(s in text for s in own.special):
            whole.append(k)
            continue
        head, *words = text.split(" ")
        counts = list(map(table.get, words))
        if None in counts:
            missed = [w for w, n in zip(words, counts) if n is None]
            more = list(map(cache.get, missed))
            if None in more:
                unknown = [w for w, n in zip(missed, more) if n is None]
                if not all(map(plain, unknown)):
                    whole.append(k)
                    continue
                pending.append((k, unknown))
            out[k] = sum(filter(None, more))
        if head and words and not plain("x" + head):
            whole.append(k)
            pending = [p for p in pending if p[0] != k]
            continue
        if head:
            heads.append((k, head))
        out[k] += sum(filter(None, counts))
    fresh = list({w for _, words in pending for w in words})
    found = dict(zip(fresh, own.count_all([" " + w for w in fresh])))
    for k, words in pending:
        out[k] += sum(map(found.__getitem__, words))
    if len(cache) + len(found) > CACHE_ENTRIES:
        cache.clear()
    cache.update((w, n) for w, n in found.items() if len(w) <= LONGEST_CACHED)
    for (k, _), n in zip(heads, own.count_all([h for _, h in heads])):
        out[k] += n
    for k, n in zip(whole, own.count_all([texts[k] for k in whole])):
        out[k] = n
    return out


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 table_entries: int = TABLE_ENTRIES) -> DataFrame:
    """(id, n_bytes, n_tokens) of every whole text."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_counts(docs, path, text_col, table_entries))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker(path)
        for rows in batches:
            texts = [t or "" for t in rows.column(1).to_pylist()]
            sizes = np.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], np.int64)
            tokens = np.array(count_texts(texts, table.value, own), np.int64)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(sizes), pa.array(tokens)], names=[id_col, "n_bytes", "n_tokens"]
            )

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return docs.select(id_col, text_col).mapInArrow(count, schema)
