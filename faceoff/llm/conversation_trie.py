"""Conversation prefix trie: one node for each distinct sequence of first turns, with counts over its subtree.

Conversations are rebuilt first: each begins with the first turns of the conversation
whose id is its own rounded down to a hundred, and goes on with its own.  A prefix is named by a 128-bit
digest, the exclusive or of its turns' digests, each mixed with its position.  Distinct prefix
digests are enumerated by an aggregation that also verifies them: all rows of a digest must agree on
the parent's digest, the depth and the last turn, else the job fails.

Counts are taken over subtrees in shards.  A node's weight, the turns that its members have
from it on, bounds the nodes of its subtree.  A subtree of a weight up to
``SHARD_WEIGHT`` is kept together with its parents: a shard puts its digests in slots by a minimal
perfect hash that verifies each lookup against the stored digest, scatters the nodes' counts into
flat arrays by slot and adds children to parents through an array of parent slots, deepest nodes
first.  The nodes above such subtrees are few, unless one conversation is very long; they are added
up by pointer doubling, in rounds as many as the logarithm of their depth.

No conversation, node or first turn is gathered in one task: turns are numbered and prefix digests
are carried on by range sorts with a carry for each partition (the only thing collected: a row a
partition), members are counted by map-side combined aggregates.  The ids of the conversations that end at
one node are hashed in one stream, as SHA-256 needs, from sorted blocks of ids joined beforehand.

Defined results: null roles and texts count as empty; turns without a number come first; turns of
one number are in order of role, then of the MD5 of the text; repeated rows are turns of their own; rows
without a conversation id belong to no conversation and are left out; a conversation may come out
without turns, which makes it a member of the root alone; an empty table gives an empty result, without a root; extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faceoff.llm.common import ship_code, written

SHARD_WEIGHT = 200_000
SHARD_NODES = 200_000
BROADCAST_ROWS = 100_000
BASE_STEP, HEAD_TURNS = 100, 5
ID_BLOCK_BYTES = 64 << 10
SLOT_LEVELS = 64
SLOT_SHARE = 2.0  # places a key, in each level of the perfect hash
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

PLACED = "part int, conv long, place long, fa long, fb long, code long"
PREFIXES = "part int, conv long, depth long, n long, code long, a long, b long, pa long, pb long, fa long, fb long"
COUNTED = ("a long, b long, pa long, pb long, conv_id long, depth long, n_convs long, parent_conv_id long, n_children long, "
           "n_leaves long, saved_tokens long")


def _columns(rows: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [rows.column(rows.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# ------------------------------------------------- places and prefix digests
def _starts(conv: np.ndarray, last: int | None) -> np.ndarray:
    """True where a row's conversation is not that of the row before; ``last`` is the one before the batch."""
    new = np.empty(len(conv), bool)
    new[1:] = conv[1:] != conv[:-1]
    new[0] = last is None or conv[0] != last
    return new


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, last, place = TaskContext.get().partitionId(), None, 0
    for rows in batches:
        conv, fa, fb, code = _columns(rows, "conv", "fa", "fb", "code")
        if not len(conv):
            continue
        at, new = np.arange(len(conv)), _starts(conv, last)
        first = np.maximum.accumulate(np.where(new, at, -1))
        places = np.where(first >= 0, at - first, at + place) + 1
        last, place = int(conv[-1]), int(places[-1])
        yield _batch(PLACED, [np.full(len(conv), part), conv, places, fa, fb, code])


def _tagged(fa: np.ndarray, fb: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    fa, fb, depth = (x.astype(np.int64).view(np.uint64) for x in (fa, fb, depth))
    a = mix(fa + mix(fb ^ (depth * np.uint64(0x9E3779B97F4A7C15))))
    b = mix(fb + mix(fa ^ (depth * np.uint64(0xD1B54A32D192ED03))))
    return a, b


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the prefixes, from the partition's first row of each conversation on."""
    part, last, carry = TaskContext.get().partitionId(), None, [np.uint64(0), np.uint64(0)]
    for rows in batches:
        conv, depth, n, code, fa, fb = _columns(rows, "conv", "depth", "n", "code", "fa", "fb")
        if not len(conv):
            continue
        new = _starts(conv, last)
        first = np.maximum.accumulate(np.where(new, np.arange(len(conv)), -1))
        out = []
        for k, tag in enumerate(_tagged(fa, fb, depth)):
            run = np.bitwise_xor.accumulate(tag)
            before = np.where(first > 0, run[np.maximum(first, 1) - 1], np.uint64(0))
            run = run ^ before ^ np.where(first < 0, carry[k], np.uint64(0))
            carry[k] = run[-1]
            out += [run, run ^ tag]
        last = int(conv[-1])
        (a, pa_), (b, pb_) = out[:2], out[2:]
        yield _batch(PREFIXES, [np.full(len(conv), part), conv, depth, n, code, *(x.view(np.int64) for x in (a, b, pa_, pb_)), fa, fb])


def _carried(rows: DataFrame, at: str, columns: list[str], add) -> DataFrame:
    """``rows`` (sorted by conv and ``at`` over partitions) with what each partition's first
    conversation has in the partitions before: ``c_<column>``, null where nothing is carried."""
    ends = rows.groupBy("part").agg(
        F.min("conv").alias("first"), F.max("conv").alias("last"), F.max_by(F.struct(*columns), F.struct("conv", at)).alias("tail"))
    carry, before = [], None
    for r in sorted(ends.collect(), key=lambda r: r["part"]):  # a row a partition
        tail = tuple(r["tail"])
        if before and before[0] == r["first"]:
            carry.append((r["part"], r["first"], *before[1]))
            if r["first"] == r["last"]:
                tail = tuple(add(x, y) for x, y in zip(before[1], tail))
        before = (r["last"], tail)
    schema = "part int, conv long, " + ", ".join(f"c_{c} long" for c in columns)
    found = rows.sparkSession.createDataFrame(carry, schema)
    return rows.join(F.broadcast(found), ["part", "conv"], "left").drop("part")


def placed(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, place, fa, fb, code): every turn, slim: its place from 1, two digests and its text's length in code points."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    half = lambda k: F.conv(F.substring("digest", k, 16), 16, -10).cast("long")
    turns = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), F.md5(text).alias("text"),
        F.md5(said).alias("digest"), F.length(text).cast("long").alias("code"))
    turns = turns.select("conv", "turn", "role", "text", half(1).alias("fa"), half(17).alias("fb"), "code")
    # the row's number splits runs of equal rows over several ranges
    order = ["conv", F.asc_nulls_first("turn"), "role", "text", F.monotonically_increasing_id()]
    rows = written(turns.orderBy(*order).select("conv", "fa", "fb", "code").mapInArrow(_place, PLACED), "trie-turns")
    rows = _carried(rows, "place", ["place"], lambda x, y: x + y)
    return rows.withColumn("place", F.col("place") + F.coalesce("c_place", F.lit(0))).drop("c_place")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, n) of every conversation, and (conv, depth, n, fa, fb, code) of every turn of the rebuilt ones."""
    heads = turns.filter((F.col("conv") % BASE_STEP == 0) & (F.col("place") <= HEAD_TURNS)).groupBy(F.col("conv").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("place", "fa", "fb", "code"))).alias("head"))  # five at most
    own = turns.groupBy("conv").agg(F.max("place").alias("size")).select(
        "conv", "size", (F.crc32(F.col("conv").cast("string").cast("binary")) % (HEAD_TURNS + 1)).cast("int").alias("h"),
        (F.col("conv") - F.col("conv") % BASE_STEP).alias("base"))
    none = F.array().cast("array<struct<place:bigint,fa:bigint,fb:bigint,code:bigint>>")
    begun = own.join(heads, "base", "left").withColumn("head", F.coalesce(F.slice("head", F.lit(1), F.col("h")), none))
    n = F.size("head") + F.greatest(F.col("size") - F.col("h"), F.lit(0))
    convs = written(begun.select("conv", "h", F.size("head").alias("m"), n.cast("long").alias("n"), "head"), "trie-conversations")
    first = convs.select("conv", "n", F.inline("head")).withColumnRenamed("place", "depth")
    rest = turns.join(convs.drop("head"), "conv").filter("place > h").withColumn("depth", F.col("place") - F.col("h") + F.col("m"))
    names = ["conv", "depth", "n", "code", "fa", "fb"]
    return convs.select("conv", "n"), first.select(*names).unionByName(rest.select(*names))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, n, code, a, b, pa, pb, fa, fb): every prefix of every rebuilt conversation with its parent's digest."""
    rows = written(turns.orderBy("conv", "depth").mapInArrow(_digest, PREFIXES), "trie-prefixes")
    rows = _carried(rows, "depth", ["a", "b"], lambda x, y: x ^ y)
    xor = lambda c, of: F.col(c).bitwiseXOR(F.coalesce(F.col(f"c_{of}"), F.lit(0))).alias(c)
    return rows.select("conv", "depth", "n", "code", xor("a", "a"), xor("b", "b"), xor("pa", "a"), xor("pb", "b"), "fa", "fb")


def nodes_of(found: DataFrame) -> DataFrame:
    """(a, b, pa, pb, conv_id, depth, code, n_convs, weight): the distinct digests, verified."""
    same = F.xxhash64("pa", "pb", "depth", "fa", "fb", "code")
    nodes = found.withColumn("same", same).groupBy("a", "b").agg(
        F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.min("conv").alias("conv_id"), F.min("depth").alias("depth"),
        F.min("code").alias("code"), F.count("*").alias("n_convs"), F.sum(F.col("n") - F.col("depth") + 1).alias("weight"),
        F.min("same").alias("least"), F.max("same").alias("most"))
    verified = F.when(F.col("least") == F.col("most"), F.lit(True)).otherwise(F.raise_error(F.lit("two prefixes share a digest")).cast("boolean"))
    return nodes.filter(verified).drop("least", "most")


# ------------------------------------------------------------------ shards
class NodeTable:
    """A minimal perfect hash of 128-bit digests: level by level, digests alone at their place get the next slots."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels, used, left = [], 0, np.arange(len(a))
        while len(left):
            if len(self.levels) == SLOT_LEVELS:
                raise ValueError("a digest occurs twice in a shard")
            size = int(len(left) * SLOT_SHARE) + 1
            at = self._at(a[left], b[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append((size, alone, np.cumsum(alone) - 1 + used))
            used += int(alone.sum())
            left = left[~alone[at]]
        self.a, self.b = np.zeros(len(a), a.dtype), np.zeros(len(a), a.dtype)
        slots = self._slots(a, b)
        self.a[slots], self.b[slots] = a, b

    @staticmethod
    def _at(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(a ^ mix(b + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64))) % np.uint64(size)).astype(np.int64)

    def _slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        slots, left = np.full(len(a), -1), np.arange(len(a))
        for level, (size, alone, slot) in enumerate(self.levels):
            at = self._at(a[left], b[left], level, size)
            held = alone[at]
            slots[left[held]] = slot[at[held]]
            left = left[~held]
        return slots

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The digests' slots; -1 for those that the table does not hold, told by the stored digest."""
        slots = self._slots(a, b)
        there = slots >= 0
        there[there] = (self.a[slots[there]] == a[there]) & (self.b[slots[there]] == b[there])
        return np.where(there, slots, -1)


def accumulate(a, b, pa_, pb_, conv, depth, n_convs, code) -> tuple:
    """(parent's conv or -1, whether there is a parent, children, leaves, saved) of each node of whole subtrees."""
    table = NodeTable(a, b)
    slot, n = table.slots(a, b), len(a)

    def scattered(values: np.ndarray) -> np.ndarray:
        out = np.empty(n, np.int64)
        out[slot] = values
        return out

    parent, level, owner = scattered(table.slots(pa_, pb_)), scattered(depth), scattered(conv)
    saved, children = scattered((n_convs - 1) * code), np.zeros(n, np.int64)
    np.add.at(children, parent[parent >= 0], 1)
    leaves = (children == 0).astype(np.int64)
    order = np.argsort(-level, kind="stable")
    cuts = np.flatnonzero(np.diff(level[order])) + 1
    for at in np.split(order, cuts):  # from the deepest up
        at = at[parent[at] >= 0]
        np.add.at(leaves, parent[at], leaves[at])
        np.add.at(saved, parent[at], saved[at])
    return np.where(parent >= 0, owner[parent], -1)[slot], (parent >= 0)[slot], children[slot], leaves[slot], saved[slot]


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subtrees come sorted by their top; whole ones are added up, up to about ``SHARD_NODES`` nodes at once."""

    def counted(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks().to_batches()[0]
        a, b, pa_, pb_, conv, depth, n_convs, code = _columns(rows, "a", "b", "pa", "pb", "conv_id", "depth", "n_convs", "code")
        parent, has, children, leaves, saved = accumulate(*(x.view(np.uint64) for x in (a, b, pa_, pb_)), conv, depth, n_convs, code)
        return _batch(COUNTED, [a, b, pa_, pb_, conv, depth, n_convs, pa.array(parent, mask=~has), children, leaves, saved])

    waiting, n = [], 0
    for rows in batches:
        waiting.append(rows)
        n += rows.num_rows
        if n >= SHARD_NODES:
            held = pa.Table.from_batches(waiting)
            ta, tb = (held.column(c).to_numpy() for c in ("ta", "tb"))
            last = int(np.flatnonzero((ta != ta[-1]) | (tb != tb[-1])).max(initial=-1)) + 1  # where the last subtree begins
            if last:
                yield counted(held.slice(0, last))
            waiting, n = held.slice(last).to_batches(), held.num_rows - last
    if n:
        yield counted(pa.Table.from_batches(waiting))


def _small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, to be broadcast where its counted rows are few."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _light(nodes: DataFrame, found: DataFrame, heavy: DataFrame, n_heavy: int, shard_weight: int) -> DataFrame:
    """The nodes of the subtrees that fit in shards, counted."""
    path = found.select("conv", "depth", "a", "b")
    if n_heavy:  # heavy nodes begin a path, so the first light one follows the deepest of them
        deepest = path.join(_small(heavy.select("a", "b"), n_heavy), ["a", "b"]).groupBy("conv").agg(F.max("depth").alias("above"))
        tops = path.join(deepest, "conv", "left").filter(F.col("depth") == F.coalesce("above", F.lit(0)) + 1)
    else:
        tops = path.filter("depth = 1")
    tops = tops.select(F.col("conv").alias("conv_id"), F.col("a").alias("ta"), F.col("b").alias("tb"))
    rows = nodes.filter(F.col("weight") <= shard_weight).join(tops, "conv_id")
    names = ["ta", "tb", "a", "b", "pa", "pb", "conv_id", "depth", "n_convs", "code"]
    return rows.select(*names).repartition("ta", "tb").sortWithinPartitions("ta", "tb").mapInArrow(_shard, COUNTED)


def _heavy(heavy: DataFrame, light: DataFrame, n_heavy: int, deepest: int) -> DataFrame:
    """The nodes above the shards, counted: each adds up what is below it at twice the distance, round by round."""
    sums = light.filter("parent_conv_id is null").groupBy("pa", "pb").agg(
        F.count("*").alias("tops"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
    own = sums.select(F.col("pa").alias("a"), F.col("pb").alias("b"), "tops", "l", "s")
    inner = heavy.groupBy("pa", "pb").agg(F.count("*").alias("inner")).select(F.col("pa").alias("a"), F.col("pb").alias("b"), "inner")
    many = lambda c: F.coalesce(F.col(c), F.lit(0))
    rows = heavy.join(own, ["a", "b"], "left").join(inner.filter("a is not null"), ["a", "b"], "left").withColumn(
        "n_children", many("tops") + many("inner"))
    rows = rows.select(
        "a", "b", "pa", "pb", "conv_id", "depth", "n_convs", "n_children", F.col("pa").alias("ja"), F.col("pb").alias("jb"),
        (many("l") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"),
        (many("s") + (F.col("n_convs") - 1) * F.col("code")).alias("saved_tokens"))
    rows = written(rows, "trie-heavy")
    reach = 1
    while reach <= deepest:
        below = rows.groupBy(F.col("ja").alias("a"), F.col("jb").alias("b")).agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        jumps = rows.select(F.col("a").alias("ja"), F.col("b").alias("jb"), F.col("ja").alias("ka"), F.col("jb").alias("kb"))
        rows = rows.join(below, ["a", "b"], "left").join(_small(jumps, n_heavy), ["ja", "jb"], "left").select(
            "a", "b", "pa", "pb", "conv_id", "depth", "n_convs", "n_children", F.col("ka").alias("ja"), F.col("kb").alias("jb"),
            (F.col("n_leaves") + many("l")).alias("n_leaves"), (F.col("saved_tokens") + many("s")).alias("saved_tokens"))
        rows = written(rows, "trie-heavy")
        reach *= 2
    return rows.drop("ja", "jb")


# ----------------------------------------------------------- ids that end
def _id_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (a, b, conv) to (a, b, first, ids): blocks of one node's ids, comma-joined."""
    for rows in batches:
        a, b, conv = _columns(rows, "a", "b", "conv")
        new = np.empty(len(a), bool)
        new[:1], new[1:] = True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        new[:: ID_BLOCK_BYTES // 20] = True  # an id has at most 20 characters
        first = np.flatnonzero(new)
        ids = [",".join(map(str, x.tolist())) for x in np.split(conv, first[1:])] if len(a) else []
        yield _batch("a long, b long, first long, ids string", [a[first], b[first], conv[first], ids])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by node and first id to one SHA-256 a node."""
    at, sha = None, None
    for rows in batches:
        out = []
        for a, b, ids in zip(*(rows.column(rows.schema.get_field_index(c)).to_pylist() for c in ("a", "b", "ids"))):
            if (a, b) == at:
                sha.update(b"," + ids.encode())
            else:
                if at:
                    out.append((*at, sha.hexdigest()))
                at, sha = (a, b), hashlib.sha256(ids.encode())
        if out:
            yield _batch("a long, b long, sha string", list(zip(*out)))
    if at:
        yield _batch("a long, b long, sha string", [[at[0]], [at[1]], [sha.hexdigest()]])


def ends_hash(ends: DataFrame) -> DataFrame:
    """(a, b, sha): SHA-256 of the ids (a, b, conv) of each node, numerically ascending and comma-joined."""
    blocks = ends.orderBy("a", "b", "conv").mapInArrow(_id_blocks, "a long, b long, first long, ids string")
    return blocks.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(_hashed, "a long, b long, sha string")


def trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
         text_col: str = "text", shard_weight: int = SHARD_WEIGHT) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, prefix): the
    nodes; ``prefix`` is the node's digest in hexadecimal."""
    ship_code(conversations.sparkSession)
    convs, turns = rebuilt(placed(conversations, conv_col, turn_col, role_col, text_col))
    found = prefixes(turns)
    nodes = written(nodes_of(found), "trie-nodes")
    zero, null = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        zero.alias("a"), zero.alias("b"), null.alias("pa"), null.alias("pb"), "conv_id", zero.alias("depth"), zero.alias("code"), "n_convs")
    above = nodes.filter(F.col("weight") > shard_weight)
    n_heavy, deepest = above.agg(F.count("*"), F.max("depth")).first()
    light = written(_light(nodes, found, above, n_heavy, shard_weight), "trie-light")
    heavy = _heavy(above.drop("weight").unionByName(root), light, n_heavy + 1, deepest or 0)
    owners = heavy.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("owner"))
    both = light.unionByName(heavy.withColumn("parent_conv_id", null))
    both = both.join(_small(owners, n_heavy + 1), ["pa", "pb"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "owner"))
    ends = found.filter("depth = n").select("a", "b", "conv").unionByName(
        convs.filter("n = 0").select(zero.alias("a"), zero.alias("b"), "conv"))
    name = F.lower(F.concat(*(F.lpad(F.hex(c), 16, "0") for c in "ab")))
    return both.join(ends_hash(ends), ["a", "b"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"), name.alias("prefix"))
