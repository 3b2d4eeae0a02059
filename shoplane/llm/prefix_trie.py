"""The trie of conversation prefixes, from sorted sequences and range minima over their LCPs (operator 13).

A conversation is a sequence of turns. A turn is a digest of its role and text, 16 bytes, so a sequence is a
byte string (its key) whose order puts all sequences with a common prefix next to each other. Equal
sequences are one class. Keys are sorted, and the LCP of neighbours is how many turns they share.

A prefix of depth d of class i has as members the classes from l to r around i for which all LCPs in between
are d or more. A sparse table of range minima over the LCPs gives both ends: each candidate (i, d) searches
l and r by itself, by halving steps, with no stack and no order among candidates. The candidate with i = l
speaks for the node. What a node has is then a sum or a minimum over its interval:

* members: how many conversations the classes have; smallest member: a second sparse table;
* children: LCPs that equal d, and one more if class l goes on after d turns;
* leaves: classes that are no prefix of the next one;
* saved tokens of the subtree: the sum of (members - 1) * characters over its nodes is the characters from depth
  d on of all members, less those of all nodes, and class i is first in the nodes deeper than its LCP.

At scale: keys are range-partitioned by sampled splitters, each class once, so a group of copies is one row
and a range is never one hot key. A range is a block, sized by turns (``BLOCK_TURNS``), and one task works
on one block. A block knows how much its first and last key share with the neighbouring blocks (one row of
three numbers per block). So only prefixes of its first and last key can have members elsewhere: these give
partial rows, which are additive and are summed per prefix. The conversations that end at a node are sorted
by a second range partition, packed to chunks of ``CHUNK`` ids, and hashed as a stream.

Defined results: turns are ordered by turn (null first, ties by digest), null role or text is empty,
repeated rows are turns of their own; rows without conv_id belong to no conversation; an empty table has no node, not
even the root. A conversation is one row as a text elsewhere: 24 bytes a turn, texts are hashed before.
Digests of 128 bits stand for the turns. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import broadcast_bounded
from .common import stage

BLOCK_TURNS = 400_000
CHUNK = 4096
WIDTH = 16

_EMPTY = sha256(b"").hexdigest()


def digest(role: Column, text: Column) -> Column:
    """32 hexadecimal digits for a turn; null counts as empty."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    return F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * WIDTH)


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<digest, chars>>) in the order of the turns."""
    chars = F.coalesce(F.length(F.col("text").cast("string")), F.lit(0)).cast("bigint")
    turns = (conversations.filter("conv_id IS NOT NULL")
             .select(F.col("conv_id").cast("bigint"), "turn", digest(F.col("role"), F.col("text")).alias("digest"), chars.alias("chars")))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "digest", "chars")))
    return turns.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))


def branched(seqs: DataFrame, every: int = 100, most: int = 5) -> DataFrame:
    """Sequences whose first turns come from another conversation: the rule of the contract.

    Conversation c starts with the first h turns of c - c % every, h = crc32(c) % (most + 1); its own turns
    follow after its first h. A conversation gives its first turns to fewer than ``every`` others.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most + 1)).cast("int")
    heads = seqs.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    joined = (seqs.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % every})
              .join(heads, "base", "left"))
    none = F.slice("turns", 1, 0)
    head = F.when(F.col("h") > 0, F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))).otherwise(none)
    return joined.select("conv_id", F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


# --- inside a block ------------------------------------------------------------------------------------------------


def common_turns(first: np.ndarray, second: np.ndarray, most: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """How many tokens agree from each pair of places on, at most ``most``."""
    out = np.zeros(len(first), np.int64)
    active = np.flatnonzero(most > 0)
    d = 0
    while len(active) > 32:
        active = active[(tokens[first[active] + d] == tokens[second[active] + d]).all(1)]
        d += 1
        out[active] = d
        active = active[most[active] > d]
    for k in active:        # few long ones: the rest at once
        x, y, n = first[k] + d, second[k] + d, most[k] - d
        differ = np.flatnonzero((tokens[x:x + n] != tokens[y:y + n]).any(1))
        out[k] = d + (differ[0] if len(differ) else n)
    return out


class RangeMin:
    """Sparse table: minima over all ranges whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 * (width := 1 << (len(self.levels) - 1)) <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))

    def minimum(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minima of the values from lo to hi, both included."""
        out = self.levels[0][lo].copy()
        power = np.frexp((hi - lo + 1).astype(float))[1] - 1
        for k in np.unique(power):
            at = np.flatnonzero(power == k)
            out[at] = np.minimum(self.levels[k][lo[at]], self.levels[k][hi[at] - (1 << int(k)) + 1])
        return out

    def extent(self, start: np.ndarray, depth: np.ndarray, step: int) -> np.ndarray:
        """How far each start can go while the values passed are ``depth`` or more.

        Values belong to the steps between places: value k lies between places k - 1 and k, value 0 is not used.
        """
        at = start.copy()
        n = len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            width, level = 1 << k, self.levels[k]
            if step > 0:
                ok = np.flatnonzero(at + width <= n - 1)
                ok = ok[level[at[ok] + 1] >= depth[ok]]
                at[ok] += width
            else:
                ok = np.flatnonzero(at - width >= 0)
                ok = ok[level[at[ok] - width + 1] >= depth[ok]]
                at[ok] -= width
        return at


NODES = ("block long, prefix string, parent_prefix string, conv_id long, depth long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")


def _prefixes(key: bytes, depths: np.ndarray) -> dict[int, str]:
    """Digest of each wanted prefix of a key."""
    wanted, out, h = set(depths.tolist()), {}, sha256()
    for d in range(int(depths.max()) + 1 if len(depths) else 0):
        if d:
            h.update(key[(d - 1) * WIDTH:d * WIDTH])
        if d in wanted:
            out[d] = f"{d}:{h.copy().hexdigest()}"
    return out


def block_nodes(rows: pa.Table) -> pa.Table:
    """Nodes of one block: whole ones, and partial ones (with prefix) for prefixes that other blocks have too.

    ``left`` and ``right`` are the turns that the first and the last key share with the blocks before and
    after; -1 where there is none.
    """
    rows = rows.sort_by("key").combine_chunks()
    keys = rows["key"].to_pylist()
    block, left, right = (rows[c][0].as_py() for c in ("block", "left", "right"))
    m = len(keys)
    length = np.array([len(k) // WIDTH for k in keys], np.int64)
    begin = np.cumsum(length) - length
    tokens = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)
    chars = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.array(pa.compute.list_flatten(rows["chars"]), np.int64))])
    convs, first = (np.array(rows[c], np.int64) for c in ("n_convs", "conv_id"))

    lcp = np.zeros(m, np.int64)
    lcp[0] = left
    lcp[1:] = common_turns(begin[:-1], begin[1:], np.minimum(length[:-1], length[1:]), tokens)
    table, smallest = RangeMin(lcp.astype(np.int32)), RangeMin(first)
    # candidates: every prefix of every class; the first member of a node speaks for it
    i = np.repeat(np.arange(m), length + 1)
    depth = np.arange(len(i)) - np.repeat(np.cumsum(length + 1) - length - 1, length + 1)
    speaks = table.extent(i, depth, -1) == i
    l, depth = i[speaks], depth[speaks]  # noqa: E741
    r = table.extent(l, depth, +1)

    def total(values: np.ndarray) -> np.ndarray:
        """Sums of the values over (l, r]."""
        upto = np.cumsum(values)
        return upto[r] - upto[l]

    owner = (l > 0) | (depth > left)
    n_convs = total(convs) + convs[l]
    # LCPs of depth d within (l, r], where none is smaller; keys of (LCP, place) stand in order
    by_value = np.sort(lcp[1:] * m + np.arange(1, m))
    children = np.searchsorted(by_value, depth * m + r, "right") - np.searchsorted(by_value, depth * m + l, "right")
    children += np.where(owner, length[l] > depth, depth == left)
    leaf = np.append(lcp[1:], right) < length
    leaves = total(leaf.astype(np.int64)) + leaf[l]
    ends = chars[begin + length]
    before = chars[begin[l] + np.maximum(depth - 1, 0)] - chars[begin[l]]       # characters above the node's own turn
    text = ends - chars[begin]
    fresh = ends - chars[begin + np.maximum(lcp, 0)]                           # of the nodes in which a class is first
    own = np.where(owner, text[l] - before, fresh[l])
    saved = total(convs * text) + (convs * text)[l] - n_convs * before - total(fresh) - own

    conv = smallest.minimum(l, r)
    up = np.maximum(depth - 1, 0)
    pl, pr = table.extent(l, up, -1), table.extent(l, up, +1)
    is_open = ((l == 0) & (depth <= left)) | ((r == m - 1) & (depth <= right))
    parent_open = (depth > 0) & (((pl == 0) & (up <= left)) | ((pr == m - 1) & (up <= right)))
    parent = smallest.minimum(pl, pr)

    # an open node holds the first or the last key of the block
    names = [_prefixes(keys[0], np.arange(left + 1)), _prefixes(keys[-1], np.arange(right + 1))]

    def named(wanted: np.ndarray, lo: np.ndarray, hi: np.ndarray, d: np.ndarray) -> list:
        out = [None] * len(wanted)
        for k in np.flatnonzero(wanted).tolist():
            out[k] = names[0].get(int(d[k])) if lo[k] == 0 and d[k] <= left else names[1][int(d[k])]
        return out

    closed_parent = (depth > 0) & ~parent_open & ~is_open
    end_text = np.array(rows["ends_sha256"].to_pylist(), object)[l]
    end_text[~owner | (length[l] != depth)] = None
    end_text[~is_open & (length[l] != depth)] = _EMPTY
    return pa.table({
        "block": pa.array(np.full(len(l), block)), "prefix": pa.array(named(is_open, l, r, depth), pa.string()),
        "parent_prefix": pa.array(named(parent_open, pl, pr, up), pa.string()), "conv_id": pa.array(conv), "depth": pa.array(depth),
        "parent_conv_id": pa.array(parent, mask=~closed_parent), "n_convs": pa.array(n_convs), "n_children": pa.array(children.astype(np.int64)),
        "n_leaves": pa.array(leaves), "saved_tokens": pa.array(saved), "ends_sha256": pa.array(end_text, pa.string())})


# --- between blocks ------------------------------------------------------------------------------------------------


def _shared(before: Column, after: Column) -> Column:
    """Turns that two keys share; -1 if there is no such key."""
    @F.udf("long")
    def turns(a, b):
        if a is None or b is None:
            return -1
        n = min(len(a), len(b)) // WIDTH
        x, y = (np.frombuffer(bytes(s), np.uint64)[:2 * n].reshape(-1, 2) for s in (a, b))
        differ = np.flatnonzero((x != y).any(1))
        return int(differ[0]) if len(differ) else n
    return turns(before, after)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (id, conv_id) rows of a partition as (id, part, number, ids): up to CHUNK ids a row."""
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    number, key, ids = 0, None, []

    def chunk() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"id": [key], "part": [part], "number": [number], "ids": [",".join(ids)]}, schema=_CHUNK_ARROW)
    for b in batches:
        out = []
        for k, c in zip(b["id"].to_pylist(), b["conv_id"].to_pylist()):
            if k != key or len(ids) == CHUNK:
                if ids:
                    out.append(chunk())
                    number += 1
                key, ids = k, []
            ids.append(str(c))
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    if ids:
        yield chunk()


_CHUNK_ARROW = pa.schema([("id", pa.string()), ("part", pa.int64()), ("number", pa.int64()), ("ids", pa.string())])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks as (id, ends_sha256); one chunk is held at a time."""
    key, h = None, None
    schema = pa.schema([("id", pa.string()), ("ends_sha256", pa.string())])
    for b in batches:
        ids, ends = [], []
        for k, text in zip(b["id"].to_pylist(), b["ids"]):
            if k != key:
                if key is not None:
                    ids.append(key), ends.append(h.hexdigest())
                key, h = k, sha256()
            else:
                h.update(b",")
            h.update(text.as_buffer())
        yield pa.RecordBatch.from_pydict({"id": ids, "ends_sha256": ends}, schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_pydict({"id": [key], "ends_sha256": [h.hexdigest()]}, schema=schema)


def ends(members: DataFrame) -> DataFrame:
    """(id, ends_sha256) of rows (id, conv_id): hash of each id's numbers, ascending, joined by commas."""
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = (members.select("id", "conv_id").repartitionByRange(n, "id", "conv_id").sortWithinPartitions("id", "conv_id")
              .mapInArrow(_chunks, "id string, part long, number long, ids string"))
    return (chunks.repartition(n, "id").sortWithinPartitions("id", "part", "number")
            .mapInArrow(_hashed, "id string, ends_sha256 string"))


def trie(seqs: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per node of the trie of sequences (conv_id, turns); see ``NODES`` for what it says."""
    hexes = F.array_join(F.transform("turns", lambda t: t["digest"]), "")
    key = F.unhex(hexes)
    rows = stage(seqs.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["chars"]).alias("chars"),
                             F.substring(F.sha2(key, 256), 1, 32).alias("id")), "trie-sequences")
    classes = rows.groupBy("id", "key", "chars").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"))
    classes = classes.join(ends(rows), "id")
    spark = rows.sparkSession
    turns = rows.agg(F.sum(F.size("chars"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // block_turns))
    # a given number of ranges, numbered in their order
    ranged = stage(classes.drop("id").repartitionByRange(parts, "key").withColumn("block", F.spark_partition_id().cast("bigint")), "trie-classes")
    order = Window.orderBy("block")     # one row per block
    edges = (ranged.groupBy("block").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
             .select("block", "lo", "hi", F.lag("hi").over(order).alias("before"), F.lead("lo").over(order).alias("after"))
             .select("block", _shared(F.col("before"), F.col("lo")).alias("left"), _shared(F.col("hi"), F.col("after")).alias("right")))
    local = stage(ranged.join(F.broadcast(edges), "block").groupBy("block").applyInArrow(block_nodes, NODES), "trie-nodes")

    values = "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    whole, part = local.filter("prefix IS NULL"), local.filter("prefix IS NOT NULL")
    merged = stage(part.groupBy("prefix", "depth").agg(
        F.max("parent_prefix").alias("parent_prefix"), F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in values[1:5]],
        F.coalesce(F.max("ends_sha256"), F.lit(_EMPTY)).alias("ends_sha256")), "trie-open")
    above = merged.select(F.col("prefix").alias("parent_prefix"), F.col("conv_id").alias("parent_conv_id"))
    # by block: a prefix that many nodes share is many keys, each with at most a block's rows
    by_block = part.select("block", F.col("prefix").alias("parent_prefix")).join(above, "parent_prefix")
    out = "conv_id", "parent_conv_id", *values
    return (whole.filter("parent_prefix IS NULL").select(*out)
            .unionByName(whole.filter("parent_prefix IS NOT NULL").drop("parent_conv_id")
                         .join(broadcast_bounded(by_block), ["block", "parent_prefix"]).select(*out))
            .unionByName(merged.join(above, "parent_prefix", "left").select(*out)))


_CRC_TABLE = "list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), b))"

ORACLE_SQL = f"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1 AS k, digest, chars
  FROM (SELECT conv_id, turn, substr(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS digest,
               length(coalesce(text, '')) AS chars
        FROM conversations WHERE conv_id IS NOT NULL)
), crc AS (
  SELECT conv_id, xor(list_reduce(list_transform(range(1, 1 + len(conv_id::VARCHAR)), lambda i: ascii((conv_id::VARCHAR)[i])::BIGINT),
                                  lambda a, x: xor(a >> 8, t[1 + (xor(a, x) & 255)]), 4294967295::BIGINT), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM own), (SELECT {_CRC_TABLE} AS t)
), rebuilt AS (
  SELECT c.conv_id, o.k, o.digest, o.chars FROM crc c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 100 AND o.k < c.h
  UNION ALL
  SELECT c.conv_id, o.k, o.digest, o.chars FROM crc c JOIN own o ON o.conv_id = c.conv_id AND o.k >= c.h
), prefixes AS (
  SELECT conv_id, 0 AS depth, '' AS prefix, NULL AS parent, 0 AS chars FROM crc
  UNION ALL
  SELECT conv_id, depth, prefix, coalesce(lag(prefix) OVER (PARTITION BY conv_id ORDER BY depth), ''), chars
  FROM (SELECT conv_id, row_number() OVER w AS depth, string_agg(digest, '') OVER w AS prefix, chars
        FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
), last AS (
  SELECT prefix, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, arg_max(prefix, depth) AS prefix FROM prefixes GROUP BY conv_id) GROUP BY prefix
), node AS (
  SELECT prefix, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved
  FROM prefixes GROUP BY prefix, depth
), child AS (
  SELECT parent AS prefix, count(*) AS n FROM node WHERE parent IS NOT NULL GROUP BY parent
), below AS (
  SELECT a.prefix, sum(n.saved) AS saved, count(*) FILTER (WHERE c.n IS NULL) AS leaves
  FROM node n JOIN prefixes a ON a.conv_id = n.conv_id AND a.depth <= n.depth LEFT JOIN child c ON c.prefix = n.prefix
  GROUP BY a.prefix
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0)::BIGINT AS n_children, b.leaves::BIGINT AS n_leaves,
       b.saved::BIGINT AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM node n JOIN below b ON b.prefix = n.prefix LEFT JOIN node p ON p.prefix = n.parent LEFT JOIN child c ON c.prefix = n.prefix
     LEFT JOIN last e ON e.prefix = n.prefix
"""
