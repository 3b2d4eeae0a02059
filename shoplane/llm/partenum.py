"""Jaccard join of word-shingle sets by PartEnum signatures (operator 9).

Two sets with Jaccard similarity of 3/4 or more differ in at most a third of the smaller one's size. So:

* sets are put in size bands: band j has sizes from 2**j to 2**(j+1) - 1, and a set that may be the larger
  partner of a smaller band's set is put there as well, so any two similar sets share a band;
* a band divides the domain of shingles into ``n_parts`` parts by a hash. Sets that differ in d shingles
  differ in at most d parts, so similar sets agree in at least (filled parts - d) filled parts;
* the enumerated subsets are the single parts: a signature is a filled part and a hash of the set's
  shingles in it. (Larger subsets would be more signatures, for pairs that the counting below finds
  apart as well.) Similar sets share one, unless too few parts of both are filled; a set with no more
  filled parts than it may differ in also gives each of its shingles as a signature of a reserve band.

Documents with the same set are one class. Candidates:

1. Tasks send packed (signature, class) arrays, dealt by the signature; what more than one class has is
   kept ("live"). A signature that very many classes of one task have sends one of them on, and the others
   by way of overflow shards, so no task gathers a hot signature's classes.
2. A star round verifies each class against one leader of each of its live signatures: the class that has
   most in common with others, which in a group of near copies is the one that was edited least. The
   links' components are joined, so whole groups of near copies become one without pairs.
3. Only pairs across components remain. Signatures of at most ``FEW`` classes give all such pairs. A class
   of which fewer signatures are larger than that than it must share with any similar set needs no
   more. The other ("unsafe") classes are those that consist of very common shingles for the most part and
   did not link to a leader. Those with larger signatures in common are compared with each other in
   blocks: a task counts the shingles that the classes of two blocks share by a matrix product. This
   is exact. Its work grows with the square of such a group, its rows and memory do not.

A pair from signatures goes on if it shares as many as similar sets of its sizes must share, and is then
verified on the words of both texts, so the result has no false links. Texts are only fetched for pairs
that go on and for unsafe classes.

Defined results: a null text counts as empty; a document without words has an empty set, 0 shingles, and
is linked with nothing; rows with null ids take part, and a component's id is its smallest id that is not
null (null if all are); repeated rows get equal results; an empty table gives an empty result; other
columns are kept by ``keep_one`` and not read by ``components_of``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, release_memory, small_batches, stage
from .components import components
from .hashing import END_HASH, joined, mix, shingle_hashes, word_hashes

SHINGLE = 5
FEW = 32                # classes of a signature whose pairs are all looked at
HOT = 512               # classes of a signature within one batch of a task that use overflow
BATCH_DOCS = 16_384     # distinct sets of a batch, at most 2**16
BATCH_SIGNATURES = 1_000_000
JOINED_BYTES = 1 << 20  # of texts that are hashed together
SLICES = 8              # of a shard, sorted one after the other
LOWER = np.uint64((1 << 48) - 1)
RESERVE = 63            # the band of single shingles
STAR_ROUNDS = 1
BROADCAST_ROWS = 1_000_000
BLOCK = 1024            # unsafe classes that a task compares with as many
BLOCK_SHINGLES = 1 << 19    # of a block
COLUMNS = 4096          # shingles that it counts together
TEXTS = 512             # of a block in verification


def shingle_set(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles."""
    return np.unique(shingle_hashes(word_hashes((text or "").encode("utf-8", "surrogatepass").lower()), n))


def shingle_sets(raw: bytes, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The sets of many ``joined`` texts: all of them one after the other, and their sizes."""
    words = word_hashes(raw)
    end = words == END_HASH
    ends = np.flatnonzero(end)
    starts = np.concatenate([[0], ends[:-1] + 1])
    length = ends - starts
    runs = shingle_hashes(words, n)             # also over the ends of texts: these are left out
    count = np.maximum(length - n + 1, 0)
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    flat = runs[at] if len(at) else np.zeros(0, np.uint64)
    short = np.flatnonzero((length > 0) & (length < n))
    if len(short):
        whole = np.array([shingle_hashes(words[starts[d]:ends[d]], n)[0] for d in short], np.uint64)
        flat = np.insert(flat, np.concatenate([[0], np.cumsum(count)])[short], whole)
        count[short] = 1
    edge = np.concatenate([[0], np.cumsum(count)])
    for a, b in zip(edge.tolist(), edge[1:].tolist()):
        flat[a:b].sort()
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[edge[:-1][count > 0]] = True
    size = np.bincount(np.repeat(np.arange(len(count)), count)[new], minlength=len(count))
    return flat[new], size


def _sums(values: np.ndarray, size: np.ndarray, add=np.add) -> np.ndarray:
    """Sum over each set; 0 for an empty one."""
    out = np.zeros(len(size), values.dtype)
    full = size > 0
    if full.any():
        out[full] = add.reduceat(values, np.concatenate([[0], np.cumsum(size)[:-1]])[full])
    return out


def set_keys(flat: np.ndarray, size: np.ndarray) -> np.ndarray:
    """One hash of each whole set, as a signed integer; 0 for the empty set."""
    h = mix(flat * np.uint64(0x9E3779B97F4A7C15) + np.repeat(size, size).astype(np.uint64))
    key = mix(_sums(h, size) ^ _sums(mix(h), size, np.bitwise_xor)).view(np.int64)
    return np.where(size == 0, 0, np.where(key == 0, 1, key))


def own_band(size: np.ndarray) -> np.ndarray:
    """Position of the highest bit."""
    return np.frexp(size.astype(np.float64))[1] - 1


def n_parts(band: np.ndarray) -> np.ndarray:
    """As many parts as the band's smallest size; more where sets are so small that parts often collide."""
    return np.where(band > 5, 1, 4) << band


def in_band_below(size: np.ndarray) -> np.ndarray:
    """Whether a set may be the larger partner of one in the band below its own."""
    return (size > 1) & (3 * size <= 4 * ((1 << own_band(np.maximum(size, 1))) - 1))


def _filled_parts(flat: np.ndarray, size: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every filled part: its set, its number, and a hash of the shingles in it."""
    own, parts = np.repeat(np.arange(len(size)), size), n_parts(band)
    m = mix(flat ^ ((band + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))[own])
    first = np.concatenate([[0], np.cumsum(parts)])
    place = first[own] + ((m >> np.uint64(32)) % parts.astype(np.uint64)[own]).astype(np.int64)
    inside = np.zeros(first[-1], np.uint64)
    np.add.at(inside, place, mix(m))
    used = np.flatnonzero(np.bincount(place, minlength=first[-1]))
    which = np.searchsorted(first, used, "right") - 1
    return which, used - first[which], inside[used]


def filled(flat: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of filled parts of each set in its own band and, where it is in there too, in the one below."""
    out = []
    for below in (False, True):
        n = np.where(in_band_below(size), size, 0) if below else size
        keep = np.repeat(n > 0, size)
        band = np.maximum(own_band(np.maximum(n, 1)) - below, 0)
        which, _, _ = _filled_parts(flat[keep], n, band)
        out.append(np.bincount(which, minlength=len(size)))
    return out[0], out[1]


def signatures(flat: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of the sets, and for each the place of its set; the lowest six bits are the band."""
    sigs, owners, weak = [], [], np.zeros(len(size), bool)
    for below in (False, True):
        n = np.where(in_band_below(size), size, 0) if below else size
        keep = np.repeat(n > 0, size)
        band = np.maximum(own_band(np.maximum(n, 1)) - below, 0)
        which, part, inside = _filled_parts(flat[keep], n, band)
        weak |= (n > 0) & (np.bincount(which, minlength=len(size)) <= size // 3)
        here = band[which].astype(np.uint64)
        sigs.append(_tagged(mix(inside + mix(part.astype(np.uint64) + (here << np.uint64(40)))), here))
        owners.append(which)
    own = np.repeat(np.arange(len(size)), size)
    sigs.append(_tagged(mix(flat[weak[own]]), np.uint64(RESERVE)))
    owners.append(own[weak[own]])
    return np.concatenate(sigs), np.concatenate(owners)


def _tagged(h: np.ndarray, band) -> np.ndarray:
    return (h & ~np.uint64(63)) | band


def sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, text_hash, key, n, and the numbers of filled parts in its bands (f0, f1)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            cols = [[], [], [], []]
            for _, raw in joined(t.as_py() for t in b.column(2)):
                flat, size = shingle_sets(raw)
                for c, x in zip(cols, (set_keys(flat, size), size, *filled(flat, size))):
                    c.append(x.astype(np.int64))
            cols = [np.concatenate([np.zeros(0, np.int64), *c]) for c in cols]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *map(pa.array, cols)], names=["id", "text_hash", "key", "n", "f0", "f1"])
        release_memory()

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(
        run, f"id {id_type}, text_hash bigint, key bigint, n bigint, f0 bigint, f1 bigint")


def _repeated(sig: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The (signature, class) pairs, once each, of signatures that more than one class has."""
    if len(sig) < 2:
        return sig[:0], key[:0]
    order = np.argsort(sig, kind="stable")
    sig, key = sig[order], key[order]
    same = sig[1:] == sig[:-1]
    again = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    sig, key = sig[again], key[again]
    if len(sig):                                # copies of one set in several tasks are one class
        order = np.lexsort((key, sig))
        sig, key = sig[order], key[order]
        new = np.concatenate([[True], (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])])
        sig, key = sig[new], key[new]
        first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        n = np.diff(np.append(first, len(sig)))
        keep = np.repeat(n > 1, n)
        sig, key = sig[keep], key[keep]
    return sig, key


def live_signatures(docs: DataFrame, text_col: str) -> DataFrame:
    """(sig, key) for the signatures of more than one class; rows may repeat."""
    bits = min(max(5, (int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()), 12)
    shards = 1 << bits

    def rows(keys: list[np.ndarray], sigs: list[np.ndarray], owners: list[np.ndarray], turn: int) -> pa.RecordBatch:
        """A batch's blobs: where they go, the shard of their signatures, their classes, for every signature
        the place of its class among these, and the lower six bytes of the signatures."""
        key, sig, own = np.concatenate(keys), np.concatenate(sigs), np.concatenate(owners)
        sig = ((sig >> np.uint64(64 - bits)) << np.uint64(48)) | (sig & LOWER)
        order = np.argsort(sig, kind="stable")
        sig, own, out = sig[order], own[order], []

        def blob(to: int, part: np.ndarray, classes: np.ndarray) -> None:
            used, place = np.unique(classes, return_inverse=True)
            out.append((to, int(part[0] >> np.uint64(48)), key[used].tobytes(), place.astype("<u2").tobytes(),
                        part.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()))
        first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        n = np.diff(np.append(first, len(sig)))
        if (n > HOT).any():
            for at, size in zip(first[n > HOT].tolist(), n[n > HOT].tolist()):
                blob(shards + (turn + at) % shards, sig[at:at + size], own[at:at + size])
            stays = np.repeat(n <= HOT, n)
            stays[first] = True
            sig, own = sig[stays], own[stays]
        edges = np.searchsorted(sig, np.arange(1, shards, dtype=np.uint64) << np.uint64(48))
        for shard, (i, j) in enumerate(zip([0, *edges], [*edges, len(sig)])):
            if j > i:
                blob(shard, sig[i:j], own[i:j])
        return pa.RecordBatch.from_arrays([*(pa.array([r[k] for r in out], pa.int32()) for k in (0, 1)),
                                           *(pa.array([r[k] for r in out], pa.binary()) for k in (2, 3, 4))],
                                          names=["target", "shard", "classes", "place", "sig"])

    def send(batches):
        keys, sigs, owners, docs_, size_, seen, turn = [], [], [], 0, 0, set(), 0
        for b in batches:
            for _, raw in joined((t.as_py() for t in b.column(0)), JOINED_BYTES):
                flat, size = shingle_sets(raw)
                key = set_keys(flat, size)
                fresh_ = np.array([k != 0 and not (k in seen or seen.add(k)) for k in key.tolist()], bool)
                flat, size = flat[np.repeat(fresh_, size)], size[fresh_]
                if not len(size):
                    continue
                sig, own = signatures(flat, size)
                if docs_ and (docs_ + len(size) > BATCH_DOCS or size_ + len(sig) > BATCH_SIGNATURES):
                    yield rows(keys, sigs, owners, turn)
                    keys, sigs, owners, docs_, size_, seen, turn = [], [], [], 0, 0, set(key.tolist()), turn + 1
                keys.append(key[fresh_])
                sigs.append(sig)
                owners.append((own + docs_).astype(np.uint16))
                docs_, size_ = docs_ + len(size), size_ + len(sig)
        if keys:
            yield rows(keys, sigs, owners, turn)
        keys = sigs = owners = seen = flat = size = sig = own = None
        release_memory()

    def unpacked(shard: int, raw: bytes) -> np.ndarray:
        out = np.zeros((len(raw) // 6, 8), np.uint8)
        out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
        return out.view("<u8").ravel() | (np.uint64(shard) << np.uint64(48))

    def gather(_, group):
        release_memory()
        blobs = [(np.frombuffer(k, "<i8"), np.frombuffer(at, "<u2"), unpacked(shard, x))
                 for shard, k, at, x in zip(*(group[c].to_pylist() for c in ("shard", "classes", "place", "sig")))]
        # blobs are sorted, so a slice of a shard's range is a slice of each: only one is sorted at a time
        low, high = min(int(x[0]) for *_, x in blobs), max(int(x[-1]) for *_, x in blobs)
        edges = np.array([low + (high - low) * k // SLICES for k in range(1, SLICES)], np.uint64)
        cuts = [np.concatenate([[0], np.searchsorted(x, edges), [len(x)]]) for _, _, x in blobs]
        found = [_repeated(np.concatenate([x[c[k]:c[k + 1]] for (_, _, x), c in zip(blobs, cuts)]),
                           np.concatenate([key[at[c[k]:c[k + 1]]] for (key, at, _), c in zip(blobs, cuts)])) for k in range(SLICES)]
        return pa.table({"sig": np.concatenate([x for x, _ in found]).view(np.int64), "key": np.concatenate([k for _, k in found])})

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(
        send, "target int, shard int, classes binary, place binary, sig binary").groupBy("target").applyInArrow(gather, "sig bigint, key bigint")


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= 75 * (len(a) + len(b) - common) and common > 0


def _verified(key, pairs, texts):
    """The links among the pairs of two blocks of classes, less those that join what is joined already."""
    sets_ = {k: shingle_set(t) for k, t in zip(texts["key"].to_pylist(), texts["text"].to_pylist())}
    return _spanning((a, b) for a, b in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()) if similar(sets_[a], sets_[b]))


def _band(n: Column) -> Column:
    return F.length(F.bin(n)) - 1


def _links_of_blocks(key, group):
    """The links between the classes of two blocks (or within one), less those that join what is joined already."""
    i, j = key[1].as_py(), key[2].as_py()
    group = group.sort_by("own")
    own, cls, part = (group[c].to_numpy() for c in ("own", "key", "part"))
    sets_ = [shingle_set(t) for t in group["text"].to_pylist()]
    n = np.array([len(x) for x in sets_])
    row = np.repeat(np.arange(len(own)), n)
    _, column, times = np.unique(np.concatenate(sets_), return_inverse=True, return_counts=True)
    column, row = (np.cumsum(times > 1) - 1)[column[often := times[column] > 1]], row[often]      # others are shared by none
    cut = int(np.searchsorted(own, i, "right"))
    rows, cols = (slice(0, cut), slice(0, cut)) if i == j else (slice(0, cut), slice(cut, len(own)))
    shared = np.zeros((rows.stop - rows.start, cols.stop - cols.start), np.float32)
    for low in range(0, int(column.max()) + 1 if len(column) else 0, COLUMNS):
        part_of = (column >= low) & (column < low + COLUMNS)
        has = np.zeros((len(own), COLUMNS), np.float32)
        has[row[part_of], column[part_of] - low] = 1
        shared += has[rows] @ has[cols].T
    x, y = np.nonzero(100 * shared >= 75 * (n[rows, None] + n[None, cols] - shared))
    x, y = x + rows.start, y + cols.start
    keep = (part[x] != part[y]) & ((x < y) | (i != j))
    return _spanning(zip(cls[x[keep]].tolist(), cls[y[keep]].tolist()))


def _spanning(links) -> pa.Table:
    """Links (a, b) that join what the ones before have not joined."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while x in up:
            x = up[x]
        return x
    out = []
    for a, b in links:
        x, y = top(a), top(b)
        if x != y:
            up[max(x, y)] = min(x, y)
            out.append((a, b))
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


class _Join:
    def __init__(self, docs: DataFrame, id_col: str, text_col: str):
        self.spark = docs.sparkSession
        small_batches(self.spark)
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        self.docs = docs.select(F.col(id_col).alias("id"), text.alias("text"))
        self.partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.sets = stage(sets(docs, id_col, text_col), "shingle-sets")
        one = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("text_hash").alias("text_hash"))
        self.classes = stage(self.sets.filter("n > 0").groupBy("key").agg(
            F.min(one).alias("one"), F.max("n").alias("n"), F.max("f0").alias("f0"), F.max("f1").alias("f1"),
            F.count(F.lit(1)).alias("copies")), "shingle-classes")
        band = F.col("sig").bitwiseAND(63).cast("int")
        filled_here = F.when(band == _band(F.col("n")), F.col("f0")).when(band == RESERVE, F.lit(0)).otherwise(F.col("f1"))
        # all steps by signature share one exchange, and so do those by class
        live = live_signatures(docs, text_col).repartition(self.partitions, "sig").distinct()
        live = live.join(live.groupBy("sig").agg(F.count(F.lit(1)).alias("size")), "sig").filter("size > 1")
        common = F.sum("size").over(Window.partitionBy("key"))
        self.live = stage(live.join(self.classes, "key").select(
            "sig", "key", "n", "size", filled_here.alias("f"), band.alias("band"), common.alias("common")), "live-signatures")
        self.links: DataFrame | None = None
        self.parts: DataFrame | None = None     # (key, part): component of the links so far

    def labelled(self) -> DataFrame:
        if self.parts is None:
            return self.live.withColumn("part", F.col("key"))
        return self.live.join(self.parts, "key", "left").withColumn("part", F.coalesce("part", "key"))

    @staticmethod
    def must_share() -> Column:
        """Filled parts that similar sets of these sizes have in common at least."""
        differ = F.floor((F.col("a.n") + F.col("b.n")) / 7)
        return F.when(F.col("a.band") == RESERVE, F.lit(1)).otherwise(F.greatest("a.f", "b.f") - differ)

    @staticmethod
    def smaller_band() -> Column:
        return (F.col("a.band") == RESERVE) | (F.col("a.band") == _band(F.least("a.n", "b.n")))

    def texts_of(self, keys: DataFrame) -> tuple[DataFrame, int]:
        """(key, text) of one row of every class of ``keys`` (each once), and their number."""
        wanted = stage(self.classes.join(keys, "key").select("key", "one.id", "one.text_hash"), "candidate-keys")
        n = wanted.count()
        right = (F.broadcast(wanted) if n <= BROADCAST_ROWS else wanted).alias("w")
        texts = self.docs.alias("d").join(right, F.col("d.id").eqNullSafe(F.col("w.id")) & (F.xxhash64("d.text") == F.col("w.text_hash")))
        return texts.select("key", "text"), n

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Links among the pairs (a, b): those that are needed to join what all of them join.

        Pairs are verified in blocks of classes, so that a text goes once to each block that needs it and
        not once for every pair.
        """
        pairs = stage(pairs.select("a", "b"), "candidates")
        texts, n = self.texts_of(pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct())

        def block(c: str) -> Column:
            return F.pmod(F.xxhash64(c), F.lit(max(1, -(-n // TEXTS))))
        pairs = pairs.withColumn("i", F.least(block("a"), block("b"))).withColumn("j", F.greatest(block("a"), block("b")))
        needed = [pairs.select(F.col("i").alias("of_i"), F.col("j").alias("of_j"), F.col(c).alias("key")) for c in ("a", "b")]
        needed = needed[0].union(needed[1]).distinct().join(texts, "key").select("of_i", "of_j", "key", "text")
        return pairs.groupBy("i", "j").cogroup(needed.groupBy("of_i", "of_j")).applyInArrow(_verified, "a bigint, b bigint")

    def add(self, links: DataFrame) -> bool:
        """Take in links; whether there were any."""
        links = stage(links, "links")
        if links.isEmpty():
            return False
        self.links = links if self.links is None else self.links.unionByName(links)
        self.parts = stage(components(self.links).select(F.col("node").alias("key"), F.col("component").alias("part")), "parts")
        return True

    def star(self, turn: int) -> bool:
        live = self.labelled()
        rank = -F.col("common") if turn == 0 else F.xxhash64(F.lit(turn), F.col("key"))
        order = F.struct(rank.alias("rank"), "key", "n", "f", "part")
        leaders = (live.groupBy("sig").agg(F.min(order).alias("lead"), F.min("part").alias("low"), F.max("part").alias("high"))
                   .filter("low != high").select("sig", "lead.key", "lead.n", "lead.f", "lead.part"))
        pairs = (live.alias("a").join(leaders.alias("b"), F.col("a.sig") == F.col("b.sig")).filter("a.part != b.part")
                 .filter(self.smaller_band())
                 .groupBy(F.col("a.key").alias("a"), F.col("b.key").alias("b"), self.must_share().alias("must"))
                 .count().filter("3 * count >= must"))
        return self.add(self.verified(pairs))

    def across(self) -> bool:
        """Verify all pairs across components that may be similar."""
        live = self.labelled()
        open_ = live.groupBy("sig").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low != high").select("sig")
        rows = live.join(open_, "sig")
        many = F.col("size") > FEW
        here = Window.partitionBy("key", "band")
        rows = stage(rows.withColumn("hot", F.count_if(many).over(here)).withColumn("cold", F.count_if(~many).over(here)), "open-signatures")
        few = rows.filter(~many)
        unsafe = rows.filter(many & ((F.col("band") == RESERVE) | (F.col("f") - F.floor(F.col("n") / 3) - F.col("hot") < 1)))
        found = (few.alias("a").join(few.alias("b"), (F.col("a.sig") == F.col("b.sig")) & (F.col("a.key") < F.col("b.key"))
                                     & (F.col("a.part") != F.col("b.part")))
                 .filter(self.smaller_band())
                 .groupBy(F.col("a.key").alias("a"), F.col("b.key").alias("b"),
                          (self.must_share() - F.least("a.hot", "b.hot")).alias("must")).count().filter("count >= must")
                 .select("a", "b"))
        return self.add(self.verified(found.distinct()).unionByName(self.unsafe_links(unsafe)))

    def unsafe_links(self, unsafe: DataFrame) -> DataFrame:
        """Links among the unsafe classes that have signatures of many classes in common."""
        node = F.xxhash64("key", "band")
        items = stage(unsafe.groupBy("key", "band").agg(F.first("n").alias("n"), F.first("part").alias("part")).withColumn("node", node),
                      "unsafe-classes")
        # Groups of classes that may be similar. Such classes share at least ``share`` of these signatures, so
        # in one order for all, rarest first, they have one in common before the last ``share - 1`` of each.
        share = F.when(F.col("band") == RESERVE, F.lit(1)).otherwise(
            F.greatest(F.lit(1), F.col("f") - F.floor(F.col("n") / 3) - F.col("cold")))
        place = F.row_number().over(Window.partitionBy("key", "band").orderBy("size", "sig"))
        early = unsafe.withColumn("place", place).filter(F.col("place") <= F.col("hot") - share + 1).select("sig", node.alias("b"))
        first = early.groupBy("sig").agg(F.min("b").alias("a"))
        groups = components(early.join(first, "sig").select("a", "b"))
        items = items.join(groups, "node").withColumnRenamed("component", "grp")       # alone in its group: no partner
        sizes = items.groupBy("grp").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES))
                                         .cast("int").alias("blocks"))
        # a class meets the classes of every block once: block pairs (i, j), i <= j, are what a task gets
        own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        items = items.join(sizes, "grp").withColumn("own", own)
        texts, _ = self.texts_of(items.select("key").distinct())
        items = (items.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")))
        return (items.join(texts, "key").select("grp", "i", "j", "own", "key", "part", "text").groupBy("grp", "i", "j")
                .applyInArrow(_links_of_blocks, "a bigint, b bigint"))

    def run(self) -> DataFrame:
        for turn in range(STAR_ROUNDS):
            if not self.star(turn):
                break
        self.across()
        label = F.coalesce("part", "key")
        classes = self.classes.select("key", "one", "copies")
        classes = classes.withColumn("part", F.col("key")) if self.parts is None else \
            classes.join(self.parts, "key", "left").withColumn("part", label)
        least = classes.groupBy("part").agg(F.min("one").alias("least"), F.sum("copies").alias("rows"))
        known = stage(classes.join(least.filter("rows > 1"), "part").select(
            "key", F.col("least.id").alias("component_id"), "copies", F.col("rows").alias("component_size")), "classes-in-components")
        share = max(64, self.sets.count() // (4 * self.partitions))
        often, seldom = known.filter(F.col("copies") > share), known.filter(F.col("copies") <= share)
        rows = self.sets.select("id", "text_hash", "key", "n")
        hot = F.broadcast(often)                # 4 * partitions classes at most
        result = (rows.join(hot, "key").unionByName(
            rows.join(F.broadcast(often.select("key")), "key", "left_anti").join(seldom, "key", "left")))
        return result.select("id", "text_hash", F.col("n").alias("n_shingles"),
                             F.when(F.col("copies").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
                             F.coalesce("component_size", F.lit(1)).alias("component_size"))


def components_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, text_hash, n_shingles, component_id, component_size."""
    return _Join(docs, id_col, text_col).run().withColumnRenamed("id", id_col)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of every component, that with its smallest id (of several such rows, the smallest text hash)."""
    text_hash, gone_id, gone_hash = fresh(docs, "text_hash", "gone_id", "gone_hash")
    found = stage(components_of(docs.select(id_col, text_col), id_col, text_col), "components")
    heads = found.filter(F.col("component_size") > 1).filter(F.col(id_col).eqNullSafe(F.col("component_id")))
    heads = heads.groupBy(id_col).agg(F.min("text_hash").alias("text_hash"))
    gone = (found.filter(F.col("component_size") > 1).alias("f").join(
        heads.alias("h"), F.col(f"f.{id_col}").eqNullSafe(F.col(f"h.{id_col}")) & (F.col("f.text_hash") == F.col("h.text_hash")), "left_anti")
        .select(F.col(f"f.{id_col}").alias(gone_id), F.col("f.text_hash").alias(gone_hash)).distinct())
    gone = stage(gone, "near-copies")
    few = gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = docs.withColumn(text_hash, F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    return rows.join(F.broadcast(gone) if few else gone, F.col(id_col).eqNullSafe(F.col(gone_id))
                     & (F.col(text_hash) == F.col(gone_hash)), "left_anti").select(*docs.columns)
