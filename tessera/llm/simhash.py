"""Operator 3, SimHash near-duplicates found with BK-trees.

Two 64-bit fingerprints that differ in at most 3 bits agree on at least two of
five bit blocks. So each fingerprint goes to ten shards, one for every pair of
blocks; a shard holds the fingerprints that agree on the pair. A task builds
the BK-trees of its shards and looks up their members, following only edges
whose distance is within the radius. Shards over a fixed size are cut into
parts, and a tree over each part meets the members of every other part.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, staged
from .graph import connected_components

RADIUS = 3
SHARD = 4096                     # fingerprints of a tree at most (about)
QUERIES = 1024                   # members looked up at a time
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))      # first bit, width


def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash of the word shingles: a bit is 1 if set in over half of the XXH64 (seed 42) values."""
    import xxhash

    toks = (text or "").encode("utf-8", "surrogatepass").lower().split()     # bytes: lowers A-Z, splits at ASCII space
    if not toks:
        return 0
    joined, n = b" ".join(toks), max(1, len(toks) - words + 1)
    ends = np.cumsum([len(t) + 1 for t in toks])
    starts = [0, *ends[:n - 1].tolist()]
    stops = (ends[min(words, len(toks)) - 1:] - 1).tolist()
    digest, ones, at = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0
    while at < n:                                             # a long text goes block by block
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at:at + 65536], stops[at:at + 65536])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        at += 65536
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


class BKForest:
    """BK-trees of several shards in one set of arrays; children are keyed by their distance to the parent."""

    def __init__(self, fp: np.ndarray, shard: np.ndarray):
        n = len(fp)
        self.fp, self.root = fp, np.zeros(n, np.int64)
        first = np.r_[True, shard[1:] != shard[:-1]]          # shard numbers come sorted
        self.root = np.flatnonzero(first)[np.cumsum(first) - 1]
        item, node = np.flatnonzero(~first), self.root[~first]
        keys, kids = [], []
        while len(item):
            key = node * 65 + np.bitwise_count(fp[item] ^ fp[node]).astype(np.int64)
            order = np.argsort(key, kind="stable")
            item, key = item[order], key[order]
            new = np.r_[True, key[1:] != key[:-1]]            # the first item of each (parent, distance) is the child
            keys.append(key[new])
            kids.append(item[new])
            node = item[new][np.cumsum(new) - 1]
            item, node = item[~new], node[~new]
        key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        order = np.argsort(key)
        self.key, self.kid = key[order], (np.concatenate(kids) if kids else key)[order]

    def within(self, query: np.ndarray, root: np.ndarray, radius: int):
        """(query index, item index) of the items within ``radius`` of each query in the tree at ``root``."""
        q, node, found = np.arange(len(query)), root, []
        while len(q):
            d = np.bitwise_count(query[q] ^ self.fp[node]).astype(np.int64)
            hit = d <= radius
            found.append((q[hit], node[hit]))
            lo = np.searchsorted(self.key, node * 65 + np.maximum(d - radius, 0))
            hi = np.searchsorted(self.key, node * 65 + np.minimum(d + radius, 64), side="right")
            n = hi - lo
            at = np.repeat(hi - np.cumsum(n), n) + np.arange(n.sum())
            q, node = np.repeat(q, n), self.kid[at]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the sets of a[i] and b[i]; ``root`` holds the smallest member of each set and stays flat."""
    while True:
        x, y = root[a], root[b]
        open_ = x != y
        if not open_.any():
            return
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (flat := root[root]).tolist() != root.tolist():
            root[:] = flat


def _links(batches, radius: int):
    """Per batch of shards: each member linked to the smallest member of its set."""
    for b in batches:
        lists = b.column("members")
        fps = lists.flatten().field("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        tree = lists.flatten().field("tree").to_numpy(zero_copy_only=False).astype(bool)
        shard = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
        planted = np.flatnonzero(tree)
        top = np.full(len(lists), -1)                          # each shard's root, as an index into planted
        forest = BKForest(fps[planted], shard[planted])
        top[shard[planted]] = forest.root
        guests = np.zeros(len(lists), bool)
        guests[shard[~tree]] = True
        asks = np.flatnonzero((~tree | ~guests[shard]) & (top[shard] >= 0))    # guests ask, or all members of a plain shard
        root = np.arange(len(fps))
        for at in range(0, len(asks), QUERIES):
            q = asks[at:at + QUERIES]
            i, j = forest.within(fps[q], top[shard[q]], radius)
            _unite(root, q[i], planted[j])
        moved = np.flatnonzero(root != np.arange(len(fps)))
        yield pa.RecordBatch.from_arrays([pa.array(fps[moved].view(np.int64)), pa.array(fps[root[moved]].view(np.int64))],
                                         ["a", "b"])


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links ``a, b`` that connect all distinct fingerprints (column ``fp``) within ``radius`` (at most 3) bits.

    Not all pairs: within a shard each member is linked to one member of its set.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError("two of five blocks agree only up to 3 differing bits")
    block = [F.shiftrightunsigned(F.col("fp"), lo).bitwiseAND(F.lit((1 << n) - 1)) for lo, n in BLOCKS]
    pairs = list(combinations(range(len(BLOCKS)), 2))
    keys = [F.lit(k << 26).bitwiseOR(F.shiftleft(block[i], 13)).bitwiseOR(block[j]) for k, (i, j) in enumerate(pairs)]
    keyed = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = staged(keyed.groupBy("key").count().where("count > 1").select(
        "key", F.ceil(F.col("count") / shard).alias("parts")), "shard-sizes")
    own = F.pmod(F.xxhash64("fp"), F.col("parts"))
    meet = (keyed.join(sizes, "key").withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
            .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                    F.struct("fp", (F.col("own") == F.least("own", "other")).alias("tree")).alias("m")))
    shards = meet.groupBy("key", "i", "j").agg(F.collect_list("m").alias("members")).select("members")
    return shards.mapInArrow(lambda batches: _links(batches, radius), "a long, b long")


def _components(docs: DataFrame, words: int, radius: int) -> DataFrame:
    """``doc_id, key, fp, label, component_id`` of ``docs`` (doc_id, text); ``key`` is a digest of the text."""
    def hash_texts(batches):
        for b in batches:
            fp = np.array([fingerprint(t, words) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(fp)], ["doc_id", "key", "fp"])

    keyed = docs.withColumn("key", _text_key(F.col("text")))
    prints = staged(keyed.mapInArrow(hash_texts, "doc_id long, key binary, fp long"), "fingerprints")
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    labels = connected_components(fingerprint_links(nodes.select("fp"), radius))
    named = (nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("label", F.coalesce("label", "fp")))
    smallest = named.groupBy("label").agg(F.min("least").alias("component_id"))
    return prints.join(named.select("fp", "label").join(smallest, "label"), "fp")


def _text_key(text):
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def simhash_components(docs: DataFrame, words: int = 3, radius: int = RADIUS, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``radius`` differing bits (null if no member has an id). A null or empty
    text has fingerprint zero and is linked like any other. Rows with equal ids
    or texts each keep a row. Copies share a fingerprint, so only distinct
    fingerprints enter the trees.
    """
    return _components(documents(docs, id_col, text_col), words, radius).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 3, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` of which one for each component stays, with their columns as they are.

    It is the row with the smallest doc_id (null last), then the smallest text digest;
    of rows that agree in id and text, one.
    """
    rows = staged(_components(documents(docs), words, radius).select("doc_id", "key", "label"), "members")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "key")).alias("best")
    stays = rows.groupBy("label").agg(best).select(F.col("best.doc_id").alias("__stay_id"), F.col("best.key").alias("__stay_key"))
    here = docs.withColumn("__key", _text_key(F.col("text").cast("string")))
    kept = here.join(stays, here["doc_id"].cast("long").eqNullSafe(F.col("__stay_id")) & (F.col("__key") == F.col("__stay_key")),
                     "left_semi")
    if not rows.groupBy("doc_id", "key").count().where("count > 1").isEmpty():     # the same row more than once
        kept = kept.dropDuplicates(["doc_id", "__key"])
    return kept.drop("__key")
