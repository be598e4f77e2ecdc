"""N-gram Jaccard join by signature trees.

A document is the set of hashes of its shingles. Equal sets are one set from
the start. Sets above the least similarity are found in a tree:

* Upper nodes are Spark partitions. First, a set stays in the search only if
  enough of its first shingles (in hash order) are among the first ones of
  another set: linked sets share a known number of them. Then, with shingles
  in order of their frequency among what is left, two linked sets share one
  of their first, rarest ones; sets that do are in one block, and blocks are
  closed under this, so no link leaves one. Both are prefix filters: they
  lose no link, whatever the order.
* Lower nodes are built in a task from one block (or many small ones, or a
  tile of a large one). A node holds the OR of its documents' token bitmaps
  and its range of sizes. The dual traversal starts with (root, root) and
  drops pairs of nodes whose greatest possible overlap is below what their
  least sizes need; pairs of leaves get the documents' own bounds. Survivors
  are checked exactly on the whole sets, unless already connected.

Large blocks are dealt into tiles of bounded size. Each tile meets itself and
the block's centres, which connects most of a family of near copies; only
tiles that hold documents outside the block's main component then meet the
others. So work follows the links still in doubt, and no task holds more than
two tiles; whole sets travel only for documents that the signatures leave in
doubt. The result is exact: nothing is sampled or capped.

Defined cases: a null or empty text, or one of blanks only, has the empty set,
is linked with nothing and is its own component; equal texts are linked; rows
that repeat a doc_id are told apart by their sets; a component without any
non-null doc_id has a null component_id; an empty table gives no rows; extra
columns are ignored. Two sets whose 64-bit ids collide stop the job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, dropped, in_slices, table, text_or_empty, whole_row, written
from strata.llm.graph import components

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: A tile holds about so many sets and shingles at most.
TILE_SETS, TILE_SHINGLES = 256, 1 << 20
CENTRES = 4
#: A tile of signatures holds at most about so many sets and shingles.
PAIR_SETS, PAIR_SHINGLES = 2048, 1 << 23
BITS_PER_SHINGLE = 8
#: So many doc_ids are broadcast at most (tens of MB).
BROADCAST_IDS = 500_000
LEAF, FANOUT = 16, 8

U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a whole UTF-8 text."""
    words = text.translate(LOWER).split()  # splits at the six ASCII blanks
    if not words:
        return np.empty(0, U)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), U, len(words))
    width = min(shingle, len(words))
    out = np.zeros(len(words) - width + 1, U)
    for i in range(width):
        out = mix(out + h[i : len(h) - width + 1 + i] + U(i + 1))
    return np.unique(out if width == shingle else mix(out + U(width)))


def set_id(s: np.ndarray) -> tuple[int, int]:
    return tuple(int(mix(s ^ U(salt)).sum(dtype=U).astype(np.int64)) for salt in (0x5BD1E995, 0x27D4EB2F165667C5))


def prefix_sizes(n: int, num: int, den: int) -> tuple[int, int, int]:
    """Of a set of n shingles, in any order that all sets share: how many of
    its first shingles to look at; how many of these a linked set's first ones
    share at least; and how many to look at so that one is shared.

    Linked sets overlap in num / den of the larger one at least, so each lacks
    at most ``spare`` of its shingles in the other; looking at ``spare`` + c
    first ones on both sides, they share c. The smallest partner's c counts.
    """

    def spare(m: int) -> int:
        return m - -(-m * num // den)

    def share(m: int) -> int:
        return max(1, min(spare(m), m - spare(m)))

    return spare(n) + share(n), share(-(-n * num // den)), spare(n) + 1


def linked(common: int, a: int, b: int, num: int, den: int) -> bool:
    return (num + den) * common >= num * (a + b)


def signature(s: np.ndarray, bits: int) -> np.ndarray:
    """Token bitmap of a set: ``bits`` (a power of two) bits as 64-bit words."""
    words = np.zeros(bits // 64, U)
    at = s & U(bits - 1)
    np.bitwise_or.at(words, (at >> U(6)).astype(np.int64), U(1) << (at & U(63)))
    return words


def signature_bits(members: int) -> int:
    return 1 << int(np.clip(np.ceil(np.log2(BITS_PER_SHINGLE * max(1, members))), 8, 18))


class Tree:
    """Bulk-loaded signature tree; similar sets (by ``near``) are neighbours.

    ``bits`` are signatures of the sets' differences from one common set (the
    empty one, or a block's centre), ``apart`` the numbers of differences and
    ``size`` the sets' sizes. Two sets are linked if they differ in at most
    (size + size) * (den - num) / (den + num) shingles, that is, if they share
    enough of their differences.
    """

    def __init__(self, bits: np.ndarray, apart: np.ndarray, size: np.ndarray, near: np.ndarray):
        self.order = np.lexsort((size, near))
        self.bits, self.apart, self.size = bits[self.order], apart[self.order], size[self.order]
        self.held = np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        # a level: OR; least and greatest size; least and greatest number of
        # differences; greatest number of differences beyond the set bits
        level, width = (self.bits, self.size, self.size, self.apart, self.apart, self.apart - self.held), LEAF
        folds = (np.bitwise_or, np.minimum, np.maximum, np.minimum, np.maximum, np.maximum)
        self.levels = []
        while True:
            cuts = np.arange(0, len(level[0]), width)
            level = tuple(f.reduceat(x, cuts) for f, x in zip(folds, level))
            self.levels.append(level)
            width = FANOUT
            if len(cuts) == 1:
                return

    def hopeless(self, level: int, i: int, j: int, num: int, den: int) -> bool:
        """No pair below nodes i and j can be linked."""
        bits, least, most, few, many, beyond = self.levels[level]
        if num * least[i] > den * most[j] or num * least[j] > den * most[i]:
            return True
        shared = int(np.bitwise_count(bits[i] & bits[j]).sum())
        overlap = min(many[i], many[j], shared + beyond[i], shared + beyond[j])
        return (few[i] + few[j] - 2 * overlap) * (den + num) > (most[i] + most[j]) * (den - num)

    def pairs(self, num: int, den: int) -> Iterator[tuple[int, int]]:
        """Dual traversal: the pairs (places in ``order``) whose bound allows a link."""
        stack = [(len(self.levels) - 1, 0, 0)]
        while stack:
            level, i, j = stack.pop()
            if i != j and self.hopeless(level, i, j, num, den):
                continue
            if level:
                below = len(self.levels[level - 1][0])
                for a in range(i * FANOUT, min((i + 1) * FANOUT, below)):
                    stack += [(level - 1, a, b) for b in range(a if i == j else j * FANOUT, min((j + 1) * FANOUT, below))]
                continue
            left, right = slice(i * LEAF, (i + 1) * LEAF), slice(j * LEAF, (j + 1) * LEAF)
            shared = np.bitwise_count(self.bits[left, None] & self.bits[None, right]).sum(axis=2, dtype=np.int32)
            # a bit of one set alone is a difference of it that the other lacks
            beyond = np.minimum((self.apart - self.held)[left, None], (self.apart - self.held)[None, right])
            differ = self.apart[left, None] + self.apart[None, right] - 2 * (shared + beyond)
            a, b = self.size[left, None], self.size[None, right]
            able = (differ * (den + num) <= (a + b) * (den - num)) & (num * np.maximum(a, b) <= den * np.minimum(a, b))
            for x, y in np.argwhere(np.triu(able, 1) if i == j else able).tolist():
                yield x + left.start, y + right.start


def tree_links(sets: list[np.ndarray], roots: list[int], num: int, den: int) -> list[tuple[int, int]]:
    """Links between ``sets`` that connect what ``roots`` (labels) do not yet."""
    if len(sets) < 2:
        return []
    size = np.array([len(s) for s in sets], np.int64)
    bits = signature_bits(int(size.max()))
    tree = Tree(np.stack([signature(s, bits) for s in sets]), size, size, np.array([s[0] for s in sets], U))
    parent = {r: r for r in roots}

    def root(r: int) -> int:
        while parent[r] != r:
            parent[r] = parent[parent[r]]
            r = parent[r]
        return r

    out = []
    for x, y in tree.pairs(num, den):
        x, y = int(tree.order[x]), int(tree.order[y])
        rx, ry = root(roots[x]), root(roots[y])
        if rx == ry:
            continue
        s, t = sets[x], sets[y]
        common = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
        if linked(common, len(s), len(t), num, den):
            parent[max(rx, ry)] = min(rx, ry)
            out.append((x, y))
    return out


def in_doubt(tree: Tree, roots: np.ndarray, num: int, den: int) -> np.ndarray:
    """Rows that may be linked with a row of another component, by their signatures."""
    marked = np.zeros(len(roots), bool)
    for x, y in tree.pairs(num, den):
        x, y = tree.order[x], tree.order[y]
        if roots[x] != roots[y]:
            marked[x] = marked[y] = True
    return np.flatnonzero(marked)


def _sets_of(docs: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """doc_id, text_key, n_shingles, sid, check, prefix, enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            sets = [shingle_set(t.as_py(), shingle) for t in batch.column(1)]
            ids = [set_id(s) for s in sets]
            looks = [prefix_sizes(len(s), num, den) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([i for i, _ in ids], pa.int64()),
                    pa.array([c for _, c in ids], pa.int64()),
                    pa.array([s[:look].astype(np.int64) for s, (look, _, _) in zip(sets, looks)], pa.list_(pa.int64())),
                    pa.array([enough for _, enough, _ in looks], pa.int64()),
                ],
                names=["doc_id", "text_key", "n_shingles", "sid", "check", "prefix", "enough"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"), text_key())
    return rows.mapInArrow(run, "doc_id long, text_key long, n_shingles long, sid long, check long, prefix array<long>, enough long")


def _whole_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """sid, shingles of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            sets = [shingle_set(t.as_py(), shingle) for t in batch.column(0)]
            sids = pa.array([set_id(s)[0] for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([sids, pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64()))], names=["sid", "shingles"])

    return docs.select(text_or_empty().cast("binary").alias("text")).mapInArrow(run, "sid long, shingles array<long>")


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    out = []
    for chunk in column.chunks:
        ends, flat = chunk.offsets.to_numpy(), chunk.values.to_numpy().view(U)
        out += [flat[i:j] for i, j in zip(ends[:-1], ends[1:])]
    return out


def _tree_links(rows: DataFrame, num: int, den: int, *keys: str) -> DataFrame:
    """a, b: links found by one tree for each group of rows (sid, root, shingles)."""

    def run(t: pa.Table) -> pa.Table:
        sids = t.column("sid").to_numpy()
        found = tree_links(_arrays(t.column("shingles")), t.column("root").to_pylist(), num, den)
        return pa.table({"a": sids[[i for i, _ in found]].astype(np.int64), "b": sids[[j for _, j in found]].astype(np.int64)})

    return rows.groupBy(*keys).applyInArrow(run, "a long, b long")


def _signatures(whole: DataFrame) -> DataFrame:
    """sid, n, apart, near, bits of rows (sid, expected, shingles, centre): the
    signature of what a set and its block's centre do not share; ``expected``
    (one for a block) sets the width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            sets, centres = (_arrays(pa.chunked_array([batch.column(i)])) for i in (2, 3))
            apart = [np.setxor1d(s, c, assume_unique=True) for s, c in zip(sets, centres)]
            words = [signature(x, signature_bits(m)).tobytes() for x, m in zip(apart, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([len(x) for x in apart], pa.int64()),
                    pa.array([(x[0] if len(x) else U(0)).astype(np.int64) for x in apart], pa.int64()),
                    pa.array(words, pa.binary()),
                ],
                names=["sid", "n", "apart", "near", "bits"],
            )

    return whole.select("sid", "expected", "shingles", "centre").mapInArrow(run, "sid long, n long, apart long, near long, bits binary")


def _doubts(rows: DataFrame, num: int, den: int, *keys: str) -> DataFrame:
    """keys, sid, root of the rows in doubt; one tree of signatures per group."""

    def run(t: pa.Table) -> pa.Table:
        roots = t.column("root").to_numpy()
        bits = np.stack([np.frombuffer(b, U) for b in t.column("bits").to_pylist()])
        tree = Tree(bits, t.column("apart").to_numpy(), t.column("n").to_numpy(), t.column("near").to_numpy().view(U))
        return t.select([*keys, "sid", "root"]).take(pa.array(in_doubt(tree, roots, num, den)))

    return rows.groupBy(*keys).applyInArrow(run, ", ".join(f"{k} long" for k in (*keys, "sid", "root")))


def _deal(key: str, parts: str) -> Column:
    return F.pmod(F.xxhash64(F.lit("tile"), key), F.col(parts)).cast("long")


def _tiles(count: str, shingles: str) -> Column:
    return F.ceil(F.greatest(F.col(count) / TILE_SETS, F.col(shingles) / TILE_SHINGLES)).cast("long")


def _pair_tiles(count: Column, shingles: Column) -> Column:
    """Up to eight tiles for balance, and more where a tile would be too large."""
    large = F.greatest(count / PAIR_SETS, shingles / PAIR_SHINGLES)
    return F.ceil(F.greatest(large, F.least(F.lit(8), count / 64))).cast("long")


def joined_blocks(spark: SparkSession, members: DataFrame, near: DataFrame) -> DataFrame:
    """sid, block: sets connected by shared bands. ``near``, one link for each
    set, joins nearly all; of ``members``, one row for each shared band, only
    those that lead out of the first blocks are left for a second round."""
    first = components(spark, near)
    nodes = near.select(F.col("a").alias("sid")).unionByName(members.select(F.col("centre").alias("sid"))).distinct()
    nodes = nodes.join(first.withColumnRenamed("node", "sid"), "sid", "left").select("sid", F.coalesce("root", "sid").alias("root"))
    nodes = written(spark, nodes, "block-first")
    there = nodes.select(F.col("sid").alias("centre"), F.col("root").alias("b"))
    across = members.join(nodes.withColumnRenamed("root", "a"), "sid").join(there, "centre").filter("a <> b").select("a", "b").distinct()
    second = components(spark, across).select(F.col("node").alias("root"), F.col("root").alias("block"))
    return written(spark, nodes.join(second, "root", "left").select("sid", F.coalesce("block", "root").alias("block")), "blocks")


def survivors(spark: SparkSession, sets: DataFrame) -> DataFrame:
    """sid, one (a doc_id), n of the sets that may have a linked one."""
    first = sets.select("sid", F.explode("prefix").alias("key"))
    shared = first.groupBy("key").agg(F.min("sid").alias("low"), F.max("sid").alias("high")).filter("low <> high").select("key")
    shared = written(spark, shared, "prefix-shared")
    hits = first.join(shared, "key", "left_semi").groupBy("sid").agg(F.count(F.lit(1)).alias("hits"))
    per = sets.groupBy("sid").agg(F.min("doc_id").alias("one"), F.max("n_shingles").alias("n"), F.max("enough").alias("enough"), F.count(F.lit(1)).alias("copies"))
    # every copy of a set counts its hits once
    kept = written(spark, per.join(hits, "sid").filter(F.col("hits") >= F.col("enough") * F.col("copies")).select("sid", "one", "n"), "prefix-survivors")
    dropped(spark, shared)
    return kept


def rare_first(spark: SparkSession, whole: DataFrame, num: int, den: int) -> DataFrame:
    """sid, centre: one row for each first shingle that another set has among
    its first ones, rarest first; centre is the least such set."""
    rows = whole.select("sid", "n", F.explode("shingles").alias("key"))
    often = rows.groupBy("key").agg(F.count(F.lit(1)).alias("often"), F.min("sid").alias("low"), F.max("sid").alias("high")).filter("low <> high").select("key", "often")
    often = written(spark, often, "shingle-counts")
    # shingles of one set alone come first; they are not shared, only counted
    own = Window.partitionBy("sid")
    shared = rows.join(often, "key").withColumn("alone", F.col("n") - F.count(F.lit(1)).over(own))
    rank = F.row_number().over(own.orderBy("often", "key"))
    look = F.col("n") - F.ceil(F.col("n") * num / den) + 1
    first = shared.withColumn("rank", rank).filter(F.col("rank") + F.col("alone") <= look).select("sid", "key")
    first = written(spark, first, "rare-shingles")
    dropped(spark, often)
    centres = first.groupBy("key").agg(F.min("sid").alias("centre"), F.max("sid").alias("other")).filter("centre <> other").select("key", "centre")
    members = written(spark, first.join(centres, "key").filter("sid <> centre").select("sid", "centre"), "block-links")
    dropped(spark, first)
    return members


def class_links(spark: SparkSession, docs: DataFrame, sets: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """a, b: links between different sets that connect all linked ones.
    ``sets``: a table of ``written`` (doc_id, n_shingles, sid, prefix, enough);
    it goes when it is used."""
    # 1. sets that may have a partner, whole, one document each
    one = survivors(spark, sets.filter("n_shingles > 0"))
    dropped(spark, sets)
    few = one.count() <= BROADCAST_IDS  # a checked size; beyond it texts and sets are shuffled

    def sent(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if few else ids

    ids = sent(one.select("one").distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, F.col("doc_id").eqNullSafe(F.col("one")), "left_semi")
    whole = written(spark, _whole_sets(texts, shingle).join(one.select("sid", "n"), "sid").dropDuplicates(["sid"]), "whole-sets")
    # 2. blocks: sets that share one of their rarest shingles
    members = rare_first(spark, whole, num, den)
    near = written(spark, members.groupBy(F.col("sid").alias("a")).agg(F.min("centre").alias("b")), "block-near")
    blocks = joined_blocks(spark, members, near)
    dropped(spark, members)
    one = written(spark, one.join(blocks, "sid"), "block-members")
    sizes = one.groupBy("block").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles_")).withColumn("tiles", _tiles("members", "shingles_"))
    sizes = written(spark, sizes.select("block", "tiles", "members", "shingles_"), "block-sizes")
    # 3. small blocks together, tiles of large ones with their block's centres
    small = sizes.filter("tiles = 1").agg(F.sum("members").alias("members"), F.sum("shingles_").alias("shingles_"))
    parts = small.select(F.coalesce(_tiles("members", "shingles_"), F.lit(1))).first()[0]  # one number
    own = whole.join(sent(one.join(sizes, "block").select("sid", "block", "tiles")), "sid").withColumn("root", F.col("sid"))
    together = own.filter("tiles = 1").withColumn("tile", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("long")).select(F.lit(0).cast("long").alias("group"), "tile", "sid", "root", "shingles")
    large = own.filter("tiles > 1")
    degree = near.groupBy(F.col("b").alias("sid")).agg(F.count(F.lit(1)).alias("degree")).join(blocks, "sid")
    best = F.row_number().over(Window.partitionBy("block").orderBy(F.desc("degree"), "sid"))
    centres = degree.join(sizes.filter("tiles > 1").select("block"), "block").withColumn("best", best).filter(F.col("best") <= CENTRES)
    centres = written(spark, centres.select("block", "sid", "best"), "block-centres")
    guests = large.join(centres.select("sid"), "sid", "left_semi").withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))).filter(F.col("tile") != _deal("sid", "tiles"))
    alone = large.withColumn("tile", _deal("sid", "tiles")).unionByName(guests).select(F.col("block").alias("group"), "tile", "sid", "root", "shingles")
    first = written(spark, _tree_links(together.unionByName(alone), num, den, "group", "tile"), "tree-links")
    # 4. large blocks that are not one component: tiles in doubt meet all others,
    # by signatures first, and only rows still in doubt with their whole sets
    if not sizes.filter("tiles > 1").limit(1).count():
        return first
    roots = components(spark, first).withColumnRenamed("node", "sid")
    labelled = one.join(sizes.filter("tiles > 1").select("block"), "block").join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    labelled = written(spark, labelled.select("sid", "block", "root", "n"), "block-labels")
    per = labelled.groupBy("block", "root").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles_"))
    main = per.groupBy("block").agg(F.max_by("root", F.struct("members", "root")).alias("main"), F.count(F.lit(1)).alias("components"), (F.sum("shingles_") / F.sum("members")).alias("mean"))
    main = main.filter("components > 1")
    sides = per.join(main, "block").withColumn("doubt", F.col("root") != F.col("main")).groupBy("block", "main", "mean", "doubt")
    sides = sides.agg(_pair_tiles(F.sum("members"), F.sum("shingles_")).alias("tiles"))
    sides = sides.groupBy("block", "main", "mean").agg(F.max(F.when(F.col("doubt"), F.col("tiles"))).alias("doubts"), F.max(F.when(~F.col("doubt"), F.col("tiles"))).alias("sures"))
    sides = written(spark, sides, "block-sides")
    dealt = labelled.drop("n").join(sides, "block").withColumn("doubt", F.col("root") != F.col("main"))
    heart = centres.filter("best = 1").select("sid", "block").join(whole.select("sid", F.col("shingles").alias("centre")), "sid").drop("sid")
    expected = F.ceil(6 * F.col("mean") * (den - num) / (den + num)).cast("long")  # three times what linked sets differ in
    signed = dealt.select("sid", "block", expected.alias("expected")).join(whole.select("sid", "shingles"), "sid").join(heart, "block")
    signed = written(spark, _signatures(signed), "block-signatures")
    tile = F.when(F.col("doubt"), _deal("sid", "doubts")).otherwise(F.col("doubts") + _deal("sid", "sures"))
    # a tile in doubt meets every tile (another one in doubt once), a sure one those in doubt
    last = F.when(F.col("doubt"), F.col("doubts") + F.col("sures")).otherwise(F.col("doubts")) - 1
    dealt = dealt.withColumn("mine", tile).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    dealt = dealt.select("sid", "root", F.col("block").alias("group"), F.least("mine", "other").alias("one"), F.greatest("mine", "other").alias("two"))
    doubts = written(spark, _doubts(dealt.join(signed, "sid"), num, den, "group", "one", "two"), "tree-doubts")
    second = _tree_links(doubts.join(whole.select("sid", "shingles"), "sid"), num, den, "group", "one", "two")
    return first.unionByName(written(spark, second, "tree-links"))


def join(spark: SparkSession, docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, text_key, n_shingles, root, component_id of every row (root: the
    component's key; null for empty sets); documents link when
    den * |intersection| >= num * |union| of their shingle sets."""
    sets = written(spark, _sets_of(docs.select("doc_id", "text"), shingle, num, den), "jaccard-sets")
    rows = written(spark, sets.select("doc_id", "text_key", "n_shingles", "sid", "check"), "jaccard-rows")
    ids = rows.filter("n_shingles > 0").groupBy("sid").agg(F.min("doc_id").alias("first"), F.min("check").alias("low"), F.max("check").alias("high"))
    ids = ids.select("sid", F.when(F.col("low") == F.col("high"), F.col("first")).otherwise(F.raise_error(F.lit("two shingle sets share an id")).cast("long")).alias("first"))
    ids = written(spark, ids, "jaccard-ids")
    links = class_links(spark, docs, sets, shingle, num, den)
    roots = components(spark, links).withColumnRenamed("node", "sid")
    named = ids.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = written(spark, named.join(least, "root").select("sid", "root", "component_id"), "jaccard-components")
    return (
        rows.drop("check")
        .join(named, "sid", "left")
        .select("doc_id", "text_key", "n_shingles", "root", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    )


def text_key() -> Column:
    """Tells the texts of one doc_id apart."""
    return F.xxhash64(text_or_empty()).alias("text_key")


def one_of_each(spark: SparkSession, docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each component: that of the least doc_id.
    Rows without words stay."""
    found = join(spark, docs, shingle, num, den).filter(F.col("root").isNotNull())
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    kept = found.groupBy("root").agg(first.alias("k")).select(F.col("k.doc_id").alias("doc_id_"), F.col("k.text_key").alias("text_key_"))
    keyed = docs.select(whole_row(docs), F.col("doc_id").cast("long").alias("doc_id"), text_key())
    same = F.col("doc_id").eqNullSafe(F.col("doc_id_")) & (F.col("text_key") == F.col("text_key_"))
    stay = keyed.join(written(spark, kept, "jaccard-kept"), same, "left_semi").groupBy("doc_id", "text_key").agg(F.min("row").alias("row"))
    empty = docs.filter(~text_or_empty().rlike(WORD))
    return stay.select("row.*").unionByName(empty)


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents alike in three-word shingles."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return join(spark, docs, shingle=3, num=90, den=100).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r AS (SELECT doc_id, doc_id AS r FROM s UNION SELECT p.a, r.r FROM p JOIN r ON p.b = r.doc_id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.r) AS component_id FROM s JOIN r USING (doc_id) GROUP BY s.doc_id, s.s
"""
