"""Sharding by best-fit-decreasing bin packing.

Indivisible groups (equal texts stay together), sorted by size, enter the
open bin with the least remaining capacity that still takes them; a new bin
opens where none does. Bins are looked up in a balanced (AVL) tree keyed by
remaining capacity.

Groups of one size are interchangeable, so the packing runs over the
histogram of group sizes: a run of equal groups fills the tightest bin as
far as it goes, then the next. The histogram is all that reaches the driver:
different sizes that sum to the corpus's T bytes number at most sqrt(2T),
14 million for 100 TB. The result is the same as packing group by group.
Groups find their run by their place within their size, numbered by hash
salts, so no task holds all groups of a size or all rows of a shard.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odpanel.llm.common import ordinals, salts_for, stored

SHARDS = 8


class _Node:
    __slots__ = ("key", "left", "right", "height")

    def __init__(self, key):
        self.key, self.left, self.right, self.height = key, None, None, 1


class BinTree:
    """An AVL tree of (remaining capacity, bin) pairs."""

    def __init__(self):
        self.root = None

    def add(self, key: tuple[int, int]) -> None:
        self.root = self._add(self.root, key)

    def remove(self, key: tuple[int, int]) -> None:
        self.root = self._remove(self.root, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The least pair whose remaining capacity is ``size`` or more."""
        node, best = self.root, None
        while node:
            if node.key[0] >= size:
                node, best = node.left, node.key
            else:
                node = node.right
        return best

    def _add(self, node, key):
        if node is None:
            return _Node(key)
        if key < node.key:
            node.left = self._add(node.left, key)
        else:
            node.right = self._add(node.right, key)
        return self._level(node)

    def _remove(self, node, key):
        if node is None:
            raise KeyError(key)
        if key < node.key:
            node.left = self._remove(node.left, key)
        elif key > node.key:
            node.right = self._remove(node.right, key)
        elif node.left is None or node.right is None:
            return node.left or node.right
        else:
            least = node.right
            while least.left:
                least = least.left
            node.key = least.key
            node.right = self._remove(node.right, least.key)
        return self._level(node)

    def _level(self, node):
        def height(x):
            return x.height if x else 0

        def grow(x):
            x.height = 1 + max(height(x.left), height(x.right))
            return x

        def turn_right(x):
            top = x.left
            x.left, top.right = top.right, x
            grow(x)
            return grow(top)

        def turn_left(x):
            top = x.right
            x.right, top.left = top.left, x
            grow(x)
            return grow(top)

        grow(node)
        lean = height(node.left) - height(node.right)
        if lean > 1:
            if height(node.left.left) < height(node.left.right):
                node.left = turn_left(node.left)
            return turn_right(node)
        if lean < -1:
            if height(node.right.right) < height(node.right.left):
                node.right = turn_right(node.right)
            return turn_left(node)
        return node


def pack(sizes: list[tuple[int, int]], capacity: int, most: int | None = None
         ) -> list[tuple[int, int, int, int]] | None:
    """Best-fit-decreasing over a histogram of (size, number of groups).

    Returns runs (size, first, last, bin): the groups numbered first..last of
    a size go to bin. A group larger than the capacity gets a bin of its own.
    None if more than ``most`` bins are needed."""
    tree, runs, bins = BinTree(), [], 0
    for size, number in sorted(sizes, reverse=True):
        at = 0
        while at < number:
            got = tree.tightest(size)
            if got is None:
                if most is not None and bins == most:
                    return None
                got = (max(capacity, size), bins)
                bins += 1
            else:
                tree.remove(got)
            take = number - at if size == 0 else min(number - at, got[0] // size)
            runs.append((size, at, at + take - 1, got[1]))
            at += take
            tree.add((got[0] - take * size, got[1]))
    return runs


def pack_level(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Runs for exactly ``shards`` bins as level as best fit gets them.

    A group at least as large as the mean of what remains gets a bin of its
    own. The rest is packed at the least capacity, tried from its mean per
    bin upwards, that needs no more bins than remain; at twice the mean plus
    the largest group any-fit always does."""
    rest = dict(sizes)
    heap = [-s for s in rest]
    heapq.heapify(heap)
    total, left, runs, used = sum(s * n for s, n in rest.items()), shards, [], {}
    while heap and left > 1 and -heap[0] * left >= total and -heap[0] > 0:
        s = -heap[0]
        k = used.get(s, 0)
        runs.append((s, k, k, shards - left))
        used[s] = k + 1
        total, left = total - s, left - 1
        if used[s] == rest[s]:
            heapq.heappop(heap)
    own = shards - left
    todo = [(s, n - used.get(s, 0)) for s, n in rest.items() if n > used.get(s, 0)]
    if not todo:
        return runs
    low = max(-(-total // left), max(s for s, _ in todo))
    high = 2 * low + max(s for s, _ in todo)
    best = pack(todo, high, left)
    # the least sufficient capacity to within a millionth
    while high - low > max(1, low >> 20):
        mid = (low + high) // 2
        got = pack(todo, mid, left)
        if got is None:
            low = mid
        else:
            high, best = mid, got
    got = pack(todo, low, left)
    best = got or best
    return runs + [(s, a + used.get(s, 0), b + used.get(s, 0), own + k) for s, a, b, k in best]


def shard_documents(docs: DataFrame, shards: int | None = SHARDS,
                    capacity: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per
    input row: with ``capacity`` as few shards of that many bytes as best fit
    finds, else exactly ``shards`` near-equal ones.

    size: UTF-8 bytes of the text plus 1; rows of equal texts share a shard;
    null counts as the empty text. Groups of a size are ordered by their
    digest, slots by salt and doc_id, so repeated rows get slots of their
    own; a null doc_id stays null; an empty table gives an empty result.
    Other columns are not read."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = stored(spark, docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest")), "sizes")
    groups = stored(spark, rows.groupBy("digest").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "groups")
    histogram = [(r["bytes"], r["k"]) for r in groups.groupBy("bytes").agg(
        F.count(F.lit(1)).alias("k")).toLocalIterator()]
    runs = pack(histogram, capacity) if capacity else pack_level(histogram, shards or SHARDS)
    n_rows = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    salts = salts_for(n_rows)
    salt_on = F.xxhash64("digest")
    # a run is at most one per size and bin it reaches: as small as the histogram
    per_size: dict[int, list[tuple[int, int]]] = {}
    for size, first, _, shard in runs:
        per_size.setdefault(size, []).append((first, shard))
    lists = [(s, [a for a, _ in sorted(v)], [k for _, k in sorted(v)])
             for s, v in per_size.items()]
    chosen = stored(spark, spark.createDataFrame(
        lists, "bytes long, firsts array<long>, bins array<int>"), "runs")
    placed = ordinals(groups, "bytes", [F.col("digest")], salt_on, salts, "place") \
        .join(chosen, "bytes")
    run = F.size(F.filter("firsts", lambda a: a <= F.col("place")))
    placed = placed.select("digest", F.element_at("bins", run).alias("shard"))
    out = rows.join(placed, "digest")
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest")]
    out = ordinals(out, "shard", order, F.xxhash64("doc_id", "digest"), salts, "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      "slot", F.lit(None).cast("int").alias("grown_shard"))
