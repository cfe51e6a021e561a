import random
import zlib
from collections import Counter, defaultdict

from odpanel.llm import packing


def brute(items, capacity):
    bins, placed = [], Counter()
    for s in sorted(items, reverse=True):
        fit = [(room, i) for i, room in enumerate(bins) if room >= s]
        i = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append(max(capacity, s))
        bins[i] -= s
        placed[s, i] += 1
    return placed


def test_runs_equal_item_by_item_packing():
    rng = random.Random(1)
    for _ in range(200):
        items = [rng.randint(1, rng.choice([5, 20, 100])) for _ in range(rng.randint(0, 60))]
        capacity = rng.randint(5, 120)
        got = Counter()
        for s, a, b, k in packing.pack(list(Counter(items).items()), capacity):
            got[s, k] += b - a + 1
        assert got == brute(items, capacity)


def test_tree_stays_balanced_and_sorted():
    rng, tree, held = random.Random(2), packing.BinTree(), set()
    for i in range(2000):
        if held and rng.random() < 0.4:
            key = rng.choice(sorted(held))
            tree.remove(key)
            held.remove(key)
        else:
            key = (rng.randint(0, 500), i)
            tree.add(key)
            held.add(key)
        size = rng.randint(0, 520)
        assert tree.tightest(size) == min((k for k in held if k[0] >= size), default=None)

    def height(node):
        if node is None:
            return 0
        a, b = height(node.left), height(node.right)
        assert abs(a - b) <= 1
        return 1 + max(a, b)

    height(tree.root)


def check(rows, texts, shards=8):
    groups, slots, load = {}, defaultdict(list), Counter()
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert r.size == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
        assert groups.setdefault(raw, r.shard) == r.shard and r.grown_shard is None
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert set(load) <= set(range(shards))
    return [load[k] for k in range(shards)]


def test_shards_are_level(docs):
    load = check(packing.shard_documents(docs).collect(),
                 {r.doc_id: r.text for r in docs.collect()})
    assert max(load) - min(load) <= 0.01 * sum(load) / 8


def test_hot_group_gets_its_own_shard(spark):
    rows = [(i, "hot" * 50) for i in range(300)] + [(1000 + i, f"t{i}" * 20) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    load = check(packing.shard_documents(df).collect(), dict(rows))
    assert load[0] == 300 * 151 and max(load[1:]) - min(load[1:]) <= 82


def test_fixed_capacity_uses_few_shards(docs):
    rows = packing.shard_documents(docs, capacity=40_000).collect()
    load = Counter()
    for r in rows:
        load[r.shard] += r.size
    assert max(load.values()) <= 40_000
    assert len(load) <= -(-sum(load.values()) // 40_000) + 1


def test_edge_cases(edges, no_docs):
    rows = packing.shard_documents(edges).collect()
    assert len(rows) == edges.count()
    assert len({r.shard for r in rows if r.size == 1}) == 1     # null and empty: one group
    assert packing.shard_documents(no_docs).count() == 0
