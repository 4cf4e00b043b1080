import numpy as np
import xxhash

from strata.llm import components, simhash
from tests.llm.helpers import SF, docs_frame, documents, with_clashes


def brute_fp(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(fps, max_bits=3):
    """fps: list of (id, fp) -> component id per position."""
    distinct = sorted({f for _, f in fps})
    arr = np.array(distinct, np.uint64)
    parent = list(range(len(arr)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(arr)):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= max_bits):
            a, b = find(i), find(i + 1 + int(j))
            parent[max(a, b)] = min(a, b)
    root = {f: find(i) for i, f in enumerate(distinct)}
    least = {}
    for i, f in fps:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return [least.get(root[f]) for _, f in fps]


def test_gray_index_finds_every_pair():
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fp = np.concatenate([centres, *[centres ^ sum((np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64) for _ in range(r)), np.uint64(0))
                                    for r in (1, 2, 3, 4, 5)], np.array([0, 1, 2**64 - 1], np.uint64)])
    fp = np.unique(fp)
    bucket = (fp % np.uint64(3)).astype(np.int64)
    index = simhash.GrayIndex(bucket, fp)
    got = {tuple(sorted((int(index.fp[a]), int(index.fp[b])))) for i, j in index.links(3) for a, b in zip(i, j)}
    want = {(int(a), int(b)) for x, a in enumerate(fp) for b in fp[x + 1:] if a % np.uint64(3) == b % np.uint64(3) and int(a ^ b).bit_count() <= 3}
    assert got == want
    assert simhash.GrayIndex(np.zeros(0, np.int64), np.zeros(0, np.uint64)).levels


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 400)] + [(5, 5), (399, 1000), (1000, 7)] + [(-4, 2000)]
    got = dict(map(tuple, components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert all(got[i] == 0 for i in [*range(61), *range(100, 400), 1000]) and got[2000] == got[-4] == -4
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


ROWS = [(5, "a b c d"), (6, "A  b\tc\nd"), (7, None), (8, ""), (9, "  \n"), (None, "a b c d"), (5, "a b c d"), (10, "one"), (11, "one two"),
        (12, "é\x1c x y z"), (13, "w " * 70_000), *[(100 + i, " ".join(f"t{j}" for j in range(300) if j != i)) for i in range(120)]]


def check(rows, got):
    want_fp = [(r[0], brute_fp(r[1])) for r in rows]
    want = sorted(((i, f"{f:016x}", c) for (i, f), c in zip(want_fp, brute_groups(want_fp))), key=str)
    assert sorted(got, key=str) == want


def as_query(df):
    from pyspark.sql import functions as F

    return [tuple(r) for r in df.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id").collect()]


def test_simhash_odd_rows(spark):
    check(ROWS, as_query(simhash.near_groups(with_clashes(docs_frame(spark, ROWS).repartition(3)))))
    assert simhash.near_groups(docs_frame(spark, [])).count() == 0


def test_split_of_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SPLIT_ROWS", 10)
    check(ROWS, as_query(simhash.near_groups(docs_frame(spark, ROWS))))


def test_simhash_table(spark):
    check(documents(spark), [tuple(r) for r in simhash.op2_simhash(spark, SF).collect()])


def test_keep_rows(spark):
    rows = [r for r in ROWS if r[0] is not None][1:]
    fps = [(r[0], brute_fp(r[1])) for r in rows]
    want = sorted(i for (i, _), c in zip(fps, brute_groups(fps)) if i == c)
    df = docs_frame(spark, rows)
    got = simhash.keep_rows(df)
    assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == want
