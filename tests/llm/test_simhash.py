import random
import re

import numpy as np
import pytest
import xxhash

from airpanel.llm.components import components
from airpanel.llm.simhash import fingerprint, masks, near_duplicates, near_links, one_of_each, spanning_links


def by_hand(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    return [root(i) for i in range(n)]


def same_classes(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def near(values, bits):
    return [(i, j) for i in range(len(values)) for j in range(i) if bin(values[i] ^ values[j]).count("1") <= bits]


def families(rnd, n=6, size=30, flips=6):
    base = [rnd.getrandbits(64) for _ in range(n)]
    return list({b ^ sum({1 << rnd.randrange(64) for _ in range(rnd.randint(0, flips))}) for b in base for _ in range(size)})


@pytest.mark.parametrize("text", ["", None, " \n", "a", "a b c", "a b c d", "A B C D e", "É x  y\x0bz\u2003q w r s t u" * 3, "one two three " * 900])
def test_fingerprint(text):
    assert fingerprint(text or "") == by_hand(text)


@pytest.mark.parametrize("bits", [0, 1, 3, 4, 5, 7, 8])
def test_blocks_of_planes(bits):
    rnd = random.Random(bits)
    for _ in range(20):
        values = families(rnd, rnd.randint(1, 3), rnd.randint(1, 20))
        links = spanning_links(np.array(values, np.uint64), bits)
        assert set(map(tuple, map(sorted, links))) <= set(map(tuple, map(sorted, near(values, bits))))
        assert len(links) < len(values)
        assert same_classes(classes(len(values), links), classes(len(values), near(values, bits)))


@pytest.mark.parametrize("n", [10, 10**7, 10**10])
def test_some_mask_holds_no_difference(n):
    rnd = random.Random(4)
    kinds = masks(n, 4)
    assert len(kinds) == {10: 5, 10**7: 15, 10**10: 35}[n]
    for _ in range(300):
        differ = sum({1 << rnd.randrange(64) for _ in range(4)})
        assert any(not m & differ for m in kinds)


@pytest.mark.parametrize("block", [4096, 4])
def test_links_and_components(spark, block):
    values = families(random.Random(5), 12, 25)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = [(signed.index(r.a), signed.index(r.b)) for r in near_links(df, 4, block).collect()]
    want = classes(len(values), near(values, 4))
    assert same_classes(classes(len(values), links), want)
    found = {r.node: r.root for r in components(near_links(df, 4, block), "test").collect()}
    for v, c in zip(signed, want):
        members = [s for s, k in zip(signed, want) if k == c]
        assert found.get(v, v) == min(members)


def test_components_of_a_path_and_a_star(spark):
    rows = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 200)] + [(7, 7), (201, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(rows, "a long, b long"), "test").collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 200)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


ROWS = [(5, "one two three four five six"), (3, "One two  three four five six"), (9, None), (8, ""), (None, "only a null id here today"),
        (7, "\n"), (1, "something else entirely, which is not near"), (1, "something else entirely, which is not near"), (1, "other words with the same id")]


def test_table(documents, prose):
    rows = ROWS + [(100 + r.doc_id, r.text) for r in prose.collect()]
    got = near_duplicates(documents(rows)).collect()
    values = [by_hand(t) for _, t in rows]
    kinds = classes(len(rows), near(values, 4))
    want = sorted((str(i), f"{v:016x}", str(min((j for (j, _), m in zip(rows, kinds) if m == c and j is not None), default=None)))
                  for (i, _), v, c in zip(rows, values, kinds))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


def test_one_row_of_each_component(documents):
    df = documents(ROWS)
    got = one_of_each(df)
    assert got.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == [
        ("1", "other words with the same id"), ("1", "something else entirely, which is not near"), ("3", "One two  three four five six"),
        ("7", "\n"), ("None", "only a null id here today")]
    assert one_of_each(df.limit(0)).count() == 0 and near_duplicates(df.limit(0)).count() == 0
