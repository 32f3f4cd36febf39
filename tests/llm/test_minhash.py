import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from kestrel.llm import minhash_odd as M
from kestrel.llm.components import components
from kestrel.llm.shingles import shingle_hashes


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders, common = defaultdict(list), Counter()
    for i, s in enumerate(sets):
        for g in s:
            common.update((j, i) for j in holders[g])
            holders[g].append(i)
    for (i, j), k in common.items():
        if 100 * k >= 75 * (len(sets[i]) + len(sets[j]) - k):
            parent[find(i)] = find(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        r = find(i)
        if doc_id is not None:
            smallest[r] = min(smallest.get(r, doc_id), doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        comp = smallest.get(find(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), comp, doc_id is not None and doc_id == comp))
    return out


def words(rng, n, vocabulary=400):
    return [f"w{rng.randint(0, vocabulary)}" for _ in range(n)]


def family(rng, size, edits):
    base = words(rng, 120)
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 10 ** 6)}"
        yield " ".join(w)


def compare(df, rows):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], str(r[2]))
    assert sorted(map(tuple, df.collect()), key=key) == sorted(brute(rows), key=key)


def test_against_brute_force(docs):
    rng = random.Random(11)
    texts = [" ".join(words(rng, rng.randint(0, 80))) for _ in range(60)]
    texts += [*family(rng, 60, 9), *family(rng, 25, 3)]
    texts += [texts[0]] * 30 + [texts[5].upper()] * 3 + ["a b", "A  b", "a b c", None, "", " \t", "x"]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(None, texts[0]), (None, "lonely one without any id at all"), (3, texts[3])]
    extra = docs(rows).withColumns({"node": F.lit(1), "key": F.lit("k"), "bands": F.lit(0)})
    compare(M.near_duplicates(extra), rows)


def test_keep_one_keeps_columns_and_one_row_of_each_group(docs):
    rng = random.Random(12)
    rows = list(enumerate([*family(rng, 20, 2), " ".join(words(rng, 50)), None, ""]))
    rows += [rows[0], (None, "no id here")]
    out = M.keep_one(docs(rows).withColumn("kept", F.lit("mine")))
    kept = sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in out.collect())
    want = sorted({(d is not None, d or 0) for d, _, c, k in brute(rows) if k or d is None})
    assert kept == want and out.columns[-1] == "kept"


def test_empty_table(docs):
    assert M.near_duplicates(docs([])).count() == 0


def test_odd_sketches_estimate_similarity():
    rng = np.random.default_rng(4)
    for shared in (280, 320, 343, 370):
        common = rng.integers(0, 2**63, shared, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 2**63, 400 - shared, dtype=np.uint64)])) for _ in range(2))
        true = shared / (800 - shared)
        z = int(np.bitwise_count((M.odd_sketch(M.samples(a)) ^ M.odd_sketch(M.samples(b))).view(np.uint64)).sum())
        guess = 1 + M.BITS / (4 * M.BANDS * M.ROWS) * np.log(1 - 2 * z / M.BITS)
        assert abs(guess - true) < 0.2
        z = int(np.bitwise_count((M.fine_sketch(a) ^ M.fine_sketch(b)).view(np.uint64)).sum())
        apart = -M.FINE_BITS / 2 * np.log(1 - 2 * z / M.FINE_BITS)
        assert abs((800 - apart) / (800 + apart) - true) < 0.04


def test_shingles_do_not_cross_texts():
    a, b, c = list(shingle_hashes([b"a b c d e f", b"", b"A b c d e"], 5))
    assert len(a) == 2 and len(b) == 0 and len(c) == 1 and c[0] == a[0]


def test_components_of_a_long_path(spark):
    links = spark.range(40).select(F.lpad("id", 3, "0").alias("a"), F.lpad(F.col("id") + 1, 3, "0").alias("b"))
    labels = components(links)
    assert labels.select("label").distinct().collect()[0][0] == "000" and labels.count() == 41
