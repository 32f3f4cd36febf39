import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from kestrel.llm import suffix_dedup as S


def brute(rows):
    count = Counter()
    for _, text in rows:
        b = (text or "").encode()
        count.update(b[i:i + 200] for i in range(len(b) - 199))
    out = []
    for doc_id, text in rows:
        b = (text or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - 199):
            if count[b[i:i + 200]] > 1:
                gone[i:i + 200] = [True] * 200
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def compare(df, rows):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], bytes(r[4]))
    got = sorted([(*r[:4], bytes(r[4])) for r in df.collect()], key=key)
    assert got == sorted(brute(rows), key=key)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(n))


def test_against_brute_force(docs):
    rng = random.Random(5)
    passage, short = words(rng, 90), words(rng, 200).encode()[:203].decode(errors="ignore")
    rows = [(i, words(rng, rng.randint(0, 150))) for i in range(30)]
    rows += [(40 + i, words(rng, 20) + passage + words(rng, 20)) for i in range(12)]
    rows += [(60 + i, words(rng, 30) + short + words(rng, 3)) for i in range(3)]
    rows += [(70, passage), (71, passage), (72, passage[3:]), (72, passage[3:])]
    rows += [(80, "The " * 300), (81, "x" * 205), (82, "y" * 200), (83, words(rng, 60) * 2)]
    rows += [(90, None), (91, ""), (None, passage[:210]), (None, "short")]
    compare(S.deduplicate(docs(rows)), rows)


def test_single_texts_repeat_only_inside(docs):
    rng = random.Random(6)
    rows = [(1, "ab" * 150), (2, words(rng, 400)), (3, "z" * 199)]
    compare(S.deduplicate(docs(rows)), rows)


def test_long_and_short_stretches_of_one_seed(docs):
    rng = random.Random(9)
    rows = [(1, "x" * 5000), (2, words(rng, 20) + "x" * 200 + words(rng, 20))]
    compare(S.deduplicate(docs(rows)), rows)
    for i in range(4):
        tail = words(rng, 10)
        rows += [(10 + i, words(rng, 9) + "-" * 4000 + tail + words(rng, 9)), (20 + i, words(rng, 9) + "-" * 160 + tail + words(rng, 9)),
                 (30 + i, f"{i}" + " line %d\n" % i * 700), (40 + i, words(rng, 9) + " line %d\n" % i * 28)]
    compare(S.deduplicate(docs(rows)), rows)


def test_blocks_and_bins(docs, monkeypatch):
    rng = random.Random(7)
    monkeypatch.setattr(S, "BLOCK_ROWS", 2)
    monkeypatch.setattr(S, "BUCKET_DOCS", 1)
    base = words(rng, 120)
    rows = [(i, base[:rng.randint(0, 400)] + words(rng, 10) + base[rng.randint(0, 300):]) for i in range(25)]
    compare(S.deduplicate(docs(rows).withColumn("keys", F.lit(1)).withColumn("block", F.lit("x"))), rows)


def test_blocks_that_send_several_runs_a_bin(docs, monkeypatch):
    rng = random.Random(11)
    monkeypatch.setattr(S, "HELD", 700)
    base, other = words(rng, 120), words(rng, 150)
    rows = [(i, base[:rng.randint(0, 400)] + words(rng, 10) + base[rng.randint(0, 300):]) for i in range(12)]
    rows += [(20 + i, words(rng, 5) + other) for i in range(3)] + [(30, other), (31, other), (32, "ab" * 400), (33, "x" * 3000)]
    compare(S.deduplicate(docs(rows)), rows)


def test_a_block_holds_one_run_and_a_bin_one_seed(monkeypatch):
    """What a bin holds at a time is a seed's stretches: merging gives a seed's strings one after the other."""
    rng = random.Random(12)
    passage = [words(rng, 100) for _ in range(20)]
    texts = [(words(rng, 9) + p + words(rng, 9)).encode() for p in passage for _ in range(4)]
    runs = []
    for part in range(0, len(texts), 8):
        found = {}
        for t in texts[part:part + 8]:
            for seed, f, e in zip(*S.stretches(t)):
                found[int(seed).to_bytes(8, "big", signed=True) + t[f:e + S.LENGTH - 1]] = 1
        (row,) = S.run_rows("b", {0: found})
        runs.append((S.Run(row[2].tolist(), row[3].tolist(), S.zstd.decompress(row[4])), row[5].tolist()))
    seeds = [s[:S.KEY] for s, _, _ in S.merged_stretches([r for r, _ in runs], [n for _, n in runs])]
    assert len(set(seeds)) == 1 + sum(a != b for a, b in zip(seeds, seeds[1:]))


def test_empty_table(docs):
    assert S.deduplicate(docs([])).count() == 0


def test_loser_tree_merges_front_coded_runs():
    rng = random.Random(8)
    for n in (1, 2, 3, 5, 8):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 30))) for _ in range(n)]
        merged = list(S.merge([S.Run(*S.front_code(r)) for r in runs]))
        strings = [x[3] for x in merged]
        assert strings == sorted(s for r in runs for s in r)
        for (_, _, shared, s), before in zip(merged, [b""] + strings):
            k = next((i for i, (x, y) in enumerate(zip(s, before)) if x != y), min(len(s), len(before)))
            assert shared == k
        assert all(runs[r][at] == s for r, at, _, s in merged)


def test_common_prefix_skips_the_known_part():
    assert S.common_prefix(b"aXcd", b"aYce", 2) == 3
    assert S.common_prefix(b"abc", b"abcd", 0) == 3


def test_digest_of_query_form(docs):
    out = S.deduplicate(docs([(1, "a")])).select(F.sha2("kept", 256).alias("h")).first()["h"]
    assert out == hashlib.sha256(b"a").hexdigest()
