"""PPM scores against a brute-force model that walks a dictionary trie symbol by symbol."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from kestrel.llm import ppm_score as P

END = 256


def train(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 10 != 0


def symbols(text):
    return list((text or "").encode().lower()) + [END]


def brute(rows):
    trie = defaultdict(Counter)
    words, ends = Counter(), 0
    for doc_id, text in rows:
        if not train(doc_id):
            continue
        s = [END] * P.DEPTH + symbols(text)
        for i in range(P.DEPTH, len(s)):
            for k in range(P.DEPTH + 1):
                trie[tuple(s[i - k:i])][s[i]] += 1
        words.update((text or "").encode().lower().split())
        ends += 1
    n, v = sum(words.values()) + ends, len(words) + (1 if ends else 0)
    out = []
    for doc_id, text in rows:
        s, total = [END] * P.DEPTH + symbols(text), 0.0
        for i in range(P.DEPTH, len(s)):
            ruled, left = set(), None
            for k in range(P.DEPTH, -1, -1):
                node = trie.get(tuple(s[i - k:i]))
                if not node:
                    continue
                rest = {x: c for x, c in node.items() if x not in ruled}
                whole = sum(2 * c - 1 for c in rest.values()) + len(rest)
                if s[i] in rest:
                    total += math.log10((2 * rest[s[i]] - 1) / whole)
                    break
                if rest:
                    total += math.log10(len(rest) / whole)
                ruled = set(node)
            else:
                total -= math.log10(257 - len(ruled))
        tokens = (text or "").encode().lower().split()
        per = math.log10(n + 0.1 * (v + 1))
        base = sum(math.log10(words[w] + 0.1) - per for w in tokens) + math.log10(ends + 0.1) - per
        out.append((doc_id, not train(doc_id), len(tokens) + 1, sum(w in words for w in tokens) + (1 if ends else 0), n, base, total))
    return out


def compare(df, rows):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], round(r[6], 6))
    got = sorted([tuple(r) for r in df.collect()], key=key)
    want = sorted(brute(rows), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], abs=1e-6) and g[6] == pytest.approx(w[6], rel=1e-6)  # singles on the way


def test_against_brute_force(docs):
    random.seed(3)
    words = ["the", "a", "The", "être", "ab", "abab", "x\ty", "漢字", "zz\n", "of"]
    rows = [(i, " ".join(random.choice(words) for _ in range(random.randint(0, 40)))) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "the a the"), (7, rows[7][1]), (7, rows[7][1]), (102, "q" * 5000), (103, "ÿ\x00\x7f")]
    compare(P.score(docs(rows)), rows)


def test_small_blocks_and_many_buckets(docs, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_ROWS", 3)
    monkeypatch.setattr(P, "BUCKET_DOCS", 1)
    rows = [(i, f"text number {i % 7} of the lot {'x' * (i % 5)}") for i in range(40)]
    compare(P.score(docs(rows)), rows)


def test_empty_and_untrained(docs):
    assert P.score(docs([])).count() == 0
    rows = [(i, "only held out") for i in range(200) if not train(i)][:3]
    compare(P.score(docs(rows)), rows)


def test_probabilities_of_a_context_sum_to_one():
    import numpy as np
    texts = [b"abracadabra", b"abacus", b"cab"]
    g, _ = P.grams(texts)
    keys, n = P.tally(g, np.ones(len(g)))
    pk, pn = P.tally(keys & P.mask(2), n)
    for context in (b"zabra", b"abrac", b"zzzzz", b"a"):
        full = [P.END] * P.DEPTH + list(context)
        ctx = 0
        for s in full[-P.DEPTH:]:
            ctx = (ctx << P.BITS) | s
        lp = P.code_lengths(np.array([(ctx << P.BITS) | s for s in range(P.SYMBOLS)]), keys, n, P.Pairs(pk, pn))
        assert (10.0 ** lp).sum() == pytest.approx(1.0)
