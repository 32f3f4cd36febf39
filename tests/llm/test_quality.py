import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.llm import quality_kn as Q


def base(text):
    text = text or ""
    words = re.findall("[^ \t-\r]+", text)
    chars = sum(map(len, words))
    lines = [x for x in text.split("\n")]
    dup = sum(1 for i, x in enumerate(lines) if re.search("[^ \t-\r]", x) and x in lines[:i])
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    inside = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), chars, len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed


def test_base_metrics_against_plain_code():
    rng = random.Random(31)
    parts = ["a", "b", "the", "#x", "é", "漢字", "\n", "\n", " ", "\t", "\x0b", "\x1c", " ", "\x85", "**", "<a>"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) + rng.choice([" ", "", " "]) for _ in range(rng.randint(0, 40)))
        assert Q.base_metrics(text, text.encode()) == base(text), text


def kn_by_hand(counts, order, bits):
    """Interpolated modified Kneser-Ney by recursion over dictionaries."""
    levels = {order: dict(counts)}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])

    def disc(k, c):
        return Q.discounts(np.array(list(levels[k].values())))[min(c, 3) - 1]

    def prob(g):
        k = len(g)
        lower = prob(g[1:]) if k > 1 else 1 / (1 << bits)
        here = {x: c for x, c in levels[k].items() if x[:-1] == g[:-1]}
        if not here:
            return lower
        total = sum(here.values())
        gamma = sum(disc(k, c) for c in here.values()) / total
        c = here.get(g, 0)
        return (c - disc(k, c) if c else 0) / total + gamma * lower

    return prob


def test_kneser_ney_against_recursion():
    rng = random.Random(32)
    text = "".join(rng.choice("abcab ") for _ in range(400)).encode()
    g, _ = Q.grams([text])
    keys, n = np.unique(g, return_counts=True)
    model = Q.KneserNey.fit(["en"], np.zeros(len(keys), np.int64), keys, n)
    split = lambda x: tuple((int(x) >> Q.SYMBOL_BITS * j) & 63 for j in range(Q.ORDER - 1, -1, -1))
    prob = kn_by_hand({split(k): int(c) for k, c in zip(keys, n)}, Q.ORDER, Q.SYMBOL_BITS)
    ask = np.concatenate([keys[:25], np.array([rng.randrange(1 << 24) for _ in range(15)])])
    got = np.exp(model.log_prob(0, ask))
    assert got == pytest.approx([prob(split(x)) for x in ask])
    context = int(keys[3]) >> Q.SYMBOL_BITS << Q.SYMBOL_BITS
    assert np.exp(model.log_prob(0, context + np.arange(64))).sum() == pytest.approx(1.0)


def read_back(codes):
    """The bytes that a text's symbols stand for, read one after the other as a decoder would."""
    whole = {int(Q.FIRST[b]): b for b in range(256) if Q.SECOND[b] < 0 and not 128 <= b < 192}
    pair = {(int(Q.FIRST[b]), int(Q.SECOND[b])): b for b in range(256) if Q.SECOND[b] >= 0}
    out, at, follow = [], 0, 0
    while at < len(codes):
        if follow:
            out.append(128 | codes[at])
            follow -= 1
        else:
            if codes[at] in whole:
                out.append(whole[codes[at]])
            else:
                out.append(pair[codes[at], codes[at + 1]])
                at += 1
            follow = (out[-1] >= 0xC0) + (out[-1] >= 0xE0) + (out[-1] >= 0xF0) if out[-1] != 255 else 0
        at += 1
    return bytes(out)


def test_symbols_leave_nothing_of_a_text_out():
    rng = random.Random(40)
    pool = "".join(map(chr, range(128))) + "éßñжЯђ漢字語かな가한🙂𝔘\u07ff\u0800\uffff"
    texts = ["", "a", "7", "é", "漢", pool] + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    raw = [t.encode() for t in texts]
    g, starts = Q.grams(raw)
    for t, lo, hi in zip(raw, starts, starts[1:]):
        own = [int(x) & 63 for x in g[lo:hi]]
        assert own[-1] == Q.BOUND and read_back(own[:-1]) == t
        before = [Q.BOUND] * (Q.ORDER - 1) + own
        for i, x in enumerate(g[lo:hi]):
            assert [int(x) >> 6 * j & 63 for j in range(Q.ORDER - 1, -1, -1)] == before[i:i + Q.ORDER]
    assert len({bytes(map(int, g[a:b] & 63)) for a, b in zip(starts, starts[1:])}) == len(set(texts))


def test_other_scripts_digits_and_marks_are_told_apart(docs):
    """Junk that a fold of bytes to classes (non-ASCII modulo 8, digits as one, marks as one) cannot see."""
    rng = random.Random(41)
    words = ["река", "камень", "свет", "облако", "рынок", "окно", "семь", "люди", "сад", "письмо"]
    clean = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(30, 120))), "ru") for i in range(120)]
    junk = [(500 + i, "".join(chr(0x430 + rng.randrange(4) * 8 + (ord(c) & 7)) if c != " " else c for c in clean[i][1]), "ru") for i in range(4)]
    number = lambda digits, mark: "".join(rng.choice(digits) for _ in range(3)) + rng.choice(mark)
    sums = [(600 + i, " ".join(number("2468", "+;") for _ in range(rng.randint(30, 90))), "sum") for i in range(120)]
    odd = [(800, " ".join(number("13579", "|~^`@!?") for _ in range(60)), "sum")]
    got = {r["doc_id"] for r in Q.keep_good(docs(clean + junk + sums + odd)).collect()}
    assert got == {i for i, _, _ in clean + sums}


def test_the_end_of_a_text_counts(spark, docs):
    rng = random.Random(42)
    clean, _ = corpus(rng)
    whole = "river stone light cloud green under market window seven people garden letter."
    d = docs(clean + [(900, whole, "en"), (901, whole[:-3], "en"), (902, "", "en"), (903, None, "en")])
    rows = {r["c0"]: r["log_ppl"] for r in Q.scored(d, Q.fit_model(d), ["doc_id"]).collect()}
    assert rows[901] > rows[900] and rows[902] is None and rows[903] is None


def corpus(rng):
    words = ["river", "stone", "light", "cloud", "green", "under", "market", "window", "seven", "people", "garden", "letter"]
    clean = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(30, 120))) + ".", "en") for i in range(150)]
    junk = [(500 + i, " ".join("".join(rng.choice("#$%^@!~;qxzjkv") for _ in range(7)) for _ in range(60)), "en") for i in range(4)]
    return clean, junk


def test_clean_documents_stay_and_junk_goes(docs):
    clean, junk = corpus(random.Random(33))
    odd = [(900, None, "en"), (901, "", None), (902, "too short", "de"), (903, "one two three four five " * 30, "en"), clean[0],
           (None, clean[1][1], None)]
    d = docs(clean + junk + odd).withColumns({"n_words": F.lit("mine"), "c0": F.lit(0), "kept": F.lit("x")})
    out = Q.keep_good(d)
    assert out.columns == d.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert sorted(i for i in ids if i is not None and i != 0) == list(range(1, 150))
    assert ids.count(0) == 2 and ids.count(None) == 1


def test_query_form_equals_filter_form_and_base(spark, docs, tmp_path):
    clean, junk = corpus(random.Random(34))
    d = docs(clean + junk + [(900, None), (901, "x " * 50)])
    d.write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r for r in Q.quality_query(spark, str(tmp_path)).collect()}
    texts = {r["doc_id"]: r["text"] for r in d.collect()}
    for i, r in rows.items():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base(texts[i])
        assert not (r["base_failed"] and r["kept"])
    assert {i for i, r in rows.items() if r["kept"]} == {r["doc_id"] for r in Q.keep_good(d).collect()}


def test_copies_do_not_narrow_the_band(docs):
    clean, junk = corpus(random.Random(35))
    copies = [(1000 + i, clean[0][1], "en") for i in range(230)]
    got = {r["doc_id"] for r in Q.keep_good(docs(clean + junk + copies)).collect()}
    assert got == {i for i, _, _ in clean + copies}


def test_language_of_two_texts_keeps_both(docs):
    clean, _ = corpus(random.Random(36))
    two = [(2000 + i, clean[i][1], "de") for i in range(2)]
    assert {r["doc_id"] for r in Q.keep_good(docs(clean + two)).collect()} == {i for i, _, _ in clean + two}
    assert Q.keep_good(docs(two)).count() == 2


def test_text_is_sent_once_and_kept_in_its_place(spark, docs, monkeypatch):
    clean, junk = corpus(random.Random(43))
    d = docs(clean + junk + [(900, None, "en"), (901, "", None)])
    model = spark.sparkContext.broadcast(Q.fit_model(d))
    one = Q.scored(d, model, ["doc_id"]).collect()
    monkeypatch.setattr(Q, "SCORED_BYTES", 700)
    out = Q.scored(d, model, ["text", "lang", "doc_id", "text"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    sent = next(line for line in plan.splitlines() if "AS _text" in line)
    assert len(re.findall(r"\btext#", sent)) == 1
    rows = out.collect()
    assert [(r["c0"], r["c1"], r["c2"], r["c3"]) for r in rows] == [(x["text"], x["lang"], x["doc_id"], x["text"]) for x in d.collect()]
    assert [r["log_ppl"] or 0.0 for r in rows] == pytest.approx([r["log_ppl"] or 0.0 for r in one])
    assert [r[4:10] for r in rows] == [r[1:7] for r in one]


def test_empty_table(docs):
    assert Q.keep_good(docs([])).count() == 0
