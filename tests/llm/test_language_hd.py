import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.llm import language_hd as H


def brute_vector(text):
    """Sum of bound trigrams, one after the other."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    out = np.zeros(H.DIM, np.int64)
    for w in words:
        code = [0, *map(ord, w), 0]
        for a, b, c in zip(code, code[1:], code[2:]):
            out += (np.roll(H.letter_vector(a), 2) * np.roll(H.letter_vector(b), 1) * H.letter_vector(c)).astype(np.int64)
    return out


TEXTS = ["Hello world", "", "  12 ", "Größe, éa x", "漢字かな交じり文 and more", "a", "\U0001F600 İstanbul", "x-" * 300 + "end", "ǅ ß ﬁ"]


def test_bundles_equal_sums_of_single_ngrams(monkeypatch):
    want = np.stack([brute_vector(t) for t in TEXTS])
    assert (H.bundles(TEXTS) == want).all()
    rng = random.Random(3)
    many = [" ".join("".join(rng.choice("abcdeéßжñ漢字") for _ in range(rng.randint(1, 6))) for _ in range(40)) for _ in range(30)]
    for block, chars in ((7, 1 << 20), (4096, 50)):  # n-gram blocks, and texts in pieces
        monkeypatch.setattr(H, "GRAM_BLOCK", block)
        monkeypatch.setattr(H, "RUN_CHARS", chars)
        assert (H.bundles(many) == np.stack([brute_vector(t) for t in many])).all()
    group = np.array([i % 3 for i in range(30)])
    assert (H.bundles(many, group, 3) == np.stack([sum(brute_vector(t) for t in many[g::3]) for g in range(3)])).all()


def test_letter_vectors_are_near_orthogonal_signs():
    v = np.stack([H.letter_vector(c) for c in range(97, 123)]).astype(int)
    assert set(np.unique(v)) == {-1, 1}
    cos = (v @ v.T / H.DIM)[~np.eye(26, dtype=bool)]
    assert abs(cos).max() < 0.12


WORDS = {"aa": "tal bor mig sten vag dor lun fisk".split(), "bb": "qui sera pomo lecta vira nula cado".split(), "": "жит мор лес дом пол рек".split()}


def corpus(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        out.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(1, 30))), lang))
    return out


def answers(df):
    return sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["held_out"], r["lang_pred"], round(r["score"], 9)) for r in df.collect())


def brute_answers(rows):
    sums = {}
    for d, text, lang in rows:
        if zlib.crc32(str("" if d is None else d).encode()) % 5 and text is not None and lang is not None and any(c.isalpha() for c in text):
            sums[lang] = sums.get(lang, 0) + brute_vector(text)
    unit = {lang: (v / np.linalg.norm(v)).astype(np.float32).astype(float) for lang, v in sorted(sums.items())}
    out = []
    for d, text, _ in rows:
        v, pred, score = brute_vector(text or ""), "und", 0.0
        if v.any() and unit:
            cos = {lang: float(v @ u / np.linalg.norm(v)) for lang, u in unit.items()}
            pred = max(cos, key=lambda k: cos[k])
            score = min(1.0, max(0.0, cos[pred]))
        out.append(((d is not None, d or 0), zlib.crc32(str("" if d is None else d).encode()) % 5 == 0, pred, round(score, 9)))
    return sorted(out)


ODD = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 !!", "bb"), (1003, "tal bor", None), (None, "quisera", "bb"),
       (7, "pomo pomo", "bb"), (7, "pomo pomo", "bb"), (1004, "tal " * 5000, "aa")]


@pytest.mark.parametrize("block", [1024, 1])
def test_query_equals_brute_force(spark, docs, tmp_path, monkeypatch, block):
    monkeypatch.setattr(H, "BLOCK_LANGS", block)  # one language a pass gives the same answers
    rows = corpus(5, 150) + ODD
    docs(rows).withColumns({"held_out": F.lit("x"), "lang_pred": F.lit(1), "score": F.lit("y")}).write.parquet(str(tmp_path / "documents.parquet"))
    assert answers(H.language_query(spark, str(tmp_path))) == brute_answers(rows)


def test_nothing_to_learn_and_empty_table(spark, docs):
    test = H.fold(F.col("doc_id")) == 0
    none = docs([(1, "tal", None), (2, "", "aa")])
    assert [(r["lang_pred"], r["score"]) for r in H.identify(none, ~test, test).collect()] == [("und", 0.0)] * 2
    assert H.identify(none.where("false"), ~test, test).collect() == []


def test_many_languages_and_hot_copies(spark, docs, monkeypatch):
    """3,000 label values, and one text that is a third of all rows; partial prototypes are flushed."""
    monkeypatch.setattr(H, "HELD", 4)
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(WORDS["aa"]) for _ in range(8)), f"l{i % 300}") for i in range(600)]
    rows += [(10_000 + i, "qui sera pomo", "bb") for i in range(300)]
    test = H.fold(F.col("doc_id")) == 0
    got = H.identify(docs(rows), ~test, test)
    assert got.where("doc_id >= 10000 and lang_pred <> 'bb'").count() == 0 and got.count() == 900


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = H.language_query(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 150 and (got.lang_pred == got.lang).mean() > 0.98 and got.score.between(0, 1).all()
