"""Toxicity, PII surrogates and secrets."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from kestrel.llm import pii_surrogate as P
from kestrel.llm import secrets_zstd as Z
from kestrel.llm import toxicity_channel as X

from .conftest import LABELS

WORDS = "idiot moron stupid worthless garbage window garden people market river letter number simple winter summer".split()


def cost():
    from kestrel.llm.shingles import text_runs  # noqa: F401
    s = X._FOLD[np.frombuffer((" " + " ".join(WORDS * 50) + " ").encode(), np.uint8)]
    gram = (s[:-2] << 2 * X.BITS) | (s[1:-1] << X.BITS) | s[2:]
    return X.costs(np.bincount(gram, minlength=1 << 3 * X.BITS))


def test_disguised_words_are_restored_and_plain_ones_stay():
    r = X.Restorer(cost())
    for raw, word in (("1d10t", "idiot"), ("m0r0n,", "moron"), ("stuuuupid!!", "stupid"), ("w0rth1e$$", "worthless"), ("g@rb@ge", "garbage"),
                      ("i.d.i.o.t", "idiot"), ("garden", "garden"), ("winter***", "winter"), ("letter.", "letter")):
        assert r.word(raw) == word, raw
    assert "moron" in r.words("you m o r o n of a person") and "stupid" in r.words("s-t-u-p-i-d")
    long = "e9b9ed9cc9" * 8
    assert r.word(long) == long


def test_viterbi_is_the_best_path_of_all():
    table = cost()

    def every(text):
        paths = [(0.0, (0, 0), "", "")]
        for c in text:
            nxt = []
            for total, (a, b), last, out in paths:
                options = [(x, X.IMITATE) for x in X.IMITATES.get(c, "")]
                options += [(c, X.KEEP)] if X.symbol(c) else []
                options += [(" ", X.BREAK)] if c in X.SEPARATORS and last not in ("", " ") else []
                options += [("", X.SKIP_SEPARATOR)] if c in X.SEPARATORS else [] if X.symbol(c) else [("", X.SKIP_OTHER)]
                for x, price in options:
                    if x:
                        s = X.symbol(x)
                        nxt.append((total + price + table[a, b, s], (b, s), x, out + x))
                    else:
                        nxt.append((total + price, (a, b), last, out))
                if last and (c == last or last in X.IMITATES.get(c, "")):
                    nxt.append((total + X.SKIP_REPEAT, (a, b), last, out))
            paths = nxt
        return min((t + table[a, b, 0], o) for t, (a, b), _, o in paths)[1]

    for text in ("1d1ot", "st*pid", "mmo0n", "g.a.r", "$1m|", "an-id", "a. b", "mm--oo"):
        assert X.restore(text, table) == every(text)


def test_strings_of_any_share_and_length_are_restored():
    words = "asshole shit idiot ass stupid you are an bad letter person worthless good moron number class garden".split()
    f = X._FOLD[np.frombuffer((" " + " ".join(words * 80) + " ").encode(), np.uint8)]
    table = X.costs(np.bincount((f[:-2] << 2 * X.BITS) | (f[1:-1] << X.BITS) | f[2:], minlength=1 << 3 * X.BITS))
    r = X.Restorer(table)
    for raw, word in (("4$$h0l3", "asshole"), ("$#!t", None), ("1d10+", "idiot"), ("@$$", "ass"), ("stuupid", "stupid"), ("letter", "letter"), ("good", "good")):
        assert word is None or word in r.readings(raw), (raw, r.readings(raw))
        assert raw in r.readings(raw)
    assert X.disguised("$#!t") and "f***" in r.readings("f***,") and r.readings("$100") == {"$100"} and r.readings("2024") == {"2024"}
    joined = "you.are.an.idiot.and.a.worthless.person.number.one"
    assert len(joined) > X.MAX_WORD and {"idiot", "worthless", "person"} <= r.readings(joined)
    assert {"you", "are", "an", "idiot"} <= r.words("y o u a r e a n i d i o t") and "bad" in r.words("b a d")
    assert r.words("1 2 3 4 5") == set("12345") and r.words("") == set()
    many = "_".join(["st.u.p1d"] * 5000)
    assert "stupid" in r.readings(many) and many not in r.known


def test_toxicity_is_learned_without_the_held_out_fold(spark, docs):
    rng = random.Random(51)
    rows, labels = [], []
    for i in range(500):
        bad = i % 4 == 0
        text = " ".join(rng.choice(WORDS[5:]) for _ in range(20)) + (" " + rng.choice(["idiot", "moron", "m0ron", "stupid", "1diot"]) if bad else "")
        rows.append((i, text))
        labels.append((i, 1, int(bad)))
    rows += [(1000, None), (1001, ""), (None, "idiot"), rows[0]]
    labels += [(0, 1, 0), (2000, 1, 1), (None, 1, 1), (3, None, None)]
    lab = spark.createDataFrame(labels, LABELS)
    out = X.scored(docs(rows).withColumns({"toxic": F.lit(9), "score": F.lit("x")}), X.fit(docs(rows), lab)).collect()
    held = [r for r in out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 500]
    assert len(held) > 50 and all(r["predicted"] == (r["doc_id"] % 4 == 0) for r in held)
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    # Labels of the held-out fold never matter.
    flipped = lab.withColumn("toxic", F.when(X.bucket(F.col("doc_id"), X.FOLDS) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = X.scored(docs(rows), X.fit(docs(rows), flipped)).collect()
    score = lambda rs: sorted((r["doc_id"] is not None, r["doc_id"] or 0, round(r["score"], 9)) for r in rs)
    assert score(again) == score(out)


def test_toxicity_without_labels_or_documents(spark, docs):
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in X.scored(docs([(1, "a")]), X.fit(docs([(1, "a")]), none)).collect()} == {0.25}
    assert X.scored(docs([]), X.fit(docs([]), none)).count() == 0


TEXT = ("Mail Anna.Lee7@mail3.example.com or anna.lee7@MAIL3.example.com, call +1 (499) 555-6503 or +1 499 555 6503. Card 4111 1111 1111 1111 and "
        "4785380592391139, host 10.1.2.3 and 8.196.197.208. Herr Schmidt met Frau Anna Berg and Herr Schmidt.")


def test_surrogates_keep_type_format_and_coreference(docs):
    rows = [(1, TEXT), (2, "again Anna.Lee7@mail3.example.com from 8.196.197.208"), (3, None), (4, ""), (None, TEXT), (1, TEXT)]
    out = {(r["doc_id"], r["n_entities"]): r for r in P.replaced(docs(rows).withColumn("kind", F.lit("x"))).collect()}
    a, b = out[1, 11]["text"], out[2, 2]["text"]
    assert out[3, 0]["text"] is None and out[4, 0]["text"] == "" and out[None, 11]["text"] == a
    spans = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in out[1, 11]["spans"].split(","))]
    assert [k for k, _, _ in spans] == ["email", "email", "phone", "phone", "card", "card", "ip", "ip", "name", "name", "name"]
    for _, s, e in spans:
        assert TEXT[s:e] not in a
    mails = re.findall(r"[\w.]+@[\w.]+", a)
    assert mails[0].lower() == mails[1].lower().rstrip(",") and mails[0].endswith(".example.com") and mails[0][0].isupper()
    assert re.findall(r"\S+@\S+", b)[0] == mails[0]
    phones = re.findall(r"\+1 \(?\d{3}\)? \d{3}[- ]\d{4}", a)
    assert len(phones) == 2 and re.sub(r"\D", "", phones[0]) == re.sub(r"\D", "", phones[1])
    card = re.search(r"(\d{4} ){3}\d{4}", a).group().replace(" ", "")
    assert P.luhn(card) == 0 and re.search(r"\b10\.\d\.\d\.\d\b", a)
    names = re.findall(r"Herr (\w+)", a)
    assert names[0] == names[1] and "Frau " in a


def test_collisions_draw_again_until_all_differ(spark, docs):
    rows = [(i, f"mail {c}@x.co") for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")] + [(100 + i, f"ip 9.9.9.{i}") for i in range(10)]
    found = P.detected(docs(rows))
    forms = P.distinct_surrogates(found, "k").collect()
    assert len({(r["kind"], r["form"]) for r in forms}) == len(forms) == 36
    assert not {(r["kind"], r["form"]) for r in forms} & {(r["kind"], r["norm"]) for r in forms}
    texts = [r["text"] for r in P.replaced(docs(rows), "k").collect()]
    assert len(set(texts)) == 36 and not set(texts) & {t for _, t in rows}
    assert P.replaced(docs([])).count() == 0


def rounds_brute(known, key):
    """The collision rounds over all entities at once, by their definition."""
    shown = {(k, n.rsplit(":", 1)[-1] if k == "name" else n) for k, n in known}
    attempt = dict.fromkeys(known, 0)
    while True:
        form = {e: P.surrogate(key, *e, a) for e, a in attempt.items()}
        first = {}
        for e in sorted(known, key=lambda e: (attempt[e], e[1])):
            first.setdefault((e[0], form[e]), e)
        again = [e for e in known if first[e[0], form[e]] != e or (e[0], form[e]) in shown]
        if not again:
            return sorted((*e, attempt[e], form[e]) for e in known)
        for e in again:
            attempt[e] += 1


def test_surrogates_against_brute_force(docs):
    """Texts put together from known entities and plain words: every entity and nothing else is replaced, alike
    everywhere, and no two alike."""
    rng = random.Random(56)
    family = ["Smith", "Berg", "Петров", "Παππάς", "李明", "Ba", "Bapawa", "Müller-Weiß"]
    things = ([("name", f"{t} ", n) for t in ("Mr", "Frau", "Dr") for n in family + ["John Smith", "Anna Berg", "Иван Петров"]]
              + [("ip", "", f"{a}.{b}.3.{c}") for a, b in ((10, 0), (192, 168), (8, 9)) for c in range(5)]
              + [("email", "", f"{c}@x.co") for c in "abcdefghijklmnop"] + [("phone", "", "415-555-12%02d" % i) for i in range(9)]
              + [("phone", "", "+49 30 1234%02d" % i) for i in range(9)] + [("card", "", "4111 1111 1111 1111")])
    rows, cut = [], {}
    for d in range(150):
        text, own = "", []
        for _ in range(rng.randint(0, 9)):
            kind, before, what = rng.choice(things)
            text += rng.choice(["and then ", "x, ", "", "no 12 or "]) + before
            own.append((kind, len(text), len(text) + len(what)))
            text += what + rng.choice([" went. ", " | ", "\n", "; "])
        rows.append((d, text))
        cut[d] = own
    rows += [(500, None), (501, "")]
    key = "brute"
    out = {r["doc_id"]: r for r in P.replaced(docs(rows), key).collect()}
    known = sorted({(k, p) for _, t in rows for _, _, k, n in P.entities(t or "") for p in P.parts(k, n)})
    final = {(k, n): f for k, n, _, f in rounds_brute(known, key)}
    assert len({(k, f) for (k, _), f in final.items()}) == len(known)
    became = {}
    for d, t in rows:
        assert [tuple(x.split(":")) for x in filter(None, out[d]["spans"].split(","))] == [(k, str(s), str(e)) for k, s, e in cut.get(d, [])]
        want, at = "", 0
        for s, e, kind, norm in P.entities(t or ""):
            new = P.rendered(t[s:e], kind, [final[kind, p] for p in P.parts(kind, norm)])
            became.setdefault((kind, norm), set()).add(new)
            want, at = want + t[at:s] + new, e
        assert out[d]["text"] == (None if t is None else want + t[at:])
    assert all(len(v) == 1 for (k, _), v in became.items() if k != "phone")
    assert len({v for k, vs in became.items() for v in vs}) == sum(map(len, became.values()))


def test_rounds_equal_brute_force_where_many_collide(spark):
    known = ([("name", f":latin:{a}{b}") for a in "abcdefghij" for b in ("", "x", "ba", "bata")] + [("name", f"{g}:latin:john") for g in "mfn"]
             + [("name", f"m:latin:x{i}") for i in range(60)] + [("ip", f"1.2.{i}.{j}") for i in range(10) for j in range(10)] + [("email", f"{c}@x.co") for c in "abcdefghijklmnopqrstuvwxyz"])
    got = P.distinct_surrogates(spark.createDataFrame(known + known[:5], "kind string, norm string"), "k").collect()
    assert sorted(tuple(r) for r in got) == rounds_brute(known, "k")


def test_names_of_many_people_stay_apart(docs):
    names = ["".join(p).title() for p in itertools.product(("ka", "lor", "mi", "tes", "vun"), ("dan", "fel", "gor", "hum"), ("ba", "ce", "di", "fo", "gu"),
                                                            ("ral", "sen", "tik"), ("", "a", "o", "us", "ix"))]
    rows = [(i, f"{('Mr', 'Frau', 'Dr')[i % 3]} {n} left") for i, n in enumerate(names)]
    shown = [r["text"].split(" ")[1] for r in P.replaced(docs(rows), "k").collect()]
    assert len(set(shown)) == len(names) == 1500 and not set(shown) & set(names)


def test_one_person_under_several_names(docs):
    rows = [(1, "Mr John Smith met Dr John Smith. Later Smith left, JOHN stayed; Smithson did not."), (2, "Smith alone"),
            (3, "Mr May said it may rain in May"), (4, "Dr Παπάς και Παπάς"), (5, "Mr 李明, 李明"), (6, "г-н Петров и Петров")]
    out = {r["doc_id"]: r["text"] for r in P.replaced(docs(rows), "k").collect()}
    words = out[1].replace(".", "").split(" ")
    assert words[1:3] == words[5:7] and "Smith l" not in out[1] and "JOHN" not in out[1]
    assert words[8] == words[2] and "Smithson" in out[1]
    assert out[2] == "Smith alone" and out[3].endswith("it may rain in May")
    assert [P.script(out[i].split(" ")[1]) for i in (4, 5, 6)] == ["greek", "cjk", "cyrillic"]
    assert out[4].split(" ")[1] == out[4].split(" ")[3] and out[5].split(" ")[1].rstrip(",") == out[5].split(" ")[2]
    assert "Παπάς" not in out[4] and "李明" not in out[5]


def test_a_full_private_range_has_an_end(spark):
    known = [("ip", f"192.168.{i >> 8}.{i & 255}") for i in range(60_000)]
    forms = P.distinct_surrogates(spark.createDataFrame(known, "kind string, norm string"), "k").collect()
    assert len({r["form"] for r in forms}) == 60_000 and not {r["form"] for r in forms} & {n for _, n in known}
    assert all(r["form"].startswith(("192.168.", "10.", "fd00:")) for r in forms)


def base_brute(text):
    text = text or ""
    out = []
    for kind, pattern, low, group, flags in (("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 8, 2, re.I | re.A),
                                             ("access", r"AKIA[A-Z0-9]+", 16, 0, 0), ("hex", r"[0-9a-f]+", 32, 0, 0)):
        found = [m for m in re.finditer(pattern, text, flags) if len(m.group(group)) >= low]
        out += [(m.start(), ("assign", "access", "hex").index(kind), f"{kind}:{m.start()}:{m.end()}") for m in found]
    spans = ",".join(x[2] for x in sorted(out))
    return spans, hashlib.sha256(spans.encode()).hexdigest()


def test_secrets_against_brute_force(docs):
    rng = random.Random(52)
    parts = ["password", "TOKEN", "api_key", "apikey", '"', "'", " ", "=", ":", "abcdefgh", "0123456789abcdef", "AKIA", "ABCDEF123456", "é", "\n", "ſecret=abcdefghij", "K", "."]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (None, 'token="' + "ab12" * 8 + '"'), rows[0], (1002, "0123456789abcdef" * 4000)]
    out = Z.scan(docs(rows).withColumns({"spans": F.lit(1), "word": F.lit(2)})).collect()
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["base_sha256"], r["n_assign"] + r["n_access"] + r["n_hex"]) for r in out)
    want = sorted((d is not None, d or 0, base_brute(t)[1], len([x for x in base_brute(t)[0].split(",") if x])) for d, t in rows)
    assert got == want
    by_id = {r["doc_id"]: r for r in out}
    assert all(set(filter(None, base_brute(t)[0].split(","))) <= set(by_id[d]["spans"].split(",")) for d, t in rows)
    assert Z.scan(docs([])).count() == 0


def test_incompressible_strings_near_sensitive_words_are_novel(docs):
    random_string = "iGGxGRJl5CYAVH66WxYLwx29Qq"
    rows = [(1, f"Authorization: Bearer {random_string} was sent"), (2, f"the word {random_string} stands alone here"),
            (3, "credential: value_value_value_value_1 value_value_value_value_1"), (4, f"auth {random_string} {random_string} {random_string}")]
    out = {r["doc_id"]: r for r in Z.scan(docs(rows)).collect()}
    start = rows[0][1].index(random_string)
    assert out[1]["spans"] == f"novel:{start}:{start + len(random_string)}" and out[2]["spans"] == "" and out[3]["n_novel"] == 0
    assert out[4]["n_novel"] == 3  # its own copies are not its surroundings


def test_keys_written_twice_are_reported_twice(docs):
    rng, letters = random.Random(54), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choice(letters) for _ in range(40)) for _ in range(60)]
    rows = [(i, f"bearer {k} and then once more {k} for the auth service") for i, k in enumerate(keys)]
    out = [r["n_novel"] for r in Z.scan(docs(rows), words=["service", "auth"]).collect()]
    assert out.count(2) >= 58


def test_copies_are_cut_out_of_a_context():
    rng = random.Random(55)
    for _ in range(300):
        own = "".join(rng.choice("xy") for _ in range(3)) + "z"
        text = "".join(rng.choice(["a", "b", own, "xyz"]) for _ in range(8))
        lo = rng.randint(0, len(text))
        hi = rng.randint(lo, len(text))
        copies, at = set(), text.find(own)
        while at >= 0:
            copies |= set(range(at, at + len(own)))
            at = text.find(own, at + len(own))
        assert Z.without(text, lo, hi, own) == "".join(c for i, c in enumerate(text) if lo <= i < hi and i not in copies)


def test_long_random_strings_of_small_alphabets_are_novel(docs):
    rng, upper, lower = random.Random(53), "0123456789ABCDEF", "0123456789abcdefghijklmnopqrstuvwxyz"
    rows = [(100 * k + i, "token " + "".join(rng.choice(a) for _ in range(n)) + end) for k, (a, n, end) in enumerate(
        ((upper, 64, ""), (upper, 256, ""), (lower, 256, ""), (lower, 256, " is what the old service still asks for"))) for i in range(25)]
    out = Counter(r["doc_id"] // 100 for r in Z.scan(docs(rows)).collect() if r["n_novel"])
    assert all(out[k] >= 23 for k in range(4)), out
    plain = [(1, "token value_1_value_2_value_3_value_4_value_5_value_6_value_7_value_8_value_9")]
    assert Z.scan(docs(plain)).first()["n_novel"] == 0
