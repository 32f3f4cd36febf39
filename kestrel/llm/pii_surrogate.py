"""PII: keyed surrogates of detected entities.

E-mail addresses, phone numbers, card numbers, IPv4 addresses and names after a title are found in
the whole text. Each distinct entity of the corpus (its normal form) gets one surrogate of its
type, so all its mentions stay the same entity: characters are drawn from a keyed hash class by
class, with length, separators, case and script kept, country codes and reserved domains kept, a
valid card number kept valid, private addresses kept private, and given names drawn from a list of
the title's gender and the name's script.

A name is replaced word by word, each word an entity of its own (a given name with its gender, or a
family name), so "Mr John Smith", "Dr Smith" and a later "Smith" stay one person. In a text with a titled
name its words are also replaced where they stand without a title: with a capital, three letters or more
(two where the script has no capitals), unless the text has the word in lower case too. A title without
a gender takes that of the same given name in the text, if there is one.

Collision checks run over the table of all distinct entities and compare what is shown: an entity whose
surrogate equals another entity's surrogate, or any entity that occurs in the corpus, draws again; rounds
end when there is no such entity. Later draws come from larger sets (longer names and numbers; addresses
from the whole range, then from 10.0.0.0/8 for private ones, at last IPv6 addresses of the private or
the documentation range), so rounds end for any number of entities. Documents are rewritten with the
first draw computed in place; only entities that drew again are joined to the documents that mention them.

Defined results: a null text stays null with no entities; a null ``doc_id`` is kept; repeated rows
are rewritten alike; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.llm.common import materialize, row_key, table

KEY = "kestrel-surrogates"  # a parameter: production passes its own secret
KINDS = ("email", "phone", "card", "ip", "name")

EMAIL = r"(?P<email>(?<![\w.+-])[\w.+-]+@(?:[\w-]+\.)+[A-Za-z]{2,24}(?![\w-]))"
PHONE = (r"(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}(?!\d)"
         r"|(?<![\w+.-])(?:\(\d{3}\)[ ]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-]))")
CARD = r"(?P<card>(?<![\w.-])(?:\d{4}[ -]?){3}\d{4}(?![\w-]))"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IP = rf"(?P<ip>(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?![\w]|\.\d))"
# Titles by the gender that they carry (fixed values).
TITLES = {"m": ("Mr", "Herr", "M", "Monsieur", "Señor", "Sr", "г-н"), "f": ("Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Señora", "Sra", "г-жа"),
          "n": ("Dr", "Prof")}
NAME = (r"(?P<name>(?<!\w)(?:" + "|".join(t for ts in TITLES.values() for t in ts) +
        r")\.?[ ](?P<person>[^\W\d_a-zа-яѐ-џà-ÿά-ώ][^\W\d_]+(?:[ -][^\W\d_a-zа-яѐ-џà-ÿά-ώ][^\W\d_]+){0,3}))")
ENTITY = re.compile("|".join((EMAIL, PHONE, CARD, IP, NAME)))
QUICK = re.compile(r"@|\d{4}|\+\d|\d\.\d|(?:" + "|".join(t for ts in TITLES.values() for t in ts) + r")\.? ")

# Names by script and gender (fixed values).
GIVEN = {("latin", "m"): "Adam Alan Boris Carl David Edgar Felix Georg Hugo Ivan Jakob Karl Leon Marc Nils Oskar Paul Rolf Simon Viktor",
         ("latin", "f"): "Ada Berta Clara Diana Elena Frida Greta Helga Irma Julia Klara Laura Maria Nora Olga Petra Rosa Sonja Tina Vera",
         ("cyrillic", "m"): "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Олег Павел Роман Семён Юрий",
         ("greek", "m"): "Αλέξης Γιάννης Δημήτρης Ηλίας Κώστας Λευτέρης Νίκος Πέτρος Σπύρος Χρήστος",
         ("greek", "f"): "Αγγελική Βασιλική Δέσποινα Ελένη Ιωάννα Κατερίνα Μαρία Νίκη Σοφία Χριστίνα",
         ("cyrillic", "f"): "Алла Вера Галина Дарья Елена Жанна Инна Кира Лидия Мария Нина Ольга Полина Рада Юлия"}
SYLLABLES = {"latin": "ba be bo da de do ga gel ha hol ka ker la len ma mer na nor pa per ra ros sa sen ta tor va vin wa wel",
             "cyrillic": "ба бе бо ва вел га гор да ден ка кол ла лен ма мир на нов па пет ра рос са сен та тор",
             "greek": "βα γα δη δο ζα θε κα κο λα λο μα με νι πα πε ρα ρο σα σο τα τι φα χα χο",
             "cjk": "安 白 成 德 方 光 国 海 华 江 金 立 林 明 宁 平 青 山 石 天 文 新 雪 阳 云 志",
             "hangul": "가 고 기 나 도 라 마 미 보 사 서 소 수 아 영 오 우 원 유 인 정 주 진 하 현 호",
             "hiragana": "あ い う え お か き く け さ し た と な は ま み も や よ ら り わ",
             "katakana": "ア イ ウ エ オ カ キ ク ケ サ シ タ ト ナ ハ マ ミ モ ヤ ヨ ラ リ ワ"}


WORDS = re.compile(r"[^\W\d_]+")
MENTION = re.compile(r"(?<!\w)[^\W\d_a-zа-яѐ-џà-ÿά-ώ][^\W\d_]+(?:[ -][^\W\d_a-zа-яѐ-џà-ÿά-ώ][^\W\d_]+)*(?!\w)")


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, normal form) of each entity by place. A name's form lists its words' forms (``parts``)."""
    if not QUICK.search(text):
        return []
    out, people = [], []
    for m in ENTITY.finditer(text):
        kind = next(k for k in KINDS if m.group(k) is not None)
        if kind == "name":
            title = m.group("name")[:m.start("person") - m.start()].rstrip(". ")
            people.append((*m.span("person"), next(g for g, ts in TITLES.items() if title in ts)))
        else:
            whole = m.group(kind)
            norm = whole.lower() if kind == "email" else whole if kind == "ip" else re.sub(r"[^\d+]", "", whole)
            if kind == "phone" and not norm.startswith("+"):
                norm = "+1" + norm
            out.append((*m.span(kind), kind, norm))
    if people:
        out = sorted(out + named(text, people, [x[:2] for x in out]))
    return out


def named(text: str, people: list[tuple[int, int, str]], taken: list[tuple[int, int]]) -> list[tuple[int, int, str, str]]:
    """The names after a title, and their words without one in the rest of the text."""
    genders: dict[str, str] = {}  # of given names
    words = set()
    for s, e, gender in people:
        first, *rest = text[s:e].split(" ")
        words |= {w.group().casefold() for w in WORDS.finditer(text, s, e)}
        for w in first.split("-") if rest else []:
            if genders.get(w.casefold(), "n") == "n":
                genders[w.casefold()] = gender
    out = []
    for s, e, gender in people:
        first, *rest = text[s:e].split(" ")
        given = {w.casefold() for w in first.split("-")} if rest else set()
        forms = [part(w, (gender if gender != "n" else genders[w]) if w in given and i < len(given) else "")
                 for i, w in enumerate(x.group().casefold() for x in WORDS.finditer(text, s, e))]
        out.append((s, e, "name", " ".join(forms)))
    small = {w.group() for w in WORDS.finditer(text) if w.group().casefold() in words and w.group()[0].islower()}
    low = {w.casefold() for w in small}
    known = {w for w in words if w not in low and len(w) >= (3 if w[0].islower() else 2)}
    spans = sorted(taken + [x[:2] for x in out])
    at = 0
    for m in MENTION.finditer(text) if known else ():
        while at < len(spans) and spans[at][1] <= m.start():
            at += 1
        if at < len(spans) and spans[at][0] < m.end():
            continue
        run: list[tuple[int, int, str]] = []
        for w in [*WORDS.finditer(text, m.start(), m.end()), None]:
            if w is not None and w.group().casefold() in known:
                run.append((*w.span(), part(w.group().casefold(), genders.get(w.group().casefold(), ""))))
            elif run:
                out.append((run[0][0], run[-1][1], "name", " ".join(x[2] for x in run)))
                run = []
    return out


def part(word: str, gender: str) -> str:
    """The normal form of one word of a name: given names carry a gender."""
    return f"{gender}:{script(word)}:{word}"


def parts(kind: str, norm: str) -> list[str]:
    return norm.split(" ") if kind == "name" else [norm]


def script(word: str) -> str:
    """latin, cyrillic, greek, cjk ...: the first word of the first letter's Unicode name."""
    return unicodedata.name(word[0], "other").split(" ")[0].lower()


@cache
def syllables(way: str, sample: str) -> list[str]:
    """What names of a script are made of: a list, or else the letters near one of the name's."""
    if way in SYLLABLES:
        return SYLLABLES[way].split()
    low = ord(sample) & ~0x7F
    return [chr(c) for c in range(low, low + 0x80) if chr(c).isalpha() and script(chr(c)) == way and chr(c) == chr(c).casefold()] or [sample]


class Stream:
    """Numbers drawn from a keyed hash of (kind, entity, attempt)."""

    def __init__(self, key: str, *what):
        self.seed, self.at, self.pool = "\x00".join(map(str, what)).encode(), 0, 0
        self.key, self.left = key.encode(), 0

    def below(self, n: int) -> int:
        if self.left < 4:
            self.pool = int.from_bytes(hmac.new(self.key, self.seed + self.at.to_bytes(4, "big"), hashlib.sha256).digest(), "big")
            self.at, self.left = self.at + 1, 32
        value = (self.pool & 0xFFFFFFFF) * n >> 32
        self.pool, self.left = self.pool >> 32, self.left - 4
        return value


def luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10


def alike(chars: str, s: Stream) -> str:
    """Each letter or digit replaced by one of its class; other characters stay."""
    out = []
    for c in chars:
        if c.isdigit():
            out.append(str(s.below(10)))
        elif "a" <= c <= "z":
            out.append(chr(97 + s.below(26)))
        elif "а" <= c <= "я":
            out.append(chr(ord("а") + s.below(32)))
        elif c.isalpha():
            out.append("àáâäçèéêëíñóôöùúûüß"[s.below(19)])
        else:
            out.append(c)
    return "".join(out)


def address(norm: str, attempt: int, s: Stream) -> str:
    """Octets of as many digits first, then any, then any private address, at last IPv6."""
    a, b, *_ = old = norm.split(".")
    keep = 1 if a in ("10", "127") else 2 if (a, b) in (("192", "168"), ("169", "254")) or a == "172" and 16 <= int(b) < 32 else 0
    if attempt >= 6:
        head = ["fd00"] if keep else ["2001", "db8"]
        return ":".join(head + [format(s.below(65536), "x") for _ in range(8 - len(head))])
    if attempt >= 4 and keep == 2:
        old, keep = ["10", *old[1:]], 1
    span = {1: (0, 10), 2: (10, 100), 3: (100, 256)}
    while True:
        new = [lo + s.below(hi - lo) for lo, hi in (span[len(p)] if attempt < 2 else (0, 256) for p in old[keep:])]
        if keep or new[0] < 224 and new[0] not in (0, 10, 127, 169, 172, 192):
            return ".".join([*old[:keep], *map(str, new)])


def surrogate(key: str, kind: str, norm: str, attempt: int) -> str:
    """What is shown for an entity, in its normal form."""
    s, extra = Stream(key, kind, norm, attempt), max(0, attempt - 1)
    if kind == "email":
        local, domain = norm.split("@")
        labels = domain.split(".")
        fixed = 2 if labels[-2] == "example" else 1  # reserved domains and the top level stay
        d = Stream(key, "domain", domain)
        host = ".".join([alike(x, d) for x in labels[:-fixed]] + labels[-fixed:])
        return alike(local + "0" * extra, s) + "@" + host
    if kind == "phone":
        code = 1 + (len(norm) - 1) % 10 if len(norm) > 11 else 2  # + and the country code
        return norm[:code] + alike(norm[code:] + "0" * extra, s)
    if kind == "card":
        body = norm[0] + alike(norm[1:-1] + "0" * extra, s)
        check = (10 - luhn(body + "0")) % 10
        return body + str(check if luhn(norm) == 0 else (check + 1 + s.below(9)) % 10)
    if kind == "ip":
        return address(norm, attempt, s)
    gender, way, word = norm.split(":", 2)
    pieces = syllables(way, word[0])
    more = lambda n: "".join(pieces[s.below(len(pieces))] for _ in range(n))
    lists = [x for (w, g), names in GIVEN.items() if gender and w == way and gender in (g, "n") for x in names.split()]
    short = way in ("cjk", "hangul")  # a syllable a character
    return (lists[s.below(len(lists))].casefold() + more(attempt) if lists else more((min(len(word), 3) if short else 3) + attempt))


def rendered(original: str, kind: str, forms: list[str]) -> str:
    """Surrogates in the layout of one mention: separators, case, capitals."""
    if kind == "name":
        left = iter(forms)
        word = lambda x, upper: x.upper() if upper else re.sub("σ$", "ς", x.title())
        return WORDS.sub(lambda m: word(next(left), m.group().isupper()), original)
    form = forms[0]
    if kind == "email":
        return "".join(c.upper() if i < len(original) and original[i].isupper() else c for i, c in enumerate(form))
    if kind == "ip":
        return form
    digits = iter(form.lstrip("+")[1 if kind == "phone" and not original.startswith("+") else 0:])
    out = "".join(next(digits) if c.isdigit() else c for c in original)
    return out + "".join(digits)


def detected(docs: DataFrame) -> DataFrame:
    """(row, kind, norm): the distinct entities of each document; of names, their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r, k, n) for r, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if t
                    for k, n in sorted({(k, n) for _, _, k, whole in entities(t) for n in parts(k, whole)})]
            for at in range(0, len(rows), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in zip(*rows[at:at + 20_000])],
                                                 names=["row", "kind", "norm"])

    return docs.select(row_key("doc_id", "text").alias("row"), "text").mapInArrow(run, "row string, kind string, norm string")


def drawn(pairs: DataFrame, key: str) -> DataFrame:
    """(kind, norm, attempt, form) from (kind, norm, attempt)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([surrogate(key, *r) for r in zip(*cols)], pa.string())],
                                             names=["kind", "norm", "attempt", "form"])

    return pairs.select("kind", "norm", "attempt").mapInArrow(run, "kind string, norm string, attempt int, form string")


def distinct_surrogates(found: DataFrame, key: str) -> DataFrame:
    """(kind, norm, attempt, form): one surrogate for each distinct entity, none of them shared or an entity itself."""
    known = materialize(found.select("kind", "norm").distinct(), "pii-entities")
    shown = known.select("kind", F.when(F.col("kind") == "name", F.substring_index("norm", ":", -1)).otherwise(F.col("norm")).alias("form")).distinct()
    forms = materialize(drawn(known.withColumn("attempt", F.lit(0)), key), "pii-forms")
    while True:
        order = Window.partitionBy("kind", "form").orderBy("attempt", "norm")
        real = shown.withColumn("real", F.lit(True))
        marked = (forms.withColumn("place", F.row_number().over(order)).join(real, ["kind", "form"], "left")
                  .withColumn("again", (F.col("place") > 1) | F.col("real").isNotNull()))
        again = materialize(marked.where("again").select("kind", "norm", (F.col("attempt") + 1).alias("attempt")), "pii-again")
        if again.isEmpty():
            return forms
        settled = marked.where("not again").select("kind", "norm", "attempt", "form")
        forms = materialize(settled.unionByName(drawn(again, key)), "pii-forms")


def replaced(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, text with surrogates, n_entities, one count by kind, and spans of the input, for each row."""
    found = materialize(detected(docs), "pii-found")
    forms = distinct_surrogates(found, key)
    redrawn = (found.join(forms.where("attempt > 0"), ["kind", "norm"]).groupBy("row")
               .agg(F.collect_list(F.concat_ws("\x01", "kind", "norm", "form")).alias("own")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if forms.where("attempt > 0").isEmpty():  # nothing to look up
        rows = rows.withColumn("own", F.lit(None).cast("array<string>"))
    else:
        rows = rows.withColumn("row", row_key("doc_id", "text")).join(redrawn.dropDuplicates(["row"]), "row", "left").drop("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[tuple[str, str], str] = {}
        for batch in batches:
            out = []
            for text, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                changed = {tuple(x[:2]): x[2] for x in (o.split("\x01") for o in own or [])}
                spans = entities(text) if text else []
                pieces, at = [], 0
                for s, e, kind, norm in spans:
                    shown = []
                    for p in parts(kind, norm):
                        form = changed.get((kind, p)) or memory.get((kind, p))
                        if form is None:
                            if len(memory) > 100_000:
                                memory.clear()
                            form = memory[kind, p] = surrogate(key, kind, p, 0)
                        shown.append(form)
                    pieces += [text[at:s], rendered(text[s:e], kind, shown)]
                    at = e
                n = [sum(x[2] == k for x in spans) for k in KINDS]
                out.append((None if text is None else "".join(pieces) + text[at:], len(spans), *n,
                            ",".join(f"{k}:{s}:{e}" for s, e, k, _ in spans)))
            kinds = [pa.string()] + [pa.int64()] * (1 + len(KINDS)) + [pa.string()]
            cols = list(zip(*out)) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(list(c), t) for c, t in zip(cols, kinds)]],
                                             names=["doc_id", "text", "n_entities", *[f"n_{k}" for k in KINDS], "spans"])

    return rows.select("doc_id", "text", "own").mapInArrow(
        run, "doc_id long, text string, n_entities long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", spans string")


def surrogate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replaced(table(spark, sf_dir, "documents"))


QUERIES = {"op8_pii_surrogates": surrogate_query}
ORACLE: dict[str, str] = {}
