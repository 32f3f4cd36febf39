"""Conversation structure repair over a suffix-shared DAWG of role and fault signatures.

1. Every row becomes one symbol: its role (``s``, ``u``, ``a``, any other ``x``; capital if the text is
   truncated) or ``-`` if it must go (blank or a repeat). A conversation's symbols in order are its
   signature. Only ids, turns, roles and text digests are shuffled for this.
2. The distinct signatures are sorted by their ends. Neighbours share their common ending, so one pass
   builds the suffix-shared automaton (a node is an ending, minimised from the end; equivalent
   symbols are already one) and holds nothing but the nodes of the current signature. Each node
   gets, for each grammar state, the cost to the end and the first edit of the best audit. Candidates of
   a node differ in their first edit, so ties go to the least letter and no audit text is kept.
3. Plans go back to the conversations by signature. Then plan and texts of a conversation meet in one
   sorted stream, in which rows are edited and hashed one after the other. Of a conversation only its
   symbols and its audit (a letter a row) are ever held whole, never its texts.

Edits: Keep 0 (role must fit), Rerole to user/assistant 3, Delete 4 (the only one for blank and
repeated rows), Insert an empty user/assistant text 3; a truncated row that stays adds 3. The repaired
role initials are ``(s?(ua)+)?``.

Defined results: null role and text are one space; a null ``turn`` comes first; rows of one turn are
ordered by role, then by the MD5 of the text; a role without a character fits nowhere; a null
``conv_id`` is one conversation of its own; rows given twice are repeats; other columns are ignored;
an empty table gives no rows. Conversations of one signature share one plan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.llm.common import materialize, table

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3  # costs
SPACES = " \t\n\v\f\r"
NEVER = 1 << 60

# Grammar of role initials: what may come next, and the state it leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
EXPECTS = ("u", "u", "a", "u")
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ACCEPTS = (True, False, False, True)
ROLE = {"u": "user", "a": "assistant"}

Node = list[tuple[int, str, int]]  # for each state: cost to the end, first edit, state after it


def text_or_space(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(" "))


def clean(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) of conversations rows, one copy each."""
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), text_or_space("role").alias("role"),
                       text_or_space("text").alias("text"), F.lit(1).alias("copies"))


def signatures(rows: DataFrame) -> DataFrame:
    """conv_id, signature, gaps, blank, duplicate, truncated, illegal of rows(conv_id, turn, role, text, copies).

    Rows of no copies count for nothing but keep their conversation in the result.
    """
    spaces = F.lit(SPACES)
    bare = F.rtrim(F.col("text"), spaces)
    initial = F.substring("role", 1, 1)
    light = rows.select(
        "conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("digest"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        (bare == "").alias("is_blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("is_cut"),
        F.explode(F.when(F.col("copies") == 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(1), F.col("copies")))).alias("copy"),
    ).repartition("conv_id")  # the one exchange: window and collection below keep it
    alive = F.col("copy") > 0
    before = Window.partitionBy("conv_id", alive, "role", "digest").orderBy(F.col("turn").asc_nulls_first(), "copy")
    seen = light.withColumn("nth", F.row_number().over(before))
    blank = F.col("is_blank")
    again = ~blank & (F.col("nth") > 1)
    cut = ~blank & ~again & F.col("is_cut")
    symbol = F.when(blank | again, "-").when(cut, F.upper("initial")).otherwise(F.col("initial"))
    count = lambda c: F.sum(F.when(alive & c, 1).otherwise(0)).cast("long")
    # Nulls first, then the turn: collected rows sort as the texts do below.
    place = F.struct("turn", "role", "digest", "nth", symbol.alias("symbol"), "initial")
    grouped = seen.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.when(alive, place))).alias("r"),
        (F.max(F.when(alive, F.col("turn"))) - F.min(F.when(alive, F.col("turn"))) + 1).alias("span"),
        count(blank).alias("blank"), count(again).alias("duplicate"), count(cut).alias("truncated"))
    turns = F.array_distinct(F.filter(F.col("r.turn"), lambda t: t.isNotNull()))
    initials = F.array_join(F.col("r.initial"), "")
    pairs = F.greatest(F.size("r") - 1, F.lit(0)) - F.regexp_count(initials, F.lit("(?=su|ua|au)"))
    return grouped.select("conv_id", F.array_join(F.col("r.symbol"), "").alias("signature"),
                          F.coalesce(F.col("span") - F.size(turns), F.lit(0)).cast("long").alias("gaps"),
                          "blank", "duplicate", "truncated", pairs.cast("long").alias("illegal"))


def with_inserts(node: Node) -> Node:
    """Lets each state also insert the role it expects; two inserts in a row are the most that can help."""
    out = list(node)
    for state in (USER, ASSISTANT, START, SYSTEM):
        after = AFTER[EXPECTS[state]]
        source = node if state in (USER, ASSISTANT) else out
        out[state] = min(out[state], (INSERT + source[after][0], "I", after))
    return out


END: Node = with_inserts([(0 if ACCEPTS[q] else NEVER, "", q) for q in range(4)])


def node_before(symbol: str, child: Node) -> Node:
    """The node that reads ``symbol`` and goes on as ``child``."""
    node = []
    for state in range(4):
        best = (DELETE + child[state][0], "D", state)
        if symbol != "-":
            role, more = symbol.lower(), TRUNCATED if symbol.isupper() else 0
            if role == EXPECTS[state] or (role == "s" and state == START):
                best = min(best, (more + child[AFTER[role]][0], "K", AFTER[role]))
            after = AFTER[EXPECTS[state]]
            best = min(best, (REROLE + more + child[after][0], "R", after))
        node.append(best)
    return with_inserts(node)


def plans_of(sorted_signatures: Iterator[str]) -> Iterator[tuple[str, int, str]]:
    """(signature, cost, audit) of signatures sorted by their reversed text."""
    path, last = [END], ""
    for signature in sorted_signatures:
        back = signature[::-1]
        shared, most = 0, min(len(back), len(last))
        while shared < most and back[shared] == last[shared]:
            shared += 1
        del path[shared + 1:]
        for symbol in back[shared:]:
            path.append(node_before(symbol, path[-1]))
        last = back
        audit, at, state = [], len(path) - 1, START
        while path[at][state][1]:
            _, edit, state_after = path[at][state]
            audit.append(edit)
            at -= edit != "I"
            state = state_after
        yield signature, path[-1][START][0], "".join(audit)


def repair_plans(found: DataFrame) -> DataFrame:
    """signature, cost, audit for each distinct signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (s for b in batches for s in b.column(0).to_pylist())
        held, size = [], 0
        for plan in plans_of(texts):
            held.append(plan)
            size += len(plan[2])
            if size > 1 << 20 or len(held) == 4096:
                yield plan_batch(held)
                held, size = [], 0
        yield plan_batch(held)

    def plan_batch(held: list) -> pa.RecordBatch:
        cols = list(zip(*held)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())],
                                          names=["signature", "cost", "audit"])

    end_first = F.reverse("signature")
    # The automaton's order: endings that are alike lie in one partition, side by side.
    ordered = found.select("signature").distinct().repartitionByRange(end_first).sortWithinPartitions(end_first)
    return ordered.mapInArrow(run, "signature string, cost long, audit string")


def planned(rows: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    found = materialize(signatures(rows), "signatures")
    return found.join(repair_plans(found), "signature").drop("signature")


NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def one_stream(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Plan and rows of each conversation one after the other, in one partition."""
    head = plans.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
                        F.lit(None).cast("string").alias("text"), F.lit(0).alias("copies"), "audit", *NUMBERS)
    body = rows.where("copies > 0").select("conv_id", "turn", "role", "text", "copies", F.lit(None).cast("string").alias("audit"),
                                           *[F.lit(None).cast("long").alias(c) for c in NUMBERS])
    return head.union(body).repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", F.md5(F.col("text").cast("binary")))


def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict | None, tuple[str, str, str] | None]]:
    """(plan, None) at the head of each conversation, then (None, (edit, role, text)) for each row left in it."""
    audit, at, state = "", 0, START

    def inserted() -> Iterator[tuple[None, tuple[str, str, str]]]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            role = EXPECTS[state]
            yield None, ("I", ROLE[role], "")
            state, at = AFTER[role], at + 1

    for batch in batches:
        for row in batch.to_pylist():
            if row["audit"] is not None:
                yield from inserted()
                audit, at, state = row["audit"], 0, START
                yield row, None
                continue
            for _ in range(row["copies"]):
                yield from inserted()
                edit, role = audit[at], row["role"]
                at += 1
                if edit == "D":
                    continue
                if edit == "R":
                    role = ROLE[EXPECTS[state]]
                state = AFTER[role[0]]
                yield None, (edit, role, row["text"])
    yield from inserted()


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit, role, text."""
    names = ["conv_id", "place", "edit", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, place, held, size = None, 0, [], 0
        for plan, row in edits(batches):
            if plan is not None:
                conv, place = plan["conv_id"], 0
                continue
            held.append((conv, place, *row))
            place, size = place + 1, size + len(row[2])
            if size > 4 << 20:
                yield pa.RecordBatch.from_pylist([dict(zip(names, h)) for h in held], schema)
                held, size = [], 0
        yield pa.RecordBatch.from_pylist([dict(zip(names, h)) for h in held], schema)

    kind = rows.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", arrow_type(rows)), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    return one_stream(rows, planned(rows)).mapInArrow(
        run, f"conv_id {kind.simpleString()}, place long, edit string, role string, text string")


def arrow_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(rows.schema["conv_id"].dataType)


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, one row a conversation."""
    kind = arrow_type(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, sha, first, held, size = None, None, True, [], 0
        for head, row in edits(batches):
            if head is None:
                sha.update(("" if first else "\n").encode() + f"{row[1]}:{row[2]}".encode())
                first = False
                continue
            if plan is not None:
                held.append(plan | {"repaired_sha256": sha.hexdigest()})
                size += len(plan["audit"])
                if len(held) == 4096 or size > 1 << 20:
                    yield digest_batch(held)
                    held, size = [], 0
            plan, sha, first = head, hashlib.sha256(), True
        if plan is not None:
            held.append(plan | {"repaired_sha256": sha.hexdigest()})
        yield digest_batch(held)

    def digest_batch(held: list[dict]) -> pa.RecordBatch:
        types = [kind] + [pa.int64()] * len(NUMBERS) + [pa.string()] * 2
        names = ["conv_id", *NUMBERS, "audit", "repaired_sha256"]
        return pa.RecordBatch.from_arrays([pa.array([h[c] for h in held], t) for c, t in zip(names, types)], names=names)

    out = ", ".join([f"conv_id {rows.schema['conv_id'].dataType.simpleString()}", *[f"{c} long" for c in NUMBERS], "audit string, repaired_sha256 string"])
    return one_stream(rows, planned(rows)).mapInArrow(run, out)


def damaged(conversations: DataFrame) -> DataFrame:
    """The query's damage by crc32(`conv_id:turn`) % 20: 0 drops a row, 1 empties its text, 2 removes its
    ``[.!?]``, 3 gives it two copies, 4 makes it the user's."""
    kind = F.crc32(F.concat(text_or_space("conv_id"), F.lit(":"), text_or_space("turn")).cast("binary")) % 20
    rows = clean(conversations).withColumn("kind", kind)
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


def conversation_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")))


# In SQL a candidate is its cost in ten digits and its audit, so that the least text is the best candidate.
def _more(v: str, cost: int, edit: str) -> str:
    return f"(lpad(CAST(CAST({v}[1:10] AS BIGINT) + {cost} AS VARCHAR), 10, '0') || '{edit}' || {v}[11:])"


def _read(state: str, expects: str) -> str:
    kept = f"WHEN y <> '-' AND lower(y) = '{expects}' THEN CASE WHEN y = upper(y) THEN {_more('v' + expects, 3, 'K')} ELSE {_more('v' + expects, 0, 'K')} END"
    if state == "b":
        kept += f" WHEN y = 'S' THEN {_more('vs', 3, 'K')} WHEN y = 's' THEN {_more('vs', 0, 'K')}"
    changed = f"CASE WHEN y = '-' THEN '9' WHEN y = upper(y) THEN {_more('v' + expects, 6, 'R')} ELSE {_more('v' + expects, 3, 'R')} END"
    return f"least({_more('v' + state, 4, 'D')}, CASE {kept} ELSE '9' END, {changed}) AS w{state}"


SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(0, 8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v
    FROM range(0, 256) AS r(i))),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
kinds AS (
  SELECT k, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda j: CAST(ascii(k[j]) AS BIGINT)),
                            lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 20 AS kind
  FROM (SELECT DISTINCT k FROM keyed), crc_table),
rows_left AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text, copy
  FROM keyed JOIN kinds USING (k), range(1, 3) AS c(copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)),
marked AS (
  SELECT *, md5(text) AS dg, left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM rows_left),
symbols AS (
  SELECT *, bare = '' AS is_blank, bare <> '' AND nth > 1 AS is_again,
         bare <> '' AND nth = 1 AND right(bare, 1) NOT IN ('.', '!', '?') AS is_cut,
         CASE WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'x' END AS ini,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, dg, nth) AS p
  FROM marked),
lagged AS (
  SELECT *, CASE WHEN is_blank OR is_again THEN '-' WHEN is_cut THEN upper(ini) ELSE ini END AS y,
         lag(ini) OVER (PARTITION BY conv_id ORDER BY p) || ini AS pair
  FROM symbols),
convs AS (
  SELECT conv_id, string_agg(y, '' ORDER BY p) AS signature,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE is_blank) AS blank, count(*) FILTER (WHERE is_again) AS duplicate,
         count(*) FILTER (WHERE is_cut) AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM lagged GROUP BY conv_id),
steps AS (
  SELECT signature, length(signature) AS p, '0000000006II' AS vb_in, '0000000006II' AS vs, '0000000003I' AS vu, '0000000000' AS va,
         '0000000000' AS vb
  FROM (SELECT DISTINCT signature FROM convs)
  UNION ALL
  SELECT signature, p - 1, vb_in, least(ws, {_more('iu', 3, 'I')}) AS vs, iu AS vu, ia AS va, least(wb, {_more('iu', 3, 'I')}) AS vb
  FROM (SELECT *, least(wu, {_more('wa', 3, 'I')}) AS iu, least(wa, {_more('wu', 3, 'I')}) AS ia
        FROM (SELECT *, {_read('b', 'u')}, {_read('s', 'u')}, {_read('u', 'a')}, {_read('a', 'u')}
              FROM (SELECT *, signature[p] AS y FROM steps WHERE p > 0)))),
plans AS (SELECT signature, CAST(vb[1:10] AS BIGINT) AS cost, vb[11:] AS audit FROM steps WHERE p = 0),
letters AS (
  SELECT conv_id, j, audit[j] AS e, length(replace(audit[1:j], 'I', '')) AS p, length(replace(audit[1:j], 'D', '')) AS nth
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS j FROM convs JOIN plans USING (signature))),
kept AS (
  SELECT l.conv_id, l.j, l.e, l.nth, r.role, CASE WHEN l.e = 'I' THEN '' ELSE r.text END AS text,
         max(CASE WHEN l.nth = 1 AND l.e = 'K' AND r.ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS off
  FROM letters l LEFT JOIN lagged r ON l.conv_id IS NOT DISTINCT FROM r.conv_id AND l.p = r.p AND l.e <> 'I'
  WHERE l.e <> 'D'),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (nth - off) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
                             chr(10) ORDER BY j) AS body
  FROM kept GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(p.cost, 0) AS cost,
       coalesce(p.audit, '') AS audit, sha256(coalesce(t.body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN convs c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN plans p ON c.signature = p.signature
LEFT JOIN texts t ON o.conv_id IS NOT DISTINCT FROM t.conv_id
"""

QUERIES = {"op12_conversation_dawg": conversation_query}
ORACLE = {"op12_conversation_dawg": SQL}
