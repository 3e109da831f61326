"""Operator 11: repair of the structure of conversations by the cheapest edits.

The rows of a conversation, in order, and the state of what has been kept so far (nothing, a system turn, a user turn, an
assistant turn) are the nodes of a lattice; keeping, giving another role, deleting and inserting are its edges. Dijkstra's
search runs from both ends: a forward heap and a reverse heap meet, both go on until no crossing of the same cost can be
missing, and of all crossings the one whose audit, forward and reverse part together, is least is taken.

A conversation may hold a third of all rows. So the lattice is cut into segments of a bounded number of rows: each gives
the cheapest audit between any two states, and a lattice over such tables, a bounded number at a time, is searched in the
same way until one table is left. Cheapest audits between two nodes are never prefixes of each other (the letters say the
path, and a longer one costs more), so the least parts make the least whole.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import need, ranked, staged, table

#: States: nothing kept, after system, after user, after assistant. What may follow, and the state that it leads to.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {EMPTY: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: A conversation ends with nothing kept, or after an assistant.
ENDS = (EMPTY, ASSISTANT)
RENAMED = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows of a segment, and tables that are put together at a time.
SEGMENT, FAN = 256, 32
MEMO_ENTRIES = 50_000
#: A row as a letter: its role's initial (x for any other), upper case if truncated; digits for those to delete.
INITIALS, DELETED = "suax", "0123"

Edge = tuple[int, int, str]


def given(state: int) -> str:
    """The role's initial that a row or an insertion can be given in a state: user, or assistant after a user."""
    return "a" if state == USER else "u"


@lru_cache(maxsize=None)
def step(letter: str) -> dict[int, list[Edge]]:
    """From each state the edges over one row: state, cost, audit."""
    out: dict[int, list[Edge]] = {}
    for state, follows in FOLLOWS.items():
        out[state] = [(state, DELETE, "D")]
        if letter not in DELETED:
            more = TRUNCATED if letter.isupper() else 0
            out[state].append((follows[given(state)], REROLE + more, "R"))
            if letter.lower() in follows:
                out[state].append((follows[letter.lower()], more, "K"))
    return out


def cheapest(steps: list[dict[int, list[Edge]]], inserting: bool, start: int, goals: Iterable[int]) -> tuple[int, str] | None:
    """Cost and least audit from the start state before the first step to a goal state behind the last; None if there is no way.

    Nodes are (steps done, state). A step leads to the next number; insertions, where they are left to make, stay at it.
    """
    last = len(steps)
    back: list[dict[int, list[Edge]]] = [{} for _ in range(last)]
    for n, edges in enumerate(steps):
        for a, out in edges.items():
            for b, cost, audit in out:
                back[n].setdefault(b, []).append((a, cost, audit))
    inserts = {a: (FOLLOWS[a][given(a)], INSERT, "I") for a in FOLLOWS} if inserting else {}
    before: dict[int, list[Edge]] = {}
    for a, (b, cost, audit) in inserts.items():
        before.setdefault(b, []).append((a, cost, audit))

    def onward(n: int, a: int) -> Iterator[tuple[int, int, int, str]]:
        if n < last:
            for b, cost, audit in steps[n].get(a, ()):
                yield n + 1, b, cost, audit
        if a in inserts:
            yield n, *inserts[a]

    def backward(n: int, b: int) -> Iterator[tuple[int, int, int, str]]:
        if n:
            for a, cost, audit in back[n - 1].get(b, ()):
                yield n - 1, a, cost, audit
        for a, cost, audit in before.get(b, ()):
            yield n, a, cost, audit

    # Forward labels are (cost, audit): an audit grows at its end, so labels never fall along a path, and the first one taken
    # from the heap is a node's least. Reverse audits grow at their front; among equal costs later numbers are taken
    # first, so that all that lead to a label are settled before it is (edges of cost nothing lead to the next number).
    ahead: dict[tuple[int, int], tuple[int, str]] = {}
    behind: dict[tuple[int, int], tuple[int, str]] = {}
    forward, reverse = [(0, "", 0, start)], [(0, -last, g) for g in goals]
    label = {(last, g): (0, "") for g in goals}
    best = float("inf")

    def settle_ahead() -> None:
        nonlocal best
        cost, audit, n, a = heapq.heappop(forward)
        if (n, a) in ahead:
            return
        ahead[n, a] = (cost, audit)
        for m, b, c, more in onward(n, a):
            if (m, b) in behind:
                best = min(best, cost + c + behind[m, b][0])
            if (m, b) not in ahead:
                heapq.heappush(forward, (cost + c, audit + more, m, b))

    def settle_behind() -> None:
        nonlocal best
        _, n, b = heapq.heappop(reverse)
        if (-n, b) in behind:
            return
        behind[-n, b] = cost, audit = label[-n, b]
        for m, a, c, more in backward(-n, b):
            if (m, a) in ahead:
                best = min(best, ahead[m, a][0] + c + cost)
            if (m, a) not in behind:
                new, old = (cost + c, more + audit), label.get((m, a))
                if old is None or new < old:
                    label[m, a] = new
                    if old is None or new[0] < old[0]:
                        heapq.heappush(reverse, (new[0], -m, a))

    # Both ends are settled at once, so a search that runs dry on one side has met the other.
    settle_ahead()
    for _ in goals:
        settle_behind()
    while forward and reverse and forward[0][0] + reverse[0][0] <= best:
        settle_ahead() if forward[0][0] < reverse[0][0] else settle_behind()
    crossings = [
        audit + more + behind[m, b][1]
        for (n, a), (cost, audit) in ahead.items()
        for m, b, c, more in onward(n, a)
        if (m, b) in behind and cost + c + behind[m, b][0] == best
    ]
    return (int(best), min(crossings)) if crossings else None


STATES = range(len(FOLLOWS))
Found = dict[tuple[int, int], tuple[int, str]]


def spanned(steps: list[dict[int, list[Edge]]], inserting: bool, whole: bool) -> Found:
    """The cheapest audit between any two states; for a whole conversation that from nothing to an end only."""
    if whole:
        end = cheapest(steps, inserting, EMPTY, ENDS)
        return {(EMPTY, EMPTY): end} if end else {}
    return {(a, b): x for a in STATES for b in STATES if (x := cheapest(steps, inserting, a, (b,)))}


def edits(audit: str) -> Iterator[tuple[int, str, str | None]]:
    """(row from 0, or for an insertion the row behind it; letter; the role given, None for kept and deleted rows).

    What is left of a conversation is pairs of user and assistant, behind a system turn if their number is odd, so the
    place of a row in it says the role.
    """
    row, place = 0, -((len(audit) - audit.count("D")) % 2)
    for letter in audit:
        yield row, letter, RENAMED["ua"[place % 2]] if letter in "RI" else None
        place += letter != "D"
        row += letter != "I"


def illegal(letters: str) -> int:
    return sum(letters[k : k + 2] not in LEGAL for k in range(len(letters) - 1))


def _searched(codes: list[str], alone: list[bool]) -> list[tuple[list[int], list[int], list[str]]]:
    """Of each segment the found ways: places (from * states + to), costs, audits."""
    memo: dict[tuple[str, bool], tuple] = {}
    out = []
    for key in zip(codes, alone):
        if key not in memo:
            if len(memo) > MEMO_ENTRIES:
                memo.clear()
            memo[key] = _flat(spanned([step(x) for x in key[0]], True, key[1]))
        out.append(memo[key])
    return out


def _flat(found: Found) -> tuple[list[int], list[int], list[str]]:
    items = sorted(found.items())
    return [a * len(STATES) + b for (a, b), _ in items], [x[0] for _, x in items], [x[1] for _, x in items]


def _steps(places: list[int], costs: list[int], audits: list[str]) -> dict[int, list[Edge]]:
    out: dict[int, list[Edge]] = {}
    for p, cost, audit in zip(places, costs, audits):
        out.setdefault(p // len(STATES), []).append((p % len(STATES), cost, audit))
    return out


def _segments(id_type: T.DataType) -> T.StructType:
    """conv, at (number of the segment or table), of (how many there are), ways, and what is needed to count illegal neighbours."""
    L, S = T.LongType(), T.StringType()
    kinds = (("conv", id_type), ("at", L), ("of", L), ("places", T.ArrayType(L)), ("costs", T.ArrayType(L)), ("audits", T.ArrayType(S)), ("illegal", L), ("head", S), ("tail", S))
    return T.StructType([T.StructField(*x) for x in kinds])


def solved(segments: DataFrame) -> DataFrame:
    """segments: conv, at, of, code (a letter a row). Gives conv, cost, audit, illegal."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = _segments(segments.schema["conv"].dataType)
    names, arrow = schema.names, to_arrow_schema(schema)
    plain = str.maketrans(DELETED + INITIALS.upper(), INITIALS * 2)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, codes = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            letters = [c.translate(plain) for c in codes]
            ways = list(zip(*_searched(codes, [n == 1 for n in of]))) or [(), (), ()]
            columns = [*batch.columns[:3], *ways, [illegal(x) for x in letters], [x[0] for x in letters], [x[-1] for x in letters]]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)

    def joined(tables: pa.Table) -> pa.Table:
        """Up to FAN neighbouring tables of one conversation."""
        rows = sorted(tables.to_pylist(), key=lambda r: r["at"])
        whole = rows[0]["of"] <= FAN
        ways = _flat(spanned([_steps(r["places"], r["costs"], r["audits"]) for r in rows], False, whole))
        bad = sum(r["illegal"] for r in rows) + sum(a["tail"] + b["head"] not in LEGAL for a, b in zip(rows, rows[1:]))
        out = (rows[0]["conv"], rows[0]["at"] // FAN, -(-rows[0]["of"] // FAN), *ways, bad, rows[0]["head"], rows[-1]["tail"])
        return pa.Table.from_pylist([dict(zip(names, out))], schema=arrow)

    # Segments of a conversation that all others outweigh lie in many tasks.
    tables = staged(segments.select("conv", "at", "of", "code").mapInArrow(search, schema), "segments")
    done, most = tables.filter("of = 1"), tables.agg(F.max("of")).first()[0] or 1
    while most > 1:
        tables = staged(tables.filter("of > 1").withColumn("up", F.floor(F.col("at") / FAN)).groupBy("conv", "up").applyInArrow(lambda t: joined(t.drop_columns("up")), schema), "segments")
        done, most = done.unionByName(tables.filter("of = 1")), -(-most // FAN)
    return done.select("conv", F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"), "illegal")


@dataclass(frozen=True)
class Repaired:
    """facts: conv, gaps, blank, duplicate, truncated, illegal, cost, audit. rows: conv, n (order), role, text of what is left and inserted."""

    facts: DataFrame
    rows: DataFrame


BLANKS = r"\x20\x09-\x0D"


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", tie: str | None = None) -> Repaired:
    """Faults of every conversation, the cheapest edits to `(s?(ua)+)?`, and the conversation after them.

    A null role or text counts as one space; rows of null id are a conversation of their own. Rows go by turn, nulls
    first, then role, text and tie. Other columns are left out, so their names can't clash. An empty table gives empty ones. A
    long text moves in sorts and joins only. A conversation's audit is one value, so it must fit into one row.
    """
    need(turns, [conv, turn, role, text])
    blank_text = lambda c: F.coalesce(F.col(c), F.lit(" "))
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), blank_text(role).alias("role"), blank_text(text).alias("text"), (F.col(tie) if tie else F.lit(0)).alias("tie"))
    rows = staged(ranked(rows, ["conv"], ["turn", "role", "text", "tie"], "turns").drop("tie"), "turns-ranked")
    same = F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text"), 256)
    firsts = rows.groupBy(F.col("conv").alias("fc"), same.alias("h")).agg(F.min("pos").alias("fp"))  # the first of equal rows, known by its place
    blank = ~F.col("text").rlike(f"[^{BLANKS}]")
    fault = F.when(blank, "blank").when(F.col("fp").isNull(), "duplicate").when(~F.col("text").rlike(rf"[.!?][{BLANKS}]*\z"), "truncated")
    initial = F.substring("role", 1, 1)
    number = F.when(initial.isin(*INITIALS[:3]), F.instr(F.lit(INITIALS), initial)).otherwise(len(INITIALS)).cast("int")
    letter = F.substring(F.when(F.col("fault").isin("blank", "duplicate"), DELETED).when(F.col("fault") == "truncated", INITIALS.upper()).otherwise(INITIALS), number, F.lit(1))
    known = rows.join(firsts.select("fc", "fp"), F.col("conv").eqNullSafe(F.col("fc")) & (F.col("pos") == F.col("fp")), "left")
    known = staged(known.select("conv", "turn", "pos", "size", "role", fault.alias("fault")).select("conv", "turn", "pos", "size", "fault", letter.alias("letter")), "faults")

    counts = [F.count_if(F.col("fault") == x).alias(x) for x in ("blank", "duplicate", "truncated")]
    spread = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    gaps = known.groupBy("conv", "turn").agg(*counts).groupBy("conv").agg(F.coalesce(spread, F.lit(0)).cast("long").alias("gaps"), *[F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated")])
    code = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "letter"))), lambda x: x["letter"]), "")  # SEGMENT rows at most
    segments = known.groupBy("conv", F.floor(F.col("pos") / SEGMENT).alias("at")).agg(F.ceil(F.first("size") / SEGMENT).alias("of"), code.alias("code"))
    found = staged(solved(segments).withColumnRenamed("conv", "sc"), "audits")
    facts = gaps.join(found, F.col("conv").eqNullSafe(F.col("sc"))).drop("sc")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, audit in zip(batch.column(0), batch.column(1).to_pylist()):
                held = [(n, row, letter, given_) for n, (row, letter, given_) in enumerate(edits(audit)) if letter != "D"]
                for k in range(0, len(held), 1 << 14):
                    part = held[k : k + (1 << 14)]
                    yield pa.RecordBatch.from_arrays([pa.array([own.as_py()] * len(part), own.type), *[pa.array(list(c), t) for c, t in zip(zip(*part), (pa.int64(), pa.int64(), pa.string(), pa.string()))]], ["ec", "n", "row", "letter", "given"])

    kind = T.StructType([T.StructField("ec", rows.schema["conv"].dataType), *[T.StructField(x, T.LongType()) for x in ("n", "row")], *[T.StructField(x, T.StringType()) for x in ("letter", "given")]])
    spelt = found.select("sc", "audit").mapInArrow(spell, kind)
    kept = spelt.filter("letter <> 'I'").join(rows, F.col("ec").eqNullSafe(F.col("conv")) & (F.col("row") == F.col("pos")))
    left = kept.select("conv", "n", F.coalesce("given", "role").alias("role"), "text")
    return Repaired(facts, left.unionByName(spelt.filter("letter = 'I'").select(F.col("ec").alias("conv"), "n", F.col("given").alias("role"), F.lit("").alias("text"))))


def digests(rows: DataFrame) -> DataFrame:
    """conv, sha256 of its `role:text` lines. A digest takes its bytes one after the other, so a conversation streams through one task, which holds a batch."""
    schema = T.StructType([T.StructField("conv", rows.schema["conv"].dataType), T.StructField("sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, kind = None, None, None
        give = lambda: pa.RecordBatch.from_arrays([pa.array([now[0]], kind), pa.array([own.hexdigest()])], ["conv", "sha256"])
        for batch in batches:
            kind = batch.schema.field(0).type
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if now == (conv,):
                    own.update(b"\n")
                else:
                    if now:
                        yield give()
                    now, own = (conv,), hashlib.sha256()
                own.update(line)
        if now:
            yield give()

    lines = rows.repartition("conv").sortWithinPartitions("conv", "n").select("conv", F.concat("role", F.lit(":"), "text").cast("binary").alias("line"))
    return lines.mapInArrow(run, schema)


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copy: rows dropped, emptied, without ends of sentences, repeated or given to the user, by a checksum of `conv_id:turn`."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", one("conv_id"), one("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", one("role").alias("role"), one("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of conversations, after damage. Nulls count as one space, a null id is a conversation of its own, rows
    of equal turn go by role and text, repeated rows are duplicates. A conversation of which nothing is left has zeros. An
    empty table gives an empty one. Long texts stream through the task that hashes them."""
    turns = table(spark, sf_dir, "conversations")
    done = repair(damaged(turns), tie="copy")
    ids = turns.select(F.col("conv_id")).distinct()
    hashes = digests(done.rows).withColumnRenamed("conv", "hc")
    out = ids.join(done.facts, F.col("conv_id").eqNullSafe(F.col("conv")), "left").join(hashes, F.col("conv_id").eqNullSafe(F.col("hc")), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select("conv_id", *[F.coalesce(x, F.lit(0)).cast("long").alias(x) for x in numbers], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _sql() -> str:
    """The same in SQL: states carried row by row, each with cost, audit and lines; ties by the audit."""
    crc = "xor((SELECT list_reduce(list_prepend(4294967295, b), lambda x, y: xor(x >> 8, tab[(xor(x, y) & 255) + 1])) FROM tb), 4294967295)"
    more = lambda s, cost, letter: f"CASE WHEN {s} IS NOT NULL THEN struct_pack(c := {s}.c + {cost}, a := {s}.a || '{letter}', o := {s}.o) END"
    put = lambda s, cost, letter, line: f"CASE WHEN {s} IS NOT NULL THEN struct_pack(c := {s}.c + {cost}, a := {s}.a || '{letter}', o := list_append({s}.o, {line})) END"
    least = lambda *x: f"list_sort(list_filter([{', '.join(x)}], lambda v: v IS NOT NULL))[1]"
    drop = lambda k: more(f"w.s{k}", 4, "D")
    keep = lambda k, i: f"CASE WHEN NOT f.gone AND f.i = '{i}' THEN {put(f'w.s{k}', 'f.t', 'K', 'f.role || chr(58) || f.text')} END"
    role = lambda k, r: f"CASE WHEN NOT f.gone THEN {put(f'w.s{k}', '3 + f.t', 'R', f'{r!r} || chr(58) || f.text')} END"
    ins = lambda s, r: put(s, 3, "I", f"'{r}:'")
    none = "CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR[]))"
    return rf"""WITH RECURSIVE
tb AS (SELECT list(list_reduce(list_prepend(k, [1, 2, 3, 4, 5, 6, 7, 8]), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY k) AS tab FROM generate_series(0::BIGINT, 255) AS g(k)),
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
e AS (SELECT *, {crc} % 20 AS kind FROM (SELECT *, list_transform(range(1, length(k) + 1), lambda j: ascii(substring(k, j, 1))::BIGINT) AS b FROM c)),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM e WHERE kind <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS p FROM d),
h AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS fault, lag(role) OVER (PARTITION BY conv_id ORDER BY p) AS prior FROM r),
f AS (SELECT conv_id, p, role, text, substring(role, 1, 1) AS i, coalesce(fault IN ('blank', 'duplicate'), false) AS gone, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS t FROM h),
w AS (SELECT conv_id, 0::BIGINT AS p, struct_pack(c := 0::BIGINT, a := '', o := []::VARCHAR[]) AS s0, {none} AS s1, struct_pack(c := 3::BIGINT, a := 'I', o := ['user:']) AS s2, struct_pack(c := 6::BIGINT, a := 'II', o := ['user:', 'assistant:']) AS s3 FROM (SELECT DISTINCT conv_id FROM f)
UNION ALL SELECT conv_id, p, s0, s1, m2, {least('n3', ins('m2', 'assistant'))} FROM (
SELECT *, {least('n2', ins('s0', 'user'), ins('s1', 'user'), ins('n3', 'user'))} AS m2 FROM (
SELECT w.conv_id, f.p, {drop(0)} AS s0, {least(drop(1), keep(0, 's'))} AS s1,
{least(drop(2), *[keep(k, 'u') for k in (0, 1, 3)], *[role(k, 'user') for k in (0, 1, 3)])} AS n2,
{least(drop(3), keep(2, 'a'), role(2, 'assistant'))} AS n3 FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.p = w.p + 1))),
z AS (SELECT conv_id, {least('s0', 's3')} AS best FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY p DESC) AS last FROM w) WHERE last = 1),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
count_if(prior IS NOT NULL AND substring(prior, 1, 1) || substring(role, 1, 1) NOT IN ('su', 'ua', 'au')) AS illegal FROM h GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM o.conv_id"""


OP11_SQL = _sql()
