"""Conversation structure repair: the cheapest edits that make a dialogue legal.

A legal dialogue is empty, or an optional system row and then one or more pairs
of a user and an assistant row. Every row is kept, given another role or deleted,
and empty rows may be inserted; the cheapest edits win, and among equally cheap
ones the ASCII-least audit (the edits' initials in order).

Scalar big-integer weights decide both at once: a path through the DAG of (row,
role state) nodes weighs ``cost * BASE**width`` plus its audit letters as
fixed-width positional digits, first letter highest, zero digits after the end.
Comparing two integers then compares costs first and audits next, a shorter
audit before its extensions, and the plain minimum over integers is the answer.
Putting an edit before a path is ``letter * BASE**(width-1) + digits // BASE``.

Long conversations are decided in blocks of rows, so that the integers stay
short. Rows inserted before a row belong to that row's block, so within a block
no audit is the beginning of another one, and the first differing letter lies
inside the block: the costs to go from the block's end, found by the same DP
with no digits, are all that is needed from later blocks.

Texts never meet in memory. They are ordered by Spark (the sorts spill), only a
row's pattern (a few bytes) is gathered by conversation, and the repaired text
is hashed while the ordered rows stream past the plan. The rows of one
conversation are read by one task, as its digest is one sequential hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerly.llm.common import flatten, stored

# Costs of the edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
# Pairs of neighbouring role initials that are legal.
LEGAL_PAIRS = ("su", "ua", "au")
#: Audit letters as digits, in ASCII order; 0 is the padding.
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
BASE = 8
#: Rows decided by one run of the DP with digits.
BLOCK_ROWS = 64

# Role states: nothing yet, after system, after user, after assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: state -> {role initial that may follow: the state after it}
FOLLOWS = {NOTHING: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER},
           USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
FINAL = (NOTHING, ASSISTANT)
ROLE = {"s": "system", "u": "user", "a": "assistant"}


def row_edits(state: int, role: str, must_go: bool, truncated: bool):
    """Edits of one row: (letter, cost, state after it, role of the row or "")."""
    yield "D", DELETE, state, ""
    if not must_go:
        extra = TRUNCATED if truncated else 0
        if role in FOLLOWS[state]:
            yield "K", KEEP + extra, FOLLOWS[state][role], role
        for new in ("u", "a"):
            if new in FOLLOWS[state]:
                yield "R", REROLE + extra, FOLLOWS[state][new], new


def insertions(state: int):
    """Edits that add a row: (letter, cost, state after it, role)."""
    for new in ("u", "a"):
        if new in FOLLOWS[state]:
            yield "I", INSERT, FOLLOWS[state][new], new


def _solve(rows: list[tuple[str, bool, bool]], after: dict[int, int], last: bool,
           digits: int) -> list[dict[int, tuple[int, tuple | None]]]:
    """Weights of the best paths from every (row, state) node to the end of the
    block, each with its first edit (letter, role, next row, next state).

    ``after`` has the costs to go from the block's end; ``last`` allows rows to
    be inserted there. ``digits`` 0 gives costs alone."""
    high = BASE ** digits
    first = high // BASE

    def ahead(weight: int, letter: str, cost: int) -> int:
        rest, tail = divmod(weight, high)
        return (rest + cost) * high + (DIGIT[letter] * first if digits else 0) + tail // BASE

    def with_insertions(best: dict[int, tuple[int, tuple | None]], at: int) -> None:
        # Rows inserted before an edit or at the end; as every insertion costs,
        # as many sweeps as states reach all that can win.
        for _ in FOLLOWS:
            changed = False
            for state in FOLLOWS:
                for letter, cost, then, role in insertions(state):
                    if then in best:
                        w = ahead(best[then][0], letter, cost)
                        if state not in best or w < best[state][0]:
                            best[state] = (w, (letter, role, at, then))
                            changed = True
            if not changed:
                break

    nodes = [{} for _ in range(len(rows) + 1)]
    nodes[-1] = {s: (c * high, None) for s, c in after.items()}
    if last:
        with_insertions(nodes[-1], len(rows))
    for at in range(len(rows) - 1, -1, -1):
        role, must_go, truncated = rows[at]
        for state in FOLLOWS:
            for letter, cost, then, new in row_edits(state, role, must_go, truncated):
                if then in nodes[at + 1]:
                    w = ahead(nodes[at + 1][then][0], letter, cost)
                    if state not in nodes[at] or w < nodes[at][state][0]:
                        nodes[at][state] = (w, (letter, new, at + 1, then))
        with_insertions(nodes[at], at)
    return nodes


def repair(rows: list[tuple[str, bool, bool]], block: int = BLOCK_ROWS) -> tuple[int, str, list[str], str]:
    """Rows as (role initial, must be deleted, truncated) -> cost, audit, the
    plan of every row, and the roles inserted after the last row. A row's plan is
    the roles inserted before it and then ``-`` (deleted), ``=`` (kept) or its
    new role in upper case."""
    starts = list(range(0, len(rows), block)) or [0]
    to_go = {s: 0 for s in FINAL}
    after = []
    for at in reversed(starts):
        after.append(to_go)
        to_go = {s: w for s, (w, _) in _solve(rows[at:at + block], to_go, at == starts[-1], 0)[0].items()}
    after.reverse()
    cost, state, audit, plans = to_go[NOTHING], NOTHING, [], [""]
    for at, costs in zip(starts, after, strict=True):
        part = rows[at:at + block]
        nodes = _solve(part, costs, at == starts[-1], 4 * len(part) + 8)
        row = 0
        while (edit := nodes[row][state][1]) is not None:
            letter, role, row, state = edit
            audit.append(letter)
            if letter == "I":
                plans[-1] += role
            else:
                plans[-1] += "-" if letter == "D" else "=" if letter == "K" else role.upper()
                plans.append("")
    return cost, "".join(audit), plans[:-1], plans[-1]


# ---- the rows of a conversation, in Spark

#: A character that is no white space; a last such character that ends a sentence.
_SOLID, _ENDED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"


def damaged(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)``: rows after the damage, by the
    row's own hash; 0 copies marks a row that is dropped. A null role or text is
    one space, as is a null id or turn inside the hashed key."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(F.encode(key, "UTF-8")) % 20
    text = F.coalesce("text", space)
    return rows.select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def judged(rows: DataFrame) -> DataFrame:
    """Rows after damage with their place ``pos`` in the conversation, ``fault``
    (``b`` blank, ``d`` duplicate, ``t`` truncated, ``-`` none), the role's
    ``initial``, ``illegal`` (1 where the pair with the row before is) and
    ``new_turn``. Rows of one turn follow each other by role and text. Dropped
    rows keep a line without a place, so that no conversation is lost."""
    there = rows.where("copies > 0").withColumn("copies", F.explode(F.sequence(F.lit(1), "copies")))
    ordered = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), "role", "text", "copies")
    same = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first(), "copies")
    fault = (F.when(~F.col("text").rlike(_SOLID), "b").when(F.col("seen") > 1, "d")
             .when(~F.col("text").rlike(_ENDED), "t").otherwise("-"))
    before = F.lag("initial").over(ordered)
    pair = F.concat(before, "initial")
    marked = (there.withColumn("initial", F.substring("role", 1, 1))
              .withColumn("seen", F.row_number().over(same))
              .withColumn("pos", F.row_number().over(ordered))
              .withColumn("illegal", F.when(before.isNotNull() & ~pair.isin(*LEGAL_PAIRS), 1).otherwise(0))
              .withColumn("new_turn", F.when(F.col("turn").isNotNull()
                                             & ~F.col("turn").eqNullSafe(F.lag("turn").over(ordered)), 1)
                          .otherwise(0)))
    kept = marked.select("conv_id", "turn", "pos", "role", "text", "initial", fault.alias("fault"),
                         "illegal", "new_turn")
    gone = rows.where("copies = 0").select("conv_id").distinct()
    return kept.unionByName(gone, allowMissingColumns=True)


def _planned(patterns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in patterns:
        out = []
        for rows in batch:
            out.append(repair([(r["initial"], r["fault"] in "bd", r["fault"] == "t") for r in rows]))
        yield pd.DataFrame(out, columns=["cost", "audit", "plan", "tail"])


def plans(rows: DataFrame) -> DataFrame:
    """One row per conversation: its counts and the plan of its rows."""
    there = F.col("pos").isNotNull()
    pattern = F.sort_array(F.collect_list(F.when(there, F.struct("pos", "initial", "fault"))))
    wide = "decimal(38,0)"
    gaps = (F.max("turn").cast(wide) - F.min("turn").cast(wide) + 1 - F.sum("new_turn")).try_cast("long")

    def count(fault: str) -> Column:
        return F.count(F.when(F.col("fault") == fault, 1)).alias(
            {"b": "blank", "d": "duplicate", "t": "truncated"}[fault])

    found = rows.groupBy("conv_id").agg(
        F.when(F.max("turn").isNull(), F.lit(0).cast("long")).otherwise(gaps).alias("gaps"),
        count("b"), count("d"), count("t"),
        F.coalesce(F.sum("illegal"), F.lit(0)).cast("long").alias("illegal"), pattern.alias("__rows"))
    planned = pandas_udf(_planned, "cost long, audit string, plan array<string>, tail string")
    return flatten(found.withColumn("__plan", planned("__rows")), "__plan").drop("__rows")


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def _lines(plan: str, role: str | None, text: str | None) -> Iterator[str]:
    """The repaired rows that one row's plan gives."""
    for c in plan:
        if c == "=":
            yield f"{role}:{text}"
        elif c in "UA":
            yield f"{ROLE[c.lower()]}:{text}"
        elif c != "-":
            yield f"{ROLE[c]}:"


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ordered rows, each conversation's plan first -> one row per conversation."""
    head, digest, n_rows, place, plan, tail = None, None, 0, 0, [], ""

    def add(lines) -> int:
        n = n_rows
        for line in lines:
            digest.update((("\n" if n else "") + line).encode())
            n += 1
        return n

    def finished():
        return [head, add(_lines(tail, None, None)), digest.hexdigest()]

    names = ["head", "n_rows", "repaired_sha256"]
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            if row.head is not None:
                if head is not None:
                    out.append(finished())
                head, plan, tail = row.head, row.plan, row.tail
                digest, n_rows, place = hashlib.sha256(), 0, 0
            else:
                n_rows = add(_lines(plan[place], row.role, row.text))
                place += 1
        yield pd.DataFrame(out, columns=names)
    if head is not None:
        yield pd.DataFrame([finished()], columns=names)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text)`` after damage -> per ``conv_id``: gaps,
    blank, duplicate, truncated, illegal, cost, audit, n_rows and repaired_sha256.

    ``rows`` is what ``damaged`` returns (``copies`` says how often a row
    stands). Null conversation ids are one conversation; a turn's rows follow
    each other by role and text; rows repeated in full are duplicates of the
    first. Turns too far apart for a long have null gaps. A conversation without
    rows has zeros, an empty audit and the hash of the empty text; an empty
    table gives an empty result. Columns other than these four are left out."""
    marked = stored(judged(rows), "conversation-rows")
    planned = stored(plans(marked), "conversation-plans")
    texts = marked.where(F.col("pos").isNotNull()).select("conv_id", "pos", "role", "text")
    # The id and the counts go past Python as one text, whatever their types.
    head = F.struct("conv_id", *_COUNTS)
    heads = planned.select("conv_id", F.lit(0).alias("pos"), F.to_json(head).alias("head"), "plan", "tail")
    both = (heads.unionByName(texts, allowMissingColumns=True)
            .repartition("conv_id").sortWithinPartitions("conv_id", "pos"))
    hashed = both.select("head", "plan", "tail", "role", "text").mapInPandas(
        _hashed, "head string, n_rows long, repaired_sha256 string")
    fields = planned.select(head.alias("h")).schema["h"].dataType
    return hashed.select(F.from_json("head", fields).alias("h"), "n_rows", "repaired_sha256").select(
        "h.*", "n_rows", "repaired_sha256")
