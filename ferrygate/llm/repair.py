"""Conversation structure repair: generalised LR parsing with weighted edits over a graph-structured stack.

The roles of a repaired conversation read ``(s?(ua)+)?`` by their initials. The grammar's SLR table is made from its rules. A
conversation is parsed with all its possible edits at once: each row is kept (0), given the role user or assistant (1) or
deleted (2), rows with an empty text and either role are inserted anywhere (5 each), and a truncated row that stays costs 5 more. Blank and
repeated rows must go. Stacks share their lower parts; stacks with equal tops accept the same rest in this grammar, so they
merge and the smaller (cost, audit) stays, the audit being the initials of the edits so far.

Long conversations are split. Rows are dealt by ranges of (conversation, turn) and cut into segments of at most ``SEGMENT``
rows; a segment is parsed from every stack that may enter it, which gives a small table of (entry, exit, cost, audit). One
conversation's tables are folded in order, the chosen audit of each segment goes back to it, and the segment writes
its repaired lines as one piece. Only the digest, which SHA-256 makes one byte after the other, sees a conversation in one task, as a
stream of finished pieces.

Rows that are equal in conversation, turn, role and text are combined with their count before anything is sorted, and
first occurrences come from an aggregate, so a row that makes up a third of the table is one row.

Defined cases: a null role or text becomes one space, and a null conversation or turn stands as one space in the damage's
key; all rows without a conversation are one conversation, with a null ``conv_id``; rows of one turn are ordered by role and digest of
the text; an empty role has no initial and is never kept; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import SPACE, table
from .ordered import batches_of, by_key, digest_of_pieces, in_ranges, rows_of
from .sql import crc32

#: Rules of the role grammar; small letters are initials of roles.
GRAMMAR = {"G": ["", "sP", "P"], "P": ["Pua", "ua"]}
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows of a segment, and bytes of text after which one is closed.
SEGMENT, SEGMENT_BYTES = 512, 16 << 20

Stack = tuple[int, ...]
#: Tops of the stack graph: LR state -> (cost, audit, the stack below and with it).
Tops = dict[int, tuple[int, str, Stack]]


# ---- the table


class Table:
    """SLR table of a grammar whose terminals are single small letters."""

    def __init__(self, grammar: dict[str, list[str]], start: str):
        rules = [("", start)] + [(left, right) for left, rights in grammar.items() for right in rights]

        def closure(items: set) -> frozenset:
            items, todo = set(items), list(items)
            while todo:
                rule, dot = todo.pop()
                symbol = rules[rule][1][dot : dot + 1]
                new = {(i, 0) for i, (left, _) in enumerate(rules) if symbol and left == symbol} - items
                items |= new
                todo += new
            return frozenset(items)

        def goto(items: frozenset, symbol: str) -> frozenset:
            return closure({(r, dot + 1) for r, dot in items if rules[r][1][dot : dot + 1] == symbol})

        symbols = sorted({s for _, right in rules for s in right} | set(grammar))
        states, moves = [closure({(0, 0)})], {}
        for at, items in enumerate(states):
            for symbol in symbols:
                if target := goto(items, symbol):
                    if target not in states:
                        states.append(target)
                    moves[at, symbol] = states.index(target)
        self.moves = moves
        follow = self._follow(rules, grammar, start)
        #: (state, lookahead) -> rules that end there.
        self.reductions = {
            (at, ahead): [rules[r] for r, dot in items if r and dot == len(rules[r][1]) and ahead in follow[rules[r][0]]]
            for at, items in enumerate(states)
            for ahead in "sua$"
        }
        self.accepting = {at for at, items in enumerate(states) if (0, 1) in items}

    @staticmethod
    def _follow(rules: list, grammar: dict, start: str) -> dict[str, set]:
        empty = {left for left, right in rules if left and not right}
        first = {s: {s} for _, right in rules for s in right if s.islower()} | {left: set() for left in grammar}
        follow = {left: set() for left in grammar} | {"": {"$"}}
        follow[start].add("$")
        while True:
            before = sum(map(len, first.values())) + sum(map(len, follow.values()))
            for left, right in rules:
                for s in right:
                    if left:
                        first[left] |= first[s]
                    if s not in empty:
                        break
                tail = set(follow[left])
                for s in reversed(right):
                    if s in grammar:
                        follow[s] |= tail
                        tail = first[s] | (tail if s in empty else set())
                    else:
                        tail = {s}
            if sum(map(len, first.values())) + sum(map(len, follow.values())) == before:
                return follow

    def reduced(self, stack: Stack, ahead: str) -> Stack:
        """The stack after all reductions before ``ahead``; this grammar never has a choice."""
        while rules := self.reductions.get((stack[-1], ahead)):
            left, right = rules[0]
            stack = stack[: len(stack) - len(right)]
            stack += (self.moves[stack[-1], left],)
        return stack

    def shift(self, stack: Stack, terminal: str) -> Stack | None:
        stack = self.reduced(stack, terminal)
        target = self.moves.get((stack[-1], terminal))
        return None if target is None else stack + (target,)

    def accepts(self, stack: Stack) -> bool:
        return self.reduced(stack, "$")[-1] in self.accepting

    def stacks(self) -> list[Stack]:
        """Every stack that a parse can stand at between two rows: left recursion keeps them few."""
        found = [(0,)]
        for stack in found:
            for terminal in "sua":
                if (after := self.shift(stack, terminal)) and after not in found:
                    found.append(after)
        return found


# ---- one segment


def _merge(tops: Tops, cost: int, audit: str, stack: Stack) -> bool:
    held = tops.get(stack[-1])
    if held is not None and held[:2] <= (cost, audit):
        return False
    tops[stack[-1]] = (cost, audit, stack)
    return True


def _inserted(tops: Tops, slr: Table) -> Tops:
    """``tops`` and what inserted rows make of them."""
    todo = list(tops.values())
    while todo:
        cost, audit, stack = todo.pop()
        for terminal in ROLES:
            if (after := slr.shift(stack, terminal)) and _merge(tops, cost + INSERT, audit + "I", after):
                todo.append(tops[after[-1]])
    return tops


def parse(rows: list[tuple[str, bool, bool, int]], entry: Stack, slr: Table) -> Tops:
    """Tops after ``rows`` of (initial, must go, truncated, further copies) from the stack ``entry``."""
    tops = _inserted({entry[-1]: (0, "", entry)}, slr)
    for initial, must_go, truncated, copies in rows:
        after: Tops = {}
        more = TRUNCATED if truncated else 0
        for cost, audit, stack in tops.values():
            _merge(after, cost + DELETE, audit + "D", stack)
            if must_go:
                continue
            if initial in ("s", "u", "a") and (kept := slr.shift(stack, initial)):
                _merge(after, cost + more, audit + "K", kept)
            for terminal in ROLES:
                if changed := slr.shift(stack, terminal):
                    _merge(after, cost + REROLE + more, audit + "R", changed)
        tops = _inserted(after, slr)
        if copies:  # an insert between two deletions never has the least audit
            gone = "D" * copies
            tops = _inserted({k: (cost + DELETE * copies, audit + gone, stack) for k, (cost, audit, stack) in tops.items()}, slr)
    return tops


def replay(audit: str, entry: Stack, roles: list[str], texts: list[str], copies: list[int], slr: Table) -> list[str]:
    """The lines ``role:text`` that ``audit`` leaves of a segment's rows."""
    stack, lines, row, gone = entry, [], -1, 0
    for edit in audit:
        if edit == "I":
            terminal = next(t for t in ROLES if slr.shift(stack, t))
            lines.append(f"{ROLES[terminal]}:")
        else:
            if gone:
                gone -= 1
                continue
            row += 1
            gone = copies[row]
            if edit == "D":
                continue
            terminal = roles[row][0] if edit == "K" else next(t for t in ROLES if slr.shift(stack, t))
            lines.append(f"{roles[row] if edit == 'K' else ROLES[terminal]}:{texts[row]}")
        stack = slr.shift(stack, terminal)
    return lines


# ---- damage and faults


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv, turn, role, text, copies)``: the conversations after the damage that a checksum of their keys decides."""
    conv, turn = (F.coalesce(F.col(c).cast("long").cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    return conversations.select(
        conv.alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col("role"), F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
        kind.alias("kind"),
    ).filter("kind != 0").drop("kind")


def with_faults(rows: DataFrame) -> DataFrame:
    """Equal rows of ``rows(conv, turn, role, text, copies)`` as one, with ``blank``, ``repeated`` (seen in an earlier turn) and ``truncated``."""
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = materialize(rows.select("*", F.sha2("text", 256).alias("digest")), "repair-rows")
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = rows.groupBy("conv", "role", "digest").agg(F.min(when).alias("first"))
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    return rows.join(firsts, ["conv", "role", "digest"]).select(
        "conv",
        "turn",
        "role",
        "digest",
        "text",
        "copies",
        blank.alias("blank"),
        (~blank & (F.col("first") < when)).alias("repeated"),
        (~blank & ~F.col("text").rlike(f"[.!?][{SPACE}]*\\z")).alias("truncated"),
    )


def _illegal(pair: str) -> bool:
    return pair not in ("su", "ua", "au")


# ---- segments

SEGMENTS = pa.schema(
    [
        ("conv", pa.string()),
        ("part", pa.int32()),
        ("segment", pa.int32()),
        ("blank", pa.int64()),
        ("duplicate", pa.int64()),
        ("truncated", pa.int64()),
        ("illegal", pa.int64()),
        ("first_role", pa.string()),
        ("last_role", pa.string()),
        ("first_turn", pa.int64()),
        ("last_turn", pa.int64()),
        ("turns", pa.int64()),
        ("options", pa.list_(pa.struct([("entry", pa.list_(pa.int32())), ("exit", pa.list_(pa.int32())), ("cost", pa.int64()), ("audit", pa.string())]))),
        ("roles", pa.list_(pa.string())),
        ("texts", pa.list_(pa.string())),
        ("copies", pa.list_(pa.int64())),
    ]
)
SEGMENTS_DDL = (
    "conv string, part int, segment int, blank long, duplicate long, truncated long, illegal long, first_role string, last_role string, "
    "first_turn long, last_turn long, turns long, options array<struct<entry:array<int>,exit:array<int>,cost:long,audit:string>>, "
    "roles array<string>, texts array<string>, copies array<long>"
)


def _segment(conv: str, part: int, number: int, rows: list[tuple], starts: bool, slr: Table) -> tuple:
    """The ``SEGMENTS`` row of ``rows``; ``starts`` if the conversation surely begins here."""
    roles = [r[2] for r in rows]
    extra = [r[5] - 1 for r in rows]
    blank = sum(r[5] for r in rows if r[6])
    duplicate = sum(r[5] - (not r[7]) for r in rows if not r[6])
    truncated = sum(r[8] and not r[7] for r in rows)
    first = [role[:1] for role in roles]
    illegal = sum(_illegal(a + b) for a, b in zip(first, first[1:]))
    illegal += sum(n for a, n in zip(first, extra) if n and _illegal(a + a))
    known = [r[1] for r in rows if r[1] is not None]
    facts = [(a, r[6] or r[7], r[8], n) for a, r, n in zip(first, rows, extra)]
    if starts and not blank and not duplicate and not truncated and re.fullmatch("(s?(ua)+)?", "".join(a or " " for a in first)):
        stack: Stack = (0,)
        for a in first:
            stack = slr.shift(stack, a)
        options = [((0,), stack, 0, "K" * len(rows))]
    else:
        options = [
            (entry, stack, cost, audit)
            for entry in ([(0,)] if starts else slr.stacks())
            for cost, audit, stack in parse(facts, entry, slr).values()
        ]
    return (
        conv, part, number, blank, duplicate, truncated, illegal, first[0], first[-1],
        known[0] if known else None, known[-1] if known else None, len(set(known)),
        [dict(zip(("entry", "exit", "cost", "audit"), o)) for o in options],
        roles, [r[4] for r in rows], extra,
    )


def segments(rows: DataFrame, segment_rows: int = SEGMENT) -> DataFrame:
    """Bounded pieces of conversations with what each costs from every stack that may enter it."""
    grammar = GRAMMAR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slr, part = Table(grammar, "G"), TaskContext.get().partitionId()

        def pieces() -> Iterator[tuple]:
            held, n_bytes, number, started = [], 0, 0, False
            for row in rows_of(batches):
                if held and (row[0] != held[0][0] or len(held) >= segment_rows or n_bytes >= SEGMENT_BYTES):
                    yield _segment(held[0][0], part, number, held, started, slr)
                    # the task's first conversation may have begun before it
                    started, held, n_bytes, number = row[0] != held[0][0], [], 0, number + 1
                held.append(row)
                n_bytes += len(row[4])
            if held:
                yield _segment(held[0][0], part, number, held, started, slr)

        yield from batches_of(pieces(), SEGMENTS, size=lambda row: 200 + sum(map(len, row[14])))

    wanted = ["conv", "turn", "role", "digest", "text", "copies", "blank", "repeated", "truncated"]
    return in_ranges(rows.select(*wanted), "conv", "turn", "role", "digest").mapInArrow(run, SEGMENTS_DDL)


FOLDED = pa.schema(
    [
        ("conv", pa.string()),
        ("part", pa.int32()),
        ("segment", pa.int32()),
        ("entry", pa.list_(pa.int32())),
        ("edits", pa.string()),
        ("gaps", pa.int64()),
        ("blank", pa.int64()),
        ("duplicate", pa.int64()),
        ("truncated", pa.int64()),
        ("illegal", pa.int64()),
        ("cost", pa.int64()),
        ("audit", pa.string()),
    ]
)
FOLDED_DDL = (
    "conv string, part int, segment int, entry array<int>, edits string, gaps long, blank long, duplicate long, truncated long, "
    "illegal long, cost long, audit string"
)


def _fold(conv: str, pieces: Iterator[tuple], slr: Table) -> Iterator[tuple]:
    """A row for each segment with its chosen edits, and one with the conversation's totals."""
    tops = {(0,): (0, "", ())}  # by stack: cost, audit, ((part, segment, entry, edits), the path before)
    totals, last_role, last_turn, first_turn, turns = [0, 0, 0, 0], None, None, None, 0
    for _, part, segment, blank, duplicate, truncated, illegal, its_first, its_last, low, high, its_turns, options in pieces:
        if last_role is not None:
            illegal += _illegal(last_role + its_first)
        totals = [a + b for a, b in zip(totals, (blank, duplicate, truncated, illegal))]
        last_role = its_last
        if low is not None:
            turns += its_turns - (low == last_turn)
            first_turn, last_turn = (low if first_turn is None else first_turn), high
        after, by_top = {}, {}
        for option in options:
            entry, stack = tuple(option["entry"]), tuple(option["exit"])
            if entry in tops:
                cost, audit, path = tops[entry]
                found = (cost + option["cost"], audit + option["audit"])
                if stack[-1] not in by_top or found < by_top[stack[-1]][0]:
                    by_top[stack[-1]] = (found, stack, ((part, segment, entry, option["audit"]), path))
        for found, stack, path in by_top.values():
            after[stack] = (*found, path)
        tops = after
    cost, audit, path = min((t for stack, t in tops.items() if slr.accepts(stack)), key=lambda t: t[:2])
    while path:
        (part, segment, entry, edits), path = path
        yield conv, part, segment, list(entry), edits, *[None] * 7
    gaps = 0 if first_turn is None else last_turn - first_turn + 1 - turns
    yield conv, None, None, None, None, gaps, *totals, cost, audit


def folded(pieces: DataFrame) -> DataFrame:
    """Per conversation the cheapest way through its segments; see ``FOLDED``."""
    grammar = GRAMMAR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slr = Table(grammar, "G")

        def walk() -> Iterator[tuple]:
            rows = rows_of(batches)
            row = next(rows, None)
            while row is not None:
                conv = row[0]

                def mine() -> Iterator[tuple]:
                    nonlocal row
                    while row is not None and row[0] == conv:
                        yield row
                        row = next(rows, None)

                yield from _fold(conv, mine(), slr)

        yield from batches_of(walk(), FOLDED, size=lambda row: 100 + len(row[4] or "") + len(row[11] or ""))

    narrow = pieces.drop("roles", "texts", "copies")
    return by_key(narrow, "conv", "part", "segment").mapInArrow(run, FOLDED_DDL)


def repaired(pieces: DataFrame, chosen: DataFrame) -> DataFrame:
    """``(conv, part, segment, lines)``: the repaired lines of each segment, joined; null where none is left."""
    grammar = GRAMMAR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slr = Table(grammar, "G")
        schema = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("segment", pa.int32()), ("lines", pa.string())])

        def walk() -> Iterator[tuple]:
            for conv, part, segment, entry, edits, roles, texts, copies in rows_of(batches):
                lines = replay(edits, tuple(entry), roles, texts, copies, slr)
                yield conv, part, segment, "\n".join(lines) if lines else None

        yield from batches_of(walk(), schema, size=lambda row: 64 + len(row[3] or ""))

    picked = chosen.filter("part is not null").select("part", "segment", "entry", "edits")
    joined = pieces.join(picked, ["part", "segment"]).select("conv", "part", "segment", "entry", "edits", "roles", "texts", "copies")
    return joined.mapInArrow(run, "conv string, part int, segment int, lines string")


def repair(conversations: DataFrame, damage: Callable[[DataFrame], DataFrame] | None = None, segment_rows: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """``(lines, report)``: the repaired lines of all segments, and per conversation its faults, cost, audit and digest.

    ``damage`` maps the conversations to ``(conv, turn, role, text, copies)``; without one they are taken as they are.
    """
    if damage is None:
        rows = conversations.select(
            F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit(" ")).alias("conv"),
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", F.lit(" ")).alias("role"),
            F.coalesce("text", F.lit(" ")).alias("text"),
            F.lit(1).cast("long").alias("copies"),
        )
    else:
        rows = damage(conversations)
    pieces = materialize(segments(with_faults(rows), segment_rows), "repair-segments")
    chosen = materialize(folded(pieces), "repair-folded")
    lines = materialize(repaired(pieces, chosen), "repair-lines")
    digests = digest_of_pieces(lines, "conv", ["part", "segment"], "lines", "\n")
    totals = chosen.filter("part is null").join(digests, "conv")
    everything = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = everything.join(totals, F.coalesce(everything["conv_id"].cast("string"), F.lit(" ")) == totals["conv"], "left")
    zero: Callable[[str], Column] = lambda name: F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name)
    report = found.select(
        "conv_id",
        *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
    return lines, report


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after damage: its faults and the cheapest repair."""
    return repair(table(spark, sf_dir, "conversations"), damaged)[1]


def _op11_sql() -> str:
    """A row at a time over the four places in ``(s?(ua)+)?``: start, after s, after u, after a, each with its least (cost, audit, lines)."""
    key = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"

    def edit(place: str, cost: str, initial: str, line: str | None = None) -> str:
        lines = f"{place}.l" if line is None else f"{place}.l || CASE WHEN {place}.l = '' THEN '' ELSE chr(10) END || {line}"
        return f"{{'c': {place}.c + {cost}, 'a': {place}.a || '{initial}', 'l': {lines}}}"

    def only(condition: str, *found: str) -> str:
        return ", ".join(f"CASE WHEN {condition} THEN {x} ELSE never END" for x in found)

    def rerole(places: str, role: str) -> str:
        return ", ".join(edit(p, f"{REROLE} + more", "R", f"'{role}:' || text") for p in places)

    def keep(places: str) -> str:
        return ", ".join(edit(p, "more", "K", "role || ':' || text") for p in places)

    stays = "NOT (blank OR repeated)"
    inserted_u = ", ".join(edit(p, str(INSERT), "I", "'user:'") for p in "esa")
    never = "{'c': 1000000000::BIGINT, 'a': 'Z', 'l': ''}"

    def inserted(frame: str) -> str:
        assistant = edit("u", str(INSERT), "I", "'assistant:'")
        return f"SELECT * REPLACE (least(a, {assistant}) AS a) FROM (SELECT * REPLACE (least(u, {inserted_u}) AS u) FROM ({frame}))"

    step = f"""SELECT t.conv, t.pos + 1 AS pos, {edit('e', str(DELETE), 'D')} AS e,
      least({edit('s', str(DELETE), 'D')}, {only(f"{stays} AND initial = 's'", edit('e', 'more', 'K', "role || ':' || text"))}) AS s,
      least({edit('u', str(DELETE), 'D')}, {only(f"{stays} AND initial = 'u'", *[keep(p) for p in 'esa'])}, {only(stays, *[rerole(p, 'user') for p in 'esa'])}) AS u,
      least({edit('a', str(DELETE), 'D')}, {only(f"{stays} AND initial = 'a'", keep('u'))}, {only(stays, rerole('u', 'assistant'))}) AS a
    FROM (SELECT t.*, {never} AS never, r.* EXCLUDE (conv, pos) FROM tops t JOIN marked r ON r.conv = t.conv AND r.pos = t.pos + 1) t"""
    start = f"""SELECT conv, 0::BIGINT AS pos, {{'c': 0::BIGINT, 'a': '', 'l': ''}} AS e, {never} AS s, {never} AS u, {never} AS a
      FROM (SELECT DISTINCT conv FROM marked)"""
    return rf"""
WITH RECURSIVE keyed AS (SELECT *, {key} AS k FROM conversations),
hashed AS (SELECT *, {crc32('k')} % 20 AS kind FROM keyed),
damaged AS (
  SELECT coalesce(conv_id::VARCHAR, ' ') AS conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed WHERE kind <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos,
    substr(role, 1, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank
  FROM damaged),
marked AS (
  SELECT conv, turn, role, text, pos, initial, blank,
    NOT blank AND row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) > 1 AS repeated,
    NOT blank AND NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
    CASE WHEN cut THEN {TRUNCATED} ELSE 0 END AS more,
    coalesce(lag(initial) OVER (PARTITION BY conv ORDER BY pos) || initial NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM numbered),
tops AS (
  {inserted(start)}
  UNION ALL
  {inserted(step)}),
counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (WHERE blank) AS blank,
    count(*) FILTER (WHERE repeated) AS duplicate, count(*) FILTER (WHERE cut AND NOT repeated) AS truncated,
    count(*) FILTER (WHERE illegal) AS illegal, max(pos) AS pos
  FROM marked GROUP BY conv),
found AS (SELECT c.*, least(t.e, t.a) AS best FROM counts c JOIN tops t ON t.conv = c.conv AND t.pos = c.pos)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit,
  sha256(coalesce(best.l, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN found f ON f.conv = coalesce(o.conv_id::VARCHAR, ' ')
"""


OP11_SQL = _op11_sql()
