"""Conversation repair against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from ferrygate.llm import repair
from ferrygate.llm.ordered import in_ranges

BLANKS = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """The least (cost, audit, text) by trying every list of edits with up to ``len + 2`` inserts, shortest cost first."""
    seen, facts = set(), []
    for _, role, text in rows:
        blank = not text.strip(BLANKS)
        cut = not blank and text.rstrip(BLANKS)[-1] not in ".!?"
        facts.append((role, text, blank or (role, text) in seen, cut))
        seen.add((role, text))
    best = None
    for edits in itertools.product(*(["D"] if f[2] else ["K", "U", "A", "D"] for f in facts)):
        kept = [f"{f[0]}:{f[1]}" if e == "K" else f"{'user' if e == 'U' else 'assistant'}:{f[1]}" for e, f in zip(edits, facts) if e != "D"]
        base = sum({"K": 0, "U": 1, "A": 1, "D": 2}[e] + (5 if e != "D" and f[3] else 0) for e, f in zip(edits, facts))
        if best is not None and base > best[0]:
            continue
        letters = "".join({"U": "R", "A": "R"}.get(e, e) for e in edits)
        n = len(facts)
        for inserts in range(4):
            if best is not None and base + 5 * inserts > best[0]:
                break
            for places in itertools.combinations_with_replacement(range(n + 1), inserts):
                for roles in itertools.product(("user", "assistant"), repeat=inserts):
                    lines, audit, k = [], "", 0
                    for i in range(n + 1):
                        for place, role in zip(places, roles):
                            if place == i:
                                lines.append(f"{role}:")
                                audit += "I"
                        if i < n:
                            audit += letters[i]
                            if edits[i] != "D":
                                lines.append(kept[k])
                                k += 1
                    if re.fullmatch("(s?(ua)+)?", "".join(line.partition(":")[0][:1] or " " for line in lines)):
                        found = (base + 5 * inserts, audit, "\n".join(lines))
                        best = found if best is None else min(best, found)
    return best


def expected(original):
    report = {}
    for conv in {r[0] for r in original}:
        rows = [r[1:] for r in damage([r for r in original if r[0] == conv])]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        turns = [r[0] for r in rows if r[0] is not None]
        seen, blank, duplicate, truncated = set(), 0, 0, 0
        for _, role, text in rows:
            if not text.strip(BLANKS):
                blank += 1
            elif (role, text) in seen:
                duplicate += 1
            elif text.rstrip(BLANKS)[-1] not in ".!?":
                truncated += 1
            seen.add((role, text))
        initials = [r[1][:1] for r in rows]
        cost, audit, lines = cheapest(rows)
        report[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, blank, duplicate, truncated,
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256(lines.encode()).hexdigest(),
        )
    return report


def conversations(seed, n=60):
    rng, rows = random.Random(seed), []
    roles, texts = ["user", "assistant", "system", None, "tool", ""], ["Yes.", "No", "What?", "", None, " \n", "same!", "end. "]
    for conv in [*range(n), None]:
        turns = [rng.choice([None, *range(6)]) for _ in range(rng.randrange(1, 6))]
        rows += [(conv, t, rng.choice(roles[: rng.choice([2, 3, 6])]), rng.choice(texts)) for t in turns]
    return rows


def report(spark, rows, **options):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return {r[0]: tuple(r)[1:] for r in repair.repair(frame, repair.damaged, **options)[1].collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = conversations(seed)
    assert report(spark, rows) == expected(rows)


def test_cut_conversations_repair_alike(spark):
    rows = conversations(3, 30)
    assert report(spark, rows, segment_rows=2) == report(spark, rows) == expected(rows)


def test_a_row_repeated_many_times_is_one_row(spark):
    rows = [(7, 0, "user", "Hello."), (7, 1, "assistant", "Yes.")] + [(7, 2, "user", "Again?")] * 5000
    found = report(spark, rows)[7]
    repeats = len(damage(rows)) - len({r for r in damage(rows)})
    assert found[2] == repeats and found[6].count("D") >= repeats


def test_undamaged_and_legal_text_stays(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "user", "U?"), (1, 2, "assistant", "A.")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, conv string, copies int")
    lines, found = repair.repair(frame)
    row = found.collect()[0]
    assert (row["cost"], row["audit"]) == (0, "KKK")
    assert [r["lines"] for r in lines.collect()] == ["system:S.\nuser:U?\nassistant:A."]


def test_empty_table(spark):
    assert report(spark, []) == {}


def test_long_turns_and_segments_in_ranges(spark):
    long = "word " * 100_000
    rows = [(1, i, ("user", "assistant")[i % 2], f"{long}{i}.") for i in range(40)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = repair.repair(frame)[1].collect()[0]
    text = "\n".join(f"{r[2]}:{r[3]}" for r in rows)
    assert (found["cost"], found["audit"], found["repaired_sha256"]) == (0, "K" * 40, hashlib.sha256(text.encode()).hexdigest())


def test_table_of_the_grammar():
    slr = repair.Table(repair.GRAMMAR, "G")
    for length in range(7):
        for word in itertools.product("sua", repeat=length):
            stack = (0,)
            for letter in word:
                stack = stack and slr.shift(stack, letter)
            assert bool(stack and slr.accepts(stack)) == bool(re.fullmatch("(s?(ua)+)?", "".join(word))), word


def test_order_of_ranges(spark):
    frame = spark.createDataFrame([(i % 3 or None, -i) for i in range(50)], "a long, b long")
    assert [tuple(r) for r in in_ranges(frame, "a", "b").collect()] == sorted(
        [(i % 3 or None, -i) for i in range(50)], key=lambda r: (r[0] is not None, r[0] or 0, r[1])
    )
