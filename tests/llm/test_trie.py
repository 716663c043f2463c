"""The prefix trie against a walk over all prefixes."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from ferrygate.llm import trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(r[2], r[4]) for r in sorted(found)] for c, found in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        paths[c] = own.get(base, [])[:h] + turns[h:]
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    out = []
    for node, found in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = {n[: len(node) + 1] for n in below if len(n) > len(node)}
        ends = sorted(c for c in found if len(paths[c]) == len(node))
        out.append((
            min(found), len(node), min(members[node[:-1]]) if node else None, len(found), len(children),
            sum(all(len(m) <= len(n) or m[: len(n)] != n for m in below) for n in below),
            sum((len(members[n]) - 1) * (len(WORD.findall(n[-1][1])) if n else 0) for n in below),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", 3) for r in rows], "conv_id long, turn long, role string, text string, conv string, pos int")
    nodes = trie.prefix_trie(*trie.rebuilt(trie.numbered(frame)), **options)
    return sorted((tuple(r) for r in nodes.collect()), key=repr)


def conversations(seed, n=70):
    rng, rows = random.Random(seed), []
    for conv in rng.sample(range(-25, 400), n) + [None]:
        length = rng.choice([1, 1, 2, 3, 4, 9])
        for turn in range(length):
            role, text = rng.choice(["user", "assistant", None]), rng.choice(["hello there", "yes", None, "", " \t", "a b c d"])
            rows.append((conv, rng.choice([turn, turn, None]), role, text))
    return rows


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"shard_turns": 40}), (3, {"shard_turns": 30, "cut": 2})])
def test_equals_brute_force(spark, seed, options):
    rows = conversations(seed)
    assert found(spark, rows, **options) == brute(rows)


def test_copies_of_one_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(5)]
    rows += [(1000 + c, 0, "user", f"only {c}") for c in range(50)]
    assert found(spark, rows, shard_turns=100) == brute(rows)


def test_one_long_conversation_in_many_pieces(spark):
    rows = [(40, t, "user", f"w{t} x") for t in range(60)] + [(43, t, "user", f"w{t} x") for t in range(45)]
    assert found(spark, rows, cut=7, shard_turns=20) == brute(rows)


def test_empty_and_turnless(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []
    alone = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 4 == 3 and c % 20)
    rows = [(alone, 0, "user", "given up"), (alone, 1, "assistant", "too")]
    assert found(spark, rows) == brute(rows) == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]


def test_slots_are_verified():
    digests = np.random.default_rng(3).integers(0, 2**63, (5000, 2), dtype=np.uint64)
    nodes = trie.NodeTable(np.concatenate((digests, digests)))
    assert np.array_equal(nodes.row_slots[:5000], nodes.row_slots[5000:])
    assert np.array_equal(np.sort(nodes.row_slots[:5000]), np.arange(5000))
    assert (nodes.slots(digests + np.uint64(1)) == -1).all()
