"""Binary token shards against the tokenizer over whole texts."""

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, str(Path(__file__).parent))

from corpus import edge, edge_rows, empty

from ferrygate.llm import tokenids
from ferrygate.llm.mph import MinimalPerfectHash
from ferrygate.llm.tokens import tokenizer_file

PATH = tokenizer_file(tokenids.TOKENIZER)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return tokenids.Encoder(PATH)


def whole(library, text):
    return library.encode(text, add_special_tokens=False).ids


ALPHABET = "ab Z09.,'!\n\t\r\x0b\x0c\x1c\x1f\x85\xa0 　​\xaa\xd7\xe9\xdfİΣ日́٠\U0001f600_-<|>"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*ALPHABET, "  ", "'s", "don't", "<|endoftext|>", " the", "    "]), max_size=25).map("".join))
def test_pieces_equal_whole_texts(text):
    from tokenizers import Tokenizer

    mine = ENCODER.encode(text)
    assert np.frombuffer(mine, "<u2").tolist() == whole(LIBRARY, text)


LIBRARY = ENCODER = None


@pytest.fixture(autouse=True)
def _shared(library, encoder):
    global LIBRARY, ENCODER
    LIBRARY, ENCODER = library, encoder


def test_remembering_little_changes_nothing(library):
    small, rng = tokenids.Encoder(PATH, remembered=3), random.Random(5)
    for _ in range(50):
        text = " ".join(rng.choice(["one", "two.", "three\n", "", "é!", "x" * 20]) for _ in range(30))
        assert np.frombuffer(small.encode(text), "<u2").tolist() == whole(library, text)


def expected(library, rows):
    """``{(doc_id, start, n, crc)}`` with equal ids in any order of their texts, as a function of that order."""
    found = {}
    for doc_id, text in rows:
        ids = whole(library, text or "") + [0]
        found.setdefault(doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return found


def check(library, rows, read):
    want, at = expected(library, rows), 0
    read = sorted(read, key=lambda r: r["start"])
    assert [r["doc_id"] for r in read] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    for r in read:
        assert r["start"] == at
        want[r["doc_id"]].remove((r["n_tokens"], r["ids_crc32"]))
        at += r["n_tokens"]


def test_round_trip_of_awkward_rows(spark, library, root):
    docs = edge(spark)
    tokenids.write_token_ids(docs, f"{root}/ids", PATH, file_bytes=20_000)
    check(library, [r[:2] for r in edge_rows()], tokenids.read_documents(spark, f"{root}/ids").collect())
    assert not (Path(root) / "ids" / "_temporary").exists()


def test_empty_table(spark, root):
    tokenids.write_token_ids(empty(spark), f"{root}/ids", PATH)
    assert tokenids.read_documents(spark, f"{root}/ids").count() == 0


def test_keyed_access(spark, library, root):
    rows = [(3 * i, f"text number {i} " * (i % 7)) for i in range(300)] + [(30, "again")] * 200 + [(None, "no key")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    tokenids.write_token_ids(docs, f"{root}/ids", PATH, file_bytes=500)
    keys = spark.createDataFrame([(0,), (30,), (31,), (597,), (597,), (-5,), (10_000,), (None,)], "doc_id long")
    found = {}
    for r in tokenids.fetch(spark, f"{root}/ids", keys).collect():
        found.setdefault(r["doc_id"], []).append(tuple(r["ids"]))
    assert set(found) == {0, 30, 597, None}
    for key, got in found.items():
        assert sorted(got) == sorted(tuple(whole(library, t) + [0]) for i, t in rows if i == key)
    check(library, rows, tokenids.read_documents(spark, f"{root}/ids").collect())


def test_damaged_payload_is_noticed(spark, root):
    tokenids.write_token_ids(spark.createDataFrame([(1, "some words")], "doc_id long, text string"), f"{root}/ids", PATH)
    payload = next(Path(root, "ids").glob("*.bin"))
    payload.write_bytes(b"\0" * payload.stat().st_size)
    with pytest.raises(Exception, match="digest"):
        tokenids.read_documents(spark, f"{root}/ids").collect()


@pytest.mark.parametrize("n", [0, 1, 2, 17, 20_000])
def test_hash_is_minimal_and_perfect(n):
    keys = np.random.default_rng(n).choice(2**62, n, replace=False).astype(np.uint64)
    hashing = MinimalPerfectHash.build(keys)
    assert np.array_equal(np.sort(hashing.slots(keys)), np.arange(n))
    again = MinimalPerfectHash(hashing.sizes, hashing.bits)
    assert np.array_equal(again.slots(keys), hashing.slots(keys))


def test_equal_keys_have_no_perfect_hash():
    with pytest.raises(ValueError):
        MinimalPerfectHash.build(np.array([5, 5], np.uint64))


def test_strange_keys_are_told_by_fingerprints():
    raw = tokenids.pack_index([*range(0, 20_000, 2)], np.arange(1, 10_001), 2)
    index = tokenids.Index(raw)
    first, count = index.lookup(np.arange(20_000))
    assert np.array_equal(count, np.tile([1, 0], 10_000)) and np.array_equal(first[::2], np.arange(10_000))


def test_documents_of_the_tables(spark, library):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(library, rows, tokenids.op12_token_ids(spark, sf).collect())


def test_words_across_a_lines_end_are_not_remembered_together():
    encoder = tokenids.Encoder(PATH)
    texts = [f"say word{'abcdefghij'[a]}.\nThen{'klmnopqrst'[b]} more" for a in range(10) for b in range(10)]
    for text in texts * 2:
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == whole(LIBRARY, text)
    assert len(encoder.pieces.now) < 30 and len(encoder.parts.now) < 30


def test_white_space_at_the_end_is_not_remembered():
    encoder = tokenids.Encoder(PATH)
    for text in ["x foo\n", "x foo\n bar", "x ", "x  y", "\n a b", "x foo\n\n", "a\xa0 b", "a\xa0", "x foo \n", "x foo \n y", " ", "  ", " a", "foo\n", "foo\n x"] * 2:
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == whole(LIBRARY, text), repr(text)
