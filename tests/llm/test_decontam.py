"""Latent retrieval that decides rows, and the screen before it."""

import random
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).parent))

from corpus import LONG, benchmark, edge_rows

from ferrygate.llm import decontam


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_synonyms_with_the_answer_are_found_in_the_latent_space(spark):
    rng = random.Random(4)
    said = lambda topic, n, forms="xy": " ".join(f"t{topic}c{rng.randrange(14)}{rng.choice(forms)}" for _ in range(n))
    items = [f"{said(t, 24, 'x')}. reply{t}a reply{t}b reply{t}c reply{t}d." for t in range(6)]
    answers = [i.split(". ")[1] for i in items]
    texts = [said(n % 50, 250) for n in range(500)]  # both forms of a word stand in the same company
    found = len(texts)
    texts += [f"{said(5 - t, 80)} {said(t, 40, 'y')} {answers[t]} {said(5 - t, 80)}" for t in range(6)]  # no word of the question
    texts += [f"{said(5 - t, 110)} {answers[t]} {said(5 - t, 80)}" for t in range(6)]  # the answer in other company
    texts += [f"{said(5 - t, 80)} {said(t, 36, 'y')} {said(5 - t, 80)}" for t in range(6)]  # no answer
    rows = decontam.find_leaks(frame(spark, texts), benchmark(spark, *items)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(found + t, t) for t in range(6)}
    assert all(r["answer_found"] and r["lcs_share"] < decontam.PARAPHRASE for r in rows)


def test_the_space_is_fitted_to_every_passage(spark):
    rng = random.Random(9)
    said = lambda topic, n, forms="xy": " ".join(f"t{topic}c{rng.randrange(14)}{rng.choice(forms)}" for _ in range(n))
    other = lambda n: " ".join(f"other{rng.randrange(5000)}" for _ in range(n))
    items = [f"{said(t, 24, 'x')}. reply{t}a reply{t}b reply{t}c reply{t}d." for t in range(6)]
    # both forms of a word meet only in every other passage, and are rarer than thousands of other words
    texts = [" ".join(other(32) + " " + (said((4 * n + k) % 50, 32) if n < 100 else other(32)) for k in range(4)) for n in range(400)]
    found = len(texts)
    texts += [f"{other(80)} {said(t, 40, 'y')} {items[t].split('. ')[1]} {other(80)}" for t in range(6)]
    texts += [f"{other(120)} {items[t].split('. ')[1]} {other(80)}" for t in range(6)]
    rows = decontam.find_leaks(frame(spark, texts), benchmark(spark, *items)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(found + t, t) for t in range(6)}


def test_products_with_the_corpus_equal_those_with_its_table(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BUCKETS", 64)  # words share columns, with either sign
    rng, names = random.Random(3), [f"w{i}" for i in range(900)]
    texts = [" ".join(rng.choices(names, [1 / (i + 1) for i in range(len(names))], k=rng.randrange(200))) for _ in range(300)]
    texts += [None, "", " . ", "one", " ".join(["same"] * 70), LONG]
    vocabulary = np.unique(decontam.word_hashes(" ".join(names[::9])))
    v = len(vocabulary)
    size = v + 2 * decontam.BUCKETS
    corpus = decontam.corpus_passages(frame(spark, texts), vocabulary)
    passages = [h[a : a + decontam.PASSAGE] for h in (decontam.word_hashes(t or "") for t in texts) for a in range(0, len(h), decontam.PASSAGE)]
    table = np.zeros((len(passages), size))
    for row, words in zip(table, passages):
        np.add.at(row, decontam._latent_terms(decontam._lookup(words, vocabulary, decontam._sieve(vocabulary)), words, v), 1)
    counts, n = decontam.term_counts(corpus, size)
    assert n == len(passages) and np.array_equal(counts, (table > 0).sum(axis=0))
    products = decontam.Corpus(np.log((n + 1.0) / (counts + 1.0)) + 0.05, v)
    table = table * products.idf / np.linalg.norm(table * products.idf, axis=1)[:, None]
    signed = table[:, v::2] - table[:, v + 1 :: 2]
    table = np.append(table[:, :v], signed, axis=1)
    basis = np.random.default_rng(1).standard_normal((table.shape[1], 7))
    assert np.allclose(decontam._gathered(corpus, 7, len(basis), lambda f: products.normal(f, basis)), table.T @ (table @ basis), atol=1e-3)
    assert np.allclose(decontam._gathered(corpus, 7, 7, lambda f: products.gram(f, basis)), (table @ basis).T @ (table @ basis), rtol=1e-4, atol=1e-2)


def test_groups_of_texts_hold_each_texts_words(monkeypatch):
    monkeypatch.setattr(decontam, "GROUP", 5000)
    texts = [r[1] for r in edge_rows()] + [None, "", " . "] + [f"some {i} words" * (i % 90) for i in range(300)] + [LONG, "end"]
    seen = 0
    for first, words, bounds in decontam.grouped(pa.array(texts)):
        assert first == seen
        for i in range(len(bounds) - 1):
            assert np.array_equal(words[bounds[i] : bounds[i + 1]], decontam.word_hashes(texts[first + i] or ""))
        seen += len(bounds) - 1
    assert seen == len(texts)


def test_the_screen_loses_no_candidate(spark, monkeypatch):
    rng, names = random.Random(6), [f"w{i}" for i in range(4000)]
    zipf = lambda k: rng.choices(names, [1 / (i + 2) for i in range(len(names))], k=k)
    items = [zipf(rng.randrange(6, 70)) for _ in range(40)]
    texts = [""]
    for n in range(300):
        part = rng.choice(items)
        part = [w if rng.random() < 0.7 else rng.choice(names) for w in part[rng.randrange(len(part)) :]]
        texts.append(" ".join(zipf(rng.randrange(0, 150)) + part + zipf(rng.randrange(0, 150))))
    texts.append(" ".join(zipf(150_000)))
    cut = [decontam._item(n, " ".join(i)) for n, i in enumerate(items)]
    space = decontam.build_space(spark, frame(spark, texts), cut)
    sieve, exact = decontam._sieve(space.vocabulary), (space.held * (space.weight**2)[:, None] / space.norm).astype(np.float32)

    def candidates():
        return [
            {key: sorted(near) for key, near in decontam._candidates(words, bounds, space, sieve, space.screen(), exact).items()}
            for _, words, bounds in decontam.grouped(pa.array(texts))
        ]

    def everywhere(terms, bounds, space, screen):
        places = [(t, a, p) for t, (lo, hi) in enumerate(zip(bounds, bounds[1:])) for a in range(lo, hi, decontam.COARSE) for p in range(len(space.length))]
        return tuple(np.array(x) for x in zip(*places))

    screened, looked = candidates(), []
    screen_of = decontam._places
    monkeypatch.setattr(decontam, "_places", lambda *a: (looked.append((len(screen_of(*a)[0]), len(everywhere(*a)[0]))), everywhere(*a))[1])
    assert screened == candidates() and sum(map(len, screened)) > 200
    assert sum(n for n, _ in looked) < sum(n for _, n in looked) / 4
