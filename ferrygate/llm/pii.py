"""Personal data: base detectors, and sanitisation of terms that disclose a protected entity.

The base detectors find e-mail addresses, IPv4 addresses, card numbers and phone numbers. Each distinct value found is a
protected entity. Terms (runs of letters) within ``WINDOW`` words of it are its context. Over the whole corpus a
term ``t`` discloses an entity ``c`` by the pointwise mutual information ``log2(P(c, t) / (P(c) P(t)))``, where the probabilities
are shares of documents. The most a term can disclose is the entity's information content ``-log2 P(c)``. A term that discloses at
least ``DISCLOSURE`` of it, seen with the entity in at least ``SUPPORT`` distinct texts, stands for the entity and is marked as a
``term`` span wherever it occurs, in every text, also where the entity itself is not printed; ``sanitise`` removes base spans and generalises terms to their shape.

Counts cover all documents. What is counted per term is combined within tasks and before every shuffle; pairs are limited by the contexts of
entities, not by pairs of words. An entity that a third of the documents mention is a grouping key with partial
aggregation, never a group in one task.

Defined cases: a null text counts as empty; repeated rows are reported one by one, equal texts count as one text for the support; null ids
are kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import FILE_KEY, ROW_KEY, table, with_row_key

KINDS = ["email", "ip", "card", "phone"]
WINDOW, SUPPORT, DISCLOSURE = 6, 3, 0.9
#: Distinct terms a task combines before it passes them on.
COMBINED = 500_000
#: Code points of context kept on either side of an entity while its words are cut out.
REACH = 400

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A later start within a run of digits never matches where the first one failed, hence the look-behind.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: a name runs as far left of its ``@`` as the class or the previous match allows."""
    done = 0
    for match in _DOMAIN.finditer(text):
        at = start = match.start()
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at:
            yield start, match.end()
            done = match.end()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by kind as listed, then by start."""
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in emails(text)]
    if any(d in text for d in "0123456789"):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:] if len(p) > 3 else p) <= 255 for p in m.group().split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = re.sub(r"[ -]", "", m.group())
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


def span_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with blanks in place of all base spans."""
    parts, at = [], 0
    for start, end in sorted((a, b) for _, a, b in spans):
        if end > at:
            start = max(start, at)
            parts += [text[at:start], " " * (end - start)]
            at = end
    return "".join([*parts, text[at:]])


def _context(text: str, start: int, end: int) -> Iterator[tuple[str, int, int]]:
    """Terms among the ``WINDOW`` words before and after a span of a masked text."""
    lo, hi = max(0, start - REACH), min(len(text), end + REACH)
    before = list(re.finditer(r"\S+", text[lo:start]))[-WINDOW:]
    after = list(re.finditer(r"\S+", text[end:hi]))[:WINDOW]
    for words, offset in ((before, lo), (after, end)):
        for word in words:
            for m in _TERM.finditer(word.group()):
                yield m.group().lower(), offset + word.start() + m.start(), offset + word.start() + m.end()


FOUND = (
    f"doc_id long, {FILE_KEY} long, {ROW_KEY} long, text_key string, spans string, "
    "n_email long, n_ip long, n_card long, n_phone long, contexts array<struct<entity:string,term:string,start:int,end:int>>"
)


def detect(keyed: DataFrame) -> DataFrame:
    """Base spans of every row of ``with_row_key(docs)`` and the context terms of each entity found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, file_key, row_key in zip(*(c.to_pylist() for c in batch.columns)):
                text = text or ""
                spans = base_spans(text)
                kinds = Counter(k for k, _, _ in spans)
                masked = _masked(text, spans) if spans else ""
                contexts = [
                    {"entity": f"{k}:{text[a:b].lower()}", "term": term, "start": s, "end": e}
                    for k, a, b in spans
                    for term, s, e in _context(masked, a, b)
                ]
                key = hashlib.md5(text.encode("utf-8", "replace")).hexdigest() if spans else None
                rows.append((doc_id, file_key, row_key, key, span_text(spans), *(kinds[k] for k in KINDS), contexts))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _FOUND_TYPES)], names=_FOUND_NAMES)

    return keyed.select(F.col("doc_id").cast("long").alias("doc_id"), "text", FILE_KEY, ROW_KEY).mapInArrow(run, FOUND)


_FOUND_NAMES = ["doc_id", FILE_KEY, ROW_KEY, "text_key", "spans", *(f"n_{k}" for k in KINDS), "contexts"]
_FOUND_TYPES = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 4 + [
    pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
]


def term_frequencies(docs: DataFrame) -> DataFrame:
    """``(term, texts)``: in how many documents a term occurs, over whole texts of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def passed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["term", "n"])

        for batch in batches:
            for text in batch.column(0):
                counts.update(set(_TERM.findall((text.as_py() or "").lower())))
                if len(counts) >= COMBINED:
                    yield passed()
                    counts.clear()
        yield passed()

    return docs.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("texts"))


def disclosing_terms(found: DataFrame, docs: DataFrame) -> DataFrame:
    """``(entity, term, pmi, content)`` of the pairs that exceed the disclosure threshold."""
    total = found.count()
    pairs = found.select("text_key", FILE_KEY, ROW_KEY, F.explode("contexts").alias("c")).select(
        "text_key", FILE_KEY, ROW_KEY, "c.entity", "c.term"
    ).distinct()
    together = (
        pairs.groupBy("entity", "term", "text_key")
        .agg(F.count("*").alias("n"))
        .groupBy("entity", "term")
        .agg(F.sum("n").alias("both"), F.count("*").alias("support"))
        .filter(F.col("support") >= SUPPORT)
    )
    entities = (
        pairs.select("entity", FILE_KEY, ROW_KEY).distinct().groupBy("entity").agg(F.count("*").alias("entity_texts"))
    )
    terms = term_frequencies(docs)
    scored = together.join(entities, "entity").join(terms, "term")
    content = -F.log2(F.col("entity_texts") / F.lit(float(total)))
    pmi = F.log2(F.col("both") * F.lit(float(total)) / (F.col("entity_texts") * F.col("texts")))
    return scored.select("entity", "term", pmi.alias("pmi"), content.alias("content")).filter(
        (F.col("content") > 0) & (F.col("pmi") >= DISCLOSURE * F.col("content"))
    )


def term_places(keyed: DataFrame) -> DataFrame:
    """Per row and term: all its places in the whole text outside base spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, file_key, row_key in zip(*(c.to_pylist() for c in batch.columns)):
                text = text or ""
                spans = base_spans(text)
                places: dict[str, list[dict[str, int]]] = {}
                for m in _TERM.finditer(_masked(text, spans) if spans else text):
                    places.setdefault(m.group().lower(), []).append({"start": m.start(), "end": m.end()})
                if places:
                    n = len(places)
                    columns = [[file_key] * n, [row_key] * n, list(places), list(places.values())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PLACE_TYPES)], names=_PLACE_NAMES)

    schema = f"{FILE_KEY} long, {ROW_KEY} long, term string, places array<struct<start:int,end:int>>"
    return keyed.select("text", FILE_KEY, ROW_KEY).mapInArrow(run, schema)


_PLACE_NAMES = [FILE_KEY, ROW_KEY, "term", "places"]
_PLACE_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]


def protect(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: base counts and spans, and the spans of disclosing terms."""
    keyed = with_row_key(docs)
    found = materialize(detect(keyed), "pii-found")
    flagged = materialize(disclosing_terms(found, docs).select("term").distinct(), "pii-flagged")
    # without a flagged term the texts need not be read again
    places = keyed.limit(0) if flagged.isEmpty() else keyed
    added = (
        term_places(places)
        .join(flagged, "term", "left_semi")
        .select(FILE_KEY, ROW_KEY, F.explode("places").alias("place"))
        .groupBy(FILE_KEY, ROW_KEY)
        .agg(F.array_sort(F.collect_list("place")).alias("terms"))
    )
    added = materialize(added, "pii-terms")
    term_text = F.transform("terms", lambda s: F.concat_ws(":", F.lit("term"), s["start"].cast("string"), s["end"].cast("string")))
    return found.drop("contexts", "text_key").withColumnRenamed("spans", "base").join(added, [FILE_KEY, ROW_KEY], "left").select(
        "*",
        F.array_join(
            F.array_compact(F.concat(F.array(F.when(F.col("base") != "", F.col("base"))), F.coalesce(term_text, F.array().cast("array<string>")))), ","
        ).alias("spans"),
    )


def sanitise(text: str, spans: str) -> str:
    """``text`` with base spans replaced by their kind and terms generalised to ``[TERM]``."""
    cuts = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",") if s))
    out, at = [], 0
    for start, end, kind in cuts:
        if start < at:
            continue
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return protect(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"), "spans"
    )
