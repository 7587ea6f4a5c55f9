"""Personal data, and terms that give it away.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers by
pattern. The value of a span is a protected entity. Over the whole corpus three
counts say how strongly a term reveals an entity: documents that mention the
entity, documents that have the term, and documents that have both. A term's
disclosure of an entity is their pointwise mutual information over the entity's
information content, log(N c(e,t) / (c(e) c(t))) / log(N / c(e)): 1 if the term
occurs only in documents with the entity, 0 if it says nothing.

A pair also needs evidence, as in a large corpus every rare word beside an
address has a high measure. A term reveals an entity if its disclosure is
``GENERALISE`` or more and the entity is mentioned in at least ``PROBABLE`` of the
term's documents, pairs seen in one document judged like any other. In documents
that mention the entity such terms are masked. In other documents they are
masked if the lower confidence bound (Wilson, one-sided, 95 %) of that share is
``SURE`` or more: one document says too little about a word that stands elsewhere
too. Terms at or above ``GENERALISE`` are replaced by a general word, those at or
above ``REMOVE`` are removed. Terms are runs of three or more letters or digits
outside base spans.

Texts are read twice: for the counts, which are combined per task before the
shuffle, and for the places of terms, of which only those go into a join that
pass a bit set of fixed size: of terms to mask anywhere, or of all revealing terms
in documents with an entity. Counting takes time in proportion to a document's
distinct entities times its distinct terms. A term reveals at most ``1 / PROBABLE``
times as many entities as its documents mention on average.

Defined results: a null text counts as empty; without spans the digest is that of
the empty text; repeated rows get the same spans and count as documents each; a
kept column named like a result gets underscores at its end;
no term is judged in an empty corpus or where an entity is in every document.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.storage import land

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
GENERALISE = 0.7
REMOVE = 0.95
PROBABLE = 0.5
SURE = 0.25
Z = 1.645  # normal quantile of 95 %
COUNTS_AT_ONCE = 200_000
BITS = 1 << 22

# The base patterns. Possessive forms match the same and never go back.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\W_]{3,}")

Span = tuple[int, int, str]  # start, end, entity


def _emails(text: str) -> Iterator[Span]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            last = m.end()
            yield start, last, "email:" + text[start:last].lower()
        at = text.find("@", last if m else at + 1)


def _ips(text: str) -> Iterator[Span]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            yield m.start(), m.end(), "ip:" + ".".join(p or "0" for p in parts)


def luhn(digits: str) -> bool:
    doubled = (int(c) * 2 for c in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 37:
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.start(), m.end(), "card:" + digits


def _phones(text: str) -> Iterator[Span]:
    if "+" in text:
        for m in _PHONE.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if 8 <= len(digits) <= 15:
                yield m.start(), m.end(), "phone:" + digits


def base_spans(text: str) -> dict[str, list[Span]]:
    return {k: list(f(text)) for k, f in zip(KINDS, (_emails, _ips, _cards, _phones))}


def _read(text: str) -> tuple[list[dict], set[str], str]:
    """Base spans, entities, and the text with blanks for base spans."""
    found = base_spans(text)
    spans = [{"kind": k, "start": a, "stop": b} for k in KINDS for a, b, _ in found[k]]
    parts, at = [], 0
    for a, b in sorted((s["start"], s["stop"]) for s in spans):
        if b > at:
            parts += [text[at:a], " " * (b - max(a, at))]
            at = b
    return spans, {e for k in KINDS for _, _, e in found[k]}, "".join([*parts, text[at:]])


_COUNTS = pa.schema([("entity", pa.string()), ("term", pa.string()), ("n", pa.int64())])
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
_PLACE = pa.struct([("term", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])


_ROWS = (
    "row bigint, entities array<string>, spans array<struct<kind: string, start: bigint, stop: bigint>>, "
    "places array<struct<term: string, start: bigint, stop: bigint>>"
)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document counts by entity, by term, by both, and of all (both null)."""
    counts: Counter = Counter()

    def counted() -> pa.RecordBatch:
        columns = [[k[0] for k in counts], [k[1] for k in counts], list(counts.values())]
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _COUNTS)], schema=_COUNTS)
        counts.clear()
        return out

    for batch in batches:
        counts[None, None] += batch.num_rows
        for t in batch[0]:
            _, entities, rest = _read(t.as_py() or "")
            terms = {w.lower() for w in set(_WORD.findall(rest))}
            for entity in (None, *entities):
                if entity is not None:
                    counts[entity, None] += 1
                counts.update((entity, w) for w in terms)
                if len(counts) > COUNTS_AT_ONCE:
                    yield counted()
    if counts:
        yield counted()


def _bit(term: str) -> int:
    return xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass")) % BITS


def _bits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bit set of a task's terms."""
    bits = np.zeros(BITS, bool)
    for batch in batches:
        for t in batch[0].to_pylist():
            bits[_bit(t)] = True
    if bits.any():
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], ["bits"])


def _bit_set(terms: DataFrame) -> np.ndarray:
    bits = np.zeros(BITS // 8, np.uint8)
    for r in terms.mapInArrow(_bits_of, "bits binary").toLocalIterator():
        bits |= np.frombuffer(r.bits, np.uint8)
    return bits


def _scan(batches: Iterator[pa.RecordBatch], kept: list[str], anywhere: np.ndarray, beside: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of documents, with their entities and the places of terms that may be revealing:
    those of ``beside`` in documents with an entity, of ``anywhere`` in the others."""
    row = TaskContext.get().partitionId() << 33
    known: dict[str, tuple[bool, bool]] = {}

    def revealing(word: str) -> tuple[bool, bool]:
        if word not in known:
            if len(known) >= COUNTS_AT_ONCE:
                known.clear()
            k = _bit(word.lower())
            known[word] = tuple(bool(bits[k >> 3] >> (7 - (k & 7)) & 1) for bits in (anywhere, beside))
        return known[word]

    for batch in batches:
        spans, places, mentioned = [], [], []
        for t in batch["body"]:
            s, entities, rest = _read(t.as_py() or "")
            which = 1 if entities else 0
            spans.append(s)
            mentioned.append(sorted(entities))
            some = any(revealing(w)[which] for w in set(_WORD.findall(rest)))
            hits = (m for m in _WORD.finditer(rest) if revealing(m[0])[which]) if some else ()
            places.append([{"term": m[0].lower(), "start": m.start(), "stop": m.end()} for m in hits])
        n = batch.num_rows
        own = [pa.array(range(row, row + n), pa.int64()), pa.array(mentioned, pa.list_(pa.string()))]
        own += [pa.array(spans, pa.list_(_SPAN)), pa.array(places, pa.list_(_PLACE))]
        row += n
        yield pa.RecordBatch.from_arrays([batch[c] for c in kept] + own, names=[*kept, "row", "entities", "spans", "places"])


def _lower_bound(hits: Column, of: Column) -> Column:
    """Wilson's lower bound of a share."""
    p, z2 = hits / of, Z * Z
    return (p + z2 / (2 * of) - Z * F.sqrt(p * (1 - p) / of + z2 / (4 * of * of))) / (1 + z2 / of)


def revealing_terms(texts: DataFrame) -> DataFrame:
    """``entity``, ``term``, ``disclosure`` and ``sure`` (whether it is masked in documents
    without the entity, too) of the pairs with evidence at or above ``GENERALISE``."""
    counts = land(texts.mapInArrow(_count, "entity string, term string, n bigint").groupBy("entity", "term").agg(F.sum("n").alias("n")), "counts")
    n = counts.filter("entity IS NULL AND term IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    with_entity = counts.filter("entity IS NOT NULL AND term IS NULL").select("entity", F.col("n").alias("c_e"))
    with_term = counts.filter("entity IS NULL AND term IS NOT NULL").select("term", F.col("n").alias("c_t"))
    pairs = counts.filter("entity IS NOT NULL AND term IS NOT NULL").select("entity", "term", F.col("n").alias("c_et"))
    information = F.log(F.lit(float(n)) / F.col("c_e"))
    shared = F.log(F.lit(float(n)) * F.col("c_et") / F.col("c_e") / F.col("c_t"))
    return (
        pairs.join(with_term, "term").filter(F.col("c_et") >= PROBABLE * F.col("c_t"))
        .join(with_entity, "entity").filter(F.col("c_e") < n)
        .select("entity", "term", (shared / information).alias("disclosure"), (_lower_bound(F.col("c_et"), F.col("c_t")) >= SURE).alias("sure"))
        .filter(F.col("disclosure") >= GENERALISE)
    )


def _free(name: str, taken: set[str]) -> str:
    while name in taken:
        name += "_"
    return name


def find_personal_data(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, ``spans`` (base spans by kind and start) and ``terms``
    (revealing terms by start, with their ``disclosure``), one row per document."""
    names: list[str] = []
    for c in keep:
        names.append(_free(c, {"spans", "terms", *names, *(set(keep) - {c})}))
    renamed = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("body"))
    kept = [f"k{i}" for i in range(len(keep))]
    risky = land(revealing_terms(renamed.select("body")), "revealing")
    ship = docs.sparkSession.sparkContext.broadcast
    anywhere, beside = ship(_bit_set(risky.filter("sure").select("term"))), ship(_bit_set(risky.select("term")))
    schema = ", ".join([f"{k} {renamed.schema[k].dataType.simpleString()}" for k in kept] + [_ROWS])
    rows = land(renamed.mapInArrow(lambda batches: _scan(batches, kept, anywhere.value, beside.value), schema), "personal-data")
    placed = rows.filter(F.size("places") > 0).select("row", "entities", F.explode("places").alias("p")).select("row", "entities", "p.*")
    everywhere = risky.filter("sure").groupBy("term").agg(F.max("disclosure").alias("disclosure"))
    told = placed.select("row", "term", "start", "stop").join(everywhere, "term")
    beside_it = placed.filter(F.size("entities") > 0).join(risky.filter("NOT sure"), "term").filter(F.array_contains("entities", F.col("entity")))
    told = told.select("row", "start", "stop", "disclosure").unionByName(beside_it.select("row", "start", "stop", "disclosure"))
    told = told.groupBy("row", "start", "stop").agg(F.max("disclosure").alias("disclosure"))
    by_row = told.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "stop", "disclosure"))).alias("terms"))
    none = F.array().cast("array<struct<start: bigint, stop: bigint, disclosure: double>>")
    return rows.select("row", *kept, "spans").join(by_row, "row", "left").select(
        *[F.col(k).alias(c) for k, c in zip(kept, names)], "spans", F.coalesce("terms", none).alias("terms")
    )


def sanitised(text: str | Column, spans: str | Column, terms: str | Column) -> Column:
    """The text with base spans replaced by their kind, and terms by a general word or nothing."""

    def clean(texts: pa.Array, bases: pa.Array, told: pa.Array) -> pa.Array:
        out = []
        for t, base, near in zip(texts.to_pylist(), bases.to_pylist(), told.to_pylist()):
            if t is None:
                out.append(None)
                continue
            cuts = [(s["start"], s["stop"], f"<{s['kind']}>") for s in base or ()]
            cuts += [(s["start"], s["stop"], "" if s["disclosure"] >= REMOVE else f"<{TERM}>") for s in near or ()]
            parts, at = [], 0
            for a, b, mask in sorted(cuts):
                if a >= at:
                    parts += [t[at:a], mask]
                at = max(at, b)
            out.append("".join([*parts, t[at:]]))
        return pa.array(out, pa.string())

    return F.arrow_udf(clean, "string")(text, spans, terms)
