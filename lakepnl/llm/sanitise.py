"""Information-theoretic sanitisation of personal data.

Protected entities are the personal data themselves: e-mail addresses, IP addresses, payment
cards and phone numbers, found by fixed patterns. A term (any word of a text with an entity)
reveals the entity when meeting the term tells most of what there is to know about the entity: with
IC(e) = log(N / n_e), PMI(e; t) = log(n_et N / (n_e n_t)) and document counts over the whole
corpus, the disclosure of t is PMI / IC(e), which is 1 if every document with t has e and 0
if they are independent. Terms at REMOVE or more are removed from documents with the entity,
terms at GENERALISE or more are replaced by the kind of the entity.

A pair counts only with MIN_CONTEXTS different documents, and with half as many different documents
as different texts: what near-copies of one document share says nothing about an entity in them.
Documents differ if the least hashes of their word windows do; of the counts in ORDERS orders of hashes
the second least is taken, so near-copies mostly count as one. Equal texts count once here, so copies neither make a pair
nor unmake it. The documents of a pair must be more than chance gives: with d different ones,
d PMI is log N at least, as words met a few times stand beside a frequent entity anyway.

Entities come out of one pass over all texts. Only texts with an entity of MIN_CONTEXTS different
documents give terms, and only those that MIN_CONTEXTS of an entity's texts share are counted in
a second pass, in which a bitmap of fixed size passes on the few words that can be terms; exact counts are
made from those. Documents are told apart for pairs that disclose enough. No text without an entity is shuffled.

Null and empty texts have no spans. A null id is an id like any other: spans go by the text. Repeated
rows get the same spans. Columns named like the added ones are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepnl.llm.text import ALNUM, Words, saved, slices, small_batches, words

KINDS = ("email", "ip", "card", "phone")
REMOVED, GENERALISED = "term", "hint"
MIN_CONTEXTS, GENERALISE, REMOVE = 3, 0.7, 0.9
WINDOW, ORDERS = 5, 9
BITMAP = 1 << 22
#: Rows of terms that a task counts before it hands them on.
AT_ONCE = 1 << 20

#: The patterns of the contract. Possessive runs and a look behind keep them linear.
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[int, int, int, str]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of [A-Za-z0-9._%+-]+@domain, looked for at each @ so that long words cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL_CHARS:
            first -= 1
        domain = _DOMAIN.match(text, at + 1) if first < at else None
        if domain:
            yield first, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(first, last, kind, normal form) by first, then kind; ends in code points, last exclusive."""
    if not _ANY.search(text):
        return []
    found = [(a, b, 0, text[a:b].lower()) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((*m.span(), 1, m[0]))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((*m.span(), 2, digits))
    for m in _PHONE.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 10 <= len(digits) <= 15:
            found.append((*m.span(), 3, digits))
    return sorted(found, key=lambda s: (s[0], s[2]))


def _long(value: str) -> int:
    return xxhash.xxh64_intdigest(value) - (1 << 63)


def text_words(text: str) -> tuple[Words, np.ndarray]:
    """Words of one text, and the code point at which each byte's character stands."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    place = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return words(data, np.array([0, len(data)]), ALNUM), place


def free_words(text: str, spans: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First, last and hash of the words that touch none of the spans (first, last, ...)."""
    found, place = text_words(text)
    first, last = place[found.start], place[found.end]
    covered = np.zeros(len(text) + 1, np.int32)
    for a, b, *_ in spans:
        covered[a] += 1
        covered[b] -= 1
    before = np.concatenate(([0], np.cumsum(np.cumsum(covered) > 0)))
    free = before[last] == before[first]
    return first[free], last[free], found.hashes().view(np.int64)[free]


def sketch(text: str) -> list[int]:
    """The least hash of the text's windows of WINDOW words in each of ORDERS orders."""
    own = text_words(text)[0].hashes()
    windows = np.zeros(max(1, len(own) - WINDOW + 1), np.uint64)
    for k in range(min(WINDOW, len(own))):
        windows = windows * np.uint64(0x9E3779B97F4A7C15) + own[k : k + len(windows)]
    made = []
    for order in range(1, ORDERS + 1):
        mixed = (windows ^ (windows >> np.uint64(29))) * np.uint64(2 * order * 0xBF58476D1CE4E5B9 + 1 & (1 << 64) - 1)
        made.append(int((mixed ^ (mixed >> np.uint64(32))).min().view(np.int64)))
    return made


_SPAN = T.StructType().add("first", "long").add("last", "long").add("kind", "string").add("entity", "long")
_ARROW_SPAN = pa.list_(
    pa.struct([("first", pa.int64()), ("last", pa.int64()), ("kind", pa.string()), ("entity", pa.int64())])
)


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, spans and, where there are spans, the text, its hash and its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, texts, keys, sketches = [], [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                own = base_spans(text)
                spans.append(
                    [{"first": a, "last": b, "kind": KINDS[k], "entity": _long(f"{k}:{v}")} for a, b, k, v in own]
                )
                texts.append(text if own else None)
                keys.append(_long(text) if own else None)
                sketches.append(sketch(text) if own else None)
            made = [
                pa.array(spans, _ARROW_SPAN),
                pa.array(texts, pa.string()),
                pa.array(keys, pa.int64()),
                pa.array(sketches, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *made], ["doc_id", "spans", "text", "text_hash", "sketch"]
            )

    schema = (
        T.StructType()
        .add("doc_id", "string")
        .add("spans", T.ArrayType(_SPAN))
        .add("text", "string")
        .add("text_hash", "long")
        .add("sketch", T.ArrayType(T.LongType()))
    )
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, schema
    )


def words_of(held: DataFrame) -> DataFrame:
    """text_hash and term, once each, for the words of texts that are no entity themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                terms = np.unique(free_words(text, [(s["first"], s["last"]) for s in spans])[2])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(terms), key, np.int64)), pa.array(terms)], ["text_hash", "term"]
                )

    return held.select("text_hash", "text", "spans").mapInArrow(run, "text_hash long, term long").distinct()


def document_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term and n_t, the number of documents that have it, for the column term."""
    spark = docs.sparkSession
    marked = terms.select(F.pmod("term", F.lit(BITMAP)).alias("bit")).distinct()
    bits = np.zeros(BITMAP, bool)
    bits[[r["bit"] for r in marked.collect()]] = True
    shared = spark.sparkContext.broadcast(np.packbits(bits))

    def counted(held: list[pd.Series]) -> pa.RecordBatch:
        counts = pd.concat(held).groupby(level=0).sum()
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.index.to_numpy(np.int64)), pa.array(counts.to_numpy(np.int64))], ["term", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(shared.value).astype(bool)
        held, rows = [], 0
        for batch in batches:
            for _, _, data, offsets in slices(batch):
                found = words(data, offsets, ALNUM)
                hashes = found.hashes().view(np.int64)
                own = wanted[hashes % BITMAP]
                document = np.repeat(np.arange(len(offsets) - 1), found.counts())[own]
                pairs = pd.DataFrame({"term": hashes[own], "document": document}).drop_duplicates()
                held.append(pairs.groupby("term").size())
                rows += len(held[-1])
                if rows >= AT_ONCE:
                    yield counted(held)
                    held, rows = [], 0
        if held:
            yield counted(held)

    seen = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "term long, n long")
    # Counted first: the tasks hand on a row for each of their terms, and one for each term meets the wanted ones.
    seen = saved(seen.groupBy("term").agg(F.sum("n").alias("n_t")), "term-counts")
    return seen.join(terms.select("term").distinct(), "term", "left_semi")


def different(sketches: str = "sketch") -> Column:
    """How many different documents the sketches of a group's texts are of: the second least of the counts by order."""
    return F.sort_array(F.array(*[F.count_distinct(F.get(F.col(sketches), F.lit(k))) for k in range(ORDERS)]))[1]


def disclosures(
    found: DataFrame,
    docs: DataFrame,
    min_contexts: int = MIN_CONTEXTS,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
) -> DataFrame:
    """entity, term, disclosure and action (term: remove, hint: generalise) of revealing pairs."""
    held = found.where("text_hash is not null")
    n = float(max(1, docs.count()))
    own = held.select("text_hash", "sketch", F.explode(F.array_distinct("spans.entity")).alias("entity"))
    texts = saved(own.groupBy("entity", "text_hash").agg(F.count("*").alias("copies"), F.any_value("sketch").alias("sketch")), "entity-texts")
    entities = texts.groupBy("entity").agg(F.sum("copies").alias("n_e"), different().alias("n_docs"))
    entities = entities.where((F.col("n_docs") >= min_contexts) & (F.col("n_e") < n))
    texts = saved(texts.join(entities.select("entity", "n_e"), "entity"), "known-entities")
    terms = saved(words_of(held.join(texts.select("text_hash").distinct(), "text_hash", "left_semi")), "entity-words")
    pairs = terms.join(texts, "text_hash")
    both = pairs.groupBy("entity", "term").agg(F.sum("copies").alias("n_et"), F.count("*").alias("n_texts"), F.max("n_e").alias("n_e"))
    both = saved(both.where(F.col("n_texts") >= min_contexts), "entity-terms")
    seen = document_counts(docs, both)
    pmi = F.log(F.col("n_et") * F.lit(n) / (F.col("n_e") * F.greatest("n_t", "n_et")))
    likely = both.join(seen, "term").withColumns({"pmi": pmi, "disclosure": pmi / F.log(F.lit(n) / F.col("n_e"))})
    likely = saved(likely.where(F.col("disclosure") >= generalise).select("entity", "term", "n_texts", "pmi", "disclosure"), "likely")
    support = pairs.select("entity", "term", "sketch").join(likely, ["entity", "term"], "left_semi")
    support = support.groupBy("entity", "term").agg(different().alias("n_docs"))
    made = likely.join(support, ["entity", "term"]).where(
        (F.col("n_docs") >= min_contexts) & (2 * F.col("n_docs") >= F.col("n_texts")) & (F.col("n_docs") * F.col("pmi") >= F.log(F.lit(n)))
    )
    return made.select(
        "entity", "term", "disclosure", F.when(F.col("disclosure") >= remove, REMOVED).otherwise(GENERALISED).alias("action")
    )


def find_spans(docs: DataFrame, **limits: float) -> DataFrame:
    """doc_id, base_spans, spans (base ones and revealing terms) and sanitised (null without spans)."""
    small_batches(docs.sparkSession)
    found = saved(detect(docs), "personal-data")
    flagged = saved(disclosures(found, docs, **limits), "disclosures")
    held = found.where("text_hash is not null")
    entities = held.select("text_hash", F.explode(F.array_distinct("spans.entity")).alias("entity")).distinct()
    terms = entities.join(flagged, "entity").groupBy("text_hash", "term").agg(F.max("action").alias("action"))
    terms = terms.groupBy("text_hash").agg(F.collect_list(F.struct("term", "action")).alias("terms"))

    @F.pandas_udf("spans array<struct<first:long,last:long,kind:string>>, sanitised string")
    def complete(texts: pd.Series, spans: pd.Series, terms: pd.Series) -> pd.DataFrame:
        rows = []
        for text, base, own in zip(texts, spans, terms, strict=True):
            made = [(s["first"], s["last"], s["kind"]) for s in base]
            if own is not None and len(own):
                made += term_spans(text, made, {t["term"]: t["action"] for t in own})
            rows.append(([dict(zip(("first", "last", "kind"), s, strict=True)) for s in made], rewritten(text, made)))
        return pd.DataFrame(rows, columns=["spans", "sanitised"])

    own = held.join(terms, "text_hash", "left").withColumn("_made", complete("text", "spans", "terms"))
    own = own.select("doc_id", F.col("spans").alias("base_spans"), "_made.spans", "_made.sanitised")
    none = found.where("text_hash is null").select(
        "doc_id",
        F.col("spans").alias("base_spans"),
        F.expr("cast(array() as array<struct<first:bigint,last:bigint,kind:string>>)").alias("spans"),
        F.lit(None).cast("string").alias("sanitised"),
    )
    return own.unionByName(none).withColumn("doc_id", F.col("doc_id").cast("long"))


def term_spans(text: str, base: list[tuple[int, int, str]], actions: dict[int, str]) -> list[tuple[int, int, str]]:
    """Every occurrence of the terms in the text that touches no base span."""
    found = zip(*(x.tolist() for x in free_words(text, base)), strict=True)
    return [(a, b, actions[h]) for a, b, h in found if h in actions]


def rewritten(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """The text with entities replaced by their kind, hints by a mark and terms left out."""
    if text is None or not spans:
        return None
    out, at = [], 0
    for a, b, kind in sorted(spans):
        if b <= at:
            continue
        out += [text[at : max(a, at)], "" if kind == REMOVED else f"<{kind}>"]
        at = b
    return "".join([*out, text[at:]])


def listed(spans: Column | str) -> Column:
    """kind:start:end of all spans by start, then kind as listed (email, ip, card, phone, term, hint)."""
    order = F.array(*[F.lit(k) for k in (*KINDS, REMOVED, GENERALISED)])
    spans = F.col(spans) if isinstance(spans, str) else spans
    keyed = F.transform(
        spans, lambda s: F.struct(s["first"].alias("a"), F.array_position(order, s["kind"]).alias("k"), s["last"].alias("b"), s["kind"].alias("kind"))
    )
    texts = F.transform(F.sort_array(keyed), lambda s: F.concat_ws(":", s["kind"], s["a"].cast("string"), s["b"].cast("string")))
    return F.concat_ws(",", texts)
