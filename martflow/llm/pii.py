"""Personal data by pattern, and information-theoretic sanitisation around it.

Patterns find e-mail addresses, IP addresses, card and phone numbers: the
protected entities. Corpus co-occurrence then says how strongly a word reveals
an entity, wherever both stand in a document: with df the documents of a word t, of an entity c and of
both, pointwise mutual information is PMI = log2(N df(t,c) / (df(t) df(c))) and
the entity's information IC = log2(N / df(c)). PMI / IC is 1 for a word that
never occurs without the entity and near 0 for one that tells nothing. Words
above ``generalise`` are replaced by a placeholder, words above ``remove`` are
deleted, wherever they stand in a document that holds that entity.

Entities are single values, and for e-mail addresses also the domain and the
name before it, which many addresses may share. All counts are over all
documents. Only entities of at least ``SUPPORT`` documents can have such words.
The words of all documents are counted first. With df(t,c) <= df(t), a word of
more than N^(1-g) df(c)^g documents stays below the share g of entity c, and
one of fewer than ``SUPPORT`` is no candidate. So each entity is counted only
with the words of its documents that are rare enough for it; tables of hash
slots, sized by the numbers of words and entities, say in the tasks how rare a
word is at least and how frequent an entity at most. Counts are combined in
each task, and joins drop the false hits. What reveals an entity is found the
same way, by a bit filter of fixed size over pairs of entity and word. So texts
are only read, never shuffled: what moves are counts and places.

Defined results: null text counts as empty. Ids are carried, never compared.
Rows that repeat are counted as documents of their own. An entity in every
document has no information, and no word reveals it. Other columns are kept by
``sanitised`` and not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import join_per_key, map_batches
from martflow.operators.joins import replicate
from martflow.session import materialize

KINDS = ("email", "ip", "card", "phone", "term")
SUPPORT = 3  # documents a word and an entity must share
GENERALISE, REMOVE = 0.8, 0.95
SLOTS_A_WORD, MOST_SLOT_BITS = 8, 24  # of the table of how rare words are, one byte a slot
SLOTS_AN_ENTITY, MOST_ENTITY_BITS = 32, 23  # of the table of how frequent entities are
PAIR_BITS = 26  # of the filter of revealing pairs
FLUSH = 200_000  # words counted in a task before they are sent

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NAME = re.compile(r"[^\W\d_]+")

MARKS = (
    "id long, hash long, base array<struct<start:long,rank:int,end:long>>, entities array<long>"
)
TERMS = "array<struct<start:long,rank:int,end:long,disclosure:double>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, looked for from each ``@``."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.fullmatch(text[start - 1]):
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            end = match.end()
            found.append((start, end))
        # Left of the next "@" nothing before this one can belong to a match.
        end = max(end, at + 1)
        at = text.find("@", end)
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by start, then kind; code points, end exclusive."""
    found = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        parts = m[0].split(".")
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _keys(kind: int, text: str) -> list[int]:
    """The entities a base span stands for: its value, and an address's name and domain."""
    plain = text.lower() if kind == 0 else re.sub(r"[^0-9.]", "", text)
    names = [f"{KINDS[kind]} {plain}"]
    if kind == 0:
        name, domain = plain.rsplit("@", 1)
        names += [f"name {name}", f"domain {domain}"]
    return [xxhash.xxh64_intdigest(n) - (1 << 63) for n in names]


def words_outside(text: str, spans: list) -> list[tuple[str, int, int]]:
    """Words that touch no span; ``spans`` rise by start."""
    found, i, reach = [], 0, 0
    for m in NAME.finditer(text):
        s, e = m.span()
        while i < len(spans) and spans[i][0] < e:
            reach = max(reach, spans[i][2])
            i += 1
        if reach <= s:
            found.append((m[0].lower(), s, e))
    return found


def _marker():
    def work(batch):
        out = {"id": batch["id"], "hash": batch["hash"], "base": [], "entities": []}
        for text in batch["text"]:
            spans = base_spans(text) if text else []
            out["base"].append([{"start": s, "rank": k, "end": e} for s, k, e in spans])
            out["entities"].append(sorted({c for s, k, e in spans for c in _keys(k, text[s:e])}))
        return out

    return work


def _combined(keys_of, columns):
    """Counts of the keys each row gives, added up in the task."""

    def make():
        counts: Counter = Counter()

        def sent():
            made = {c: list(v) for c, v in zip([*columns, "n"], zip(*((*k, n) for k, n in counts.items())))}
            counts.clear()
            return made or {c: [] for c in [*columns, "n"]}

        def work(batch):
            for row in zip(*batch.values(), strict=True):
                for key in keys_of(*row):
                    counts[key] += 1
                    if len(counts) > FLUSH:
                        yield sent()

        work.last = sent
        return work

    return make


def _frequency_counter():
    return _combined(lambda text: ((w,) for w in set(NAME.findall((text or "").lower()))), ["term"])


def _slot(word: str, slots: int) -> int:
    return xxhash.xxh64_intdigest(word) & slots - 1


def entities_of(text: str | None, most: np.ndarray) -> tuple[list, list[tuple[int, int]]]:
    """Base spans, and (entity, its slot's mark) for each entity whose slot has any with enough documents."""
    spans = base_spans(text) if text else []
    found = {c for s, k, e in spans for c in _keys(k, text[s:e])}
    return spans, [(c, mark) for c in found if (mark := int(most[c & len(most) - 1]))]


def _pair_counter(least: np.ndarray, most: np.ndarray, limit):
    """Entities with the words that are, as far as ``least`` and ``most`` say, rare enough for them."""

    def pairs(text):
        spans, entities = entities_of(text, most)
        if not entities:
            return
        bounds = sorted(((limit(2.0 ** ((mark - 1) / 4)), c) for c, mark in entities), reverse=True)
        for word in {w for w, _, _ in words_outside(text, spans)}:
            count = 2.0 ** (int(least[_slot(word, len(least))]) / 4)
            for bound, entity in bounds:
                if bound < count:
                    break
                yield entity, word

    return _combined(pairs, ["entity", "term"])


def most_counts(entities: DataFrame) -> np.ndarray:
    """For each hash slot one more than four times the binary logarithm, rounded
    up, of the most documents that one of its entities has; 0 in slots without."""
    bits = max(12, (SLOTS_AN_ENTITY * entities.count()).bit_length())
    slots = 1 << min(MOST_ENTITY_BITS, bits)
    mark = F.ceil(F.log2(F.max("with_entity")) * 4) + 1
    slot = F.col("entity").bitwiseAND(F.lit(slots - 1)).cast("int")
    found = entities.groupBy(slot.alias("slot")).agg(mark.cast("int").alias("mark")).toArrow()
    most = np.zeros(slots, dtype=np.uint8)
    most[found["slot"].to_numpy()] = np.minimum(found["mark"].to_numpy(), 255)
    return most


def _pair_slot(entity: int, word: str) -> int:
    return xxhash.xxh64_intdigest(word, entity + (1 << 63)) & (1 << PAIR_BITS) - 1


def pair_bits(terms: DataFrame) -> np.ndarray:
    """One bit per hash of a revealing pair; at most 2**(PAIR_BITS - 6) words are collected."""

    def make():
        def work(batch):
            return {"slot": [_pair_slot(e, w) for e, w in zip(batch["entity"], batch["term"], strict=True)]}

        return work

    slots = map_batches(terms.select("entity", "term"), make, "slot long")
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits")
    )
    found = words.toArrow()
    bits = np.zeros(1 << (PAIR_BITS - 6), dtype=np.uint64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint64)
    return bits


def least_counts(words: DataFrame) -> np.ndarray:
    """For each hash slot four times the binary logarithm, rounded down, of the
    fewest documents that one of its words has; 255 in slots without words."""
    bits = max(12, (SLOTS_A_WORD * words.count()).bit_length())
    slots = 1 << min(MOST_SLOT_BITS, bits)

    def make():
        def work(batch):
            return {"slot": [_slot(w, slots) for w in batch["term"]], "low": batch["with_term"]}

        return work

    placed = map_batches(words.select("term", "with_term"), make, "slot int, low long")
    found = placed.groupBy("slot").agg(F.floor(F.log2(F.min("low")) * 4).cast("int").alias("low")).toArrow()
    least = np.full(slots, 255, dtype=np.uint8)
    least[found["slot"].to_numpy()] = np.minimum(found["low"].to_numpy(), 254)
    return least


def _pair_finder(bits: np.ndarray, most: np.ndarray):
    """Where the words stand that may reveal an entity of their text, with the entity."""

    def make():
        def work(batch):
            out = {"hash": [], "entity": [], "term": [], "at": []}
            for name, text in zip(batch["hash"], batch["text"], strict=True):
                spans, entities = entities_of(text, most)
                if not entities:
                    continue
                places: dict[str, list] = {}
                for w, s, e in words_outside(text, spans):
                    places.setdefault(w, []).append({"start": s, "end": e})
                for w, at in places.items():
                    for entity, _ in entities:
                        slot = _pair_slot(entity, w)
                        if int(bits[slot >> 6]) >> (slot & 63) & 1:
                            for column, value in zip(out, (name, entity, w, at), strict=True):
                                out[column].append(value)
            return out

        return work

    return make


def marks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its id, a hash of id and text, base spans and distinct entities. Written."""
    rows = docs.select(
        F.col(key).cast("long").alias("id"), F.xxhash64(key, text).alias("hash"), F.col(text).alias("text")
    )
    return materialize(map_batches(rows, _marker, MARKS), "pii-marks")


def supported(marked: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(entity, with_entity) of entities with enough documents. Written."""
    entities = marked.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("with_entity"))
    return materialize(entities.filter(F.col("with_entity") >= support), "pii-entities")


def disclosing_terms(
    docs: DataFrame,
    entities: DataFrame,
    most: np.ndarray,
    text: str = "text",
    support: int = SUPPORT,
    threshold: float = GENERALISE,
) -> DataFrame:
    """(entity, term, shared, disclosure) for words that reveal an entity. Written."""
    rows = docs.select(F.col(text).alias("text"))
    n = max(1, docs.count())

    def limit(with_entity: int) -> float:
        # Rounding must not lose a word at the bound.
        return 1.000001 * n ** (1 - threshold) * with_entity**threshold

    largest = entities.agg(F.max("with_entity")).first()[0] or 0
    counted = map_batches(rows, _frequency_counter(), "term string, n long")
    words = counted.groupBy("term").agg(F.sum("n").alias("with_term"))
    words = materialize(words.filter(F.col("with_term").between(support, limit(largest))), "pii-words")
    counter = _pair_counter(least_counts(words), most, limit)
    pairs = map_batches(rows, counter, "entity long, term string, n long")
    pairs = pairs.groupBy("entity", "term").agg(F.sum("n").alias("shared")).filter(F.col("shared") >= support)

    total = F.lit(float(n))
    # Both joined tables have one row per key, and so has the result.
    scored = pairs.join(words, "term").join(entities, "entity")
    pmi = F.log2(total * F.col("shared") / (F.col("with_term") * F.col("with_entity")))
    information = F.log2(total / F.col("with_entity"))
    scored = scored.withColumn("disclosure", F.when(information > 0, pmi / information))
    return materialize(
        scored.filter(F.col("disclosure") >= threshold).select("entity", "term", "shared", "disclosure"), "pii-terms"
    )


def findings(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    support: int = SUPPORT,
    generalise: float = GENERALISE,
) -> DataFrame:
    """Per row: ``id``, ``hash`` and ``spans``, an array of (start, rank, end,
    disclosure) by start and kind; ``disclosure`` is null for base spans."""
    marked = marks(docs, key, text)
    entities = supported(marked, support)
    if entities.isEmpty():  # no entity of enough documents, so no word reveals one
        of_text = marked.select("hash").limit(0).withColumn("_terms", F.lit(None).cast(TERMS))
    else:
        most = most_counts(entities)
        terms = disclosing_terms(docs, entities, most, text, support, generalise)
        rows = docs.select(F.xxhash64(key, text).alias("hash"), F.col(text).alias("text"))
        hits = map_batches(
            rows, _pair_finder(pair_bits(terms), most), "hash long, entity long, term string, at array<struct<start:long,end:long>>"
        )
        hits = materialize(hits, "pii-hits")
        told = join_per_key(hits, terms, ["entity", "term"], "shared", hits.count()).filter(F.col("disclosure").isNotNull())
        # A word reveals as much as it does of the entity it says most of.
        told = told.groupBy("hash", "term").agg(F.max("disclosure").alias("disclosure"), F.first("at").alias("at"))
        rank, share = F.lit(KINDS.index("term")).alias("rank"), F.col("disclosure")
        placed = F.transform("at", lambda a: F.struct(a.start.alias("start"), rank, a.end.alias("end"), share.alias("disclosure")))
        of_text = told.groupBy("hash").agg(F.flatten(F.collect_list(placed)).alias("_terms"))
        of_text = materialize(of_text, "pii-terms-at")
    none = F.lit(None).cast("double")
    base = F.transform(
        "base", lambda s: F.struct(s.start.alias("start"), s.rank.alias("rank"), s.end.alias("end"), none.alias("disclosure"))
    )
    empty = F.array().cast(TERMS)
    return marked.join(replicate(of_text), "hash", "left").select(
        "id", "hash", F.array_sort(F.concat(base, F.coalesce("_terms", empty))).alias("spans")
    )


def count_of(kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.size(F.filter("spans", lambda s: s.rank == rank)).cast("long")


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    kind = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(kind, s.rank + 1), s.start.cast("string"), s.end.cast("string")),
        ),
        ",",
    )


def base_of(spans: Column) -> Column:
    return F.filter(spans, lambda s: s.rank < KINDS.index("term"))


def _redactor(remove: float):
    def make():
        def work(batch):
            texts = []
            for text, spans in zip(batch["text"], batch["spans"], strict=True):
                parts, end = [], 0
                for span in spans or []:
                    if span["start"] < end:  # inside one that is gone already
                        end = max(end, span["end"])
                        continue
                    gone = span["disclosure"] is not None and span["disclosure"] >= remove
                    parts += [text[end : span["start"]], "" if gone else f"[{KINDS[span['rank']]}]"]
                    end = span["end"]
                texts.append(text if text is None else "".join([*parts, text[end:]]))
            return {"n": batch["n"], "clean": texts}

        return work

    return make


def sanitised(docs: DataFrame, key: str = "doc_id", text: str = "text", remove: float = REMOVE, **parameters) -> DataFrame:
    """``docs`` with entities replaced by their kind, and the words that reveal
    them generalised to ``[term]`` or removed."""
    found = findings(docs, key, text, **parameters).filter(F.size("spans") > 0)
    found = materialize(found.groupBy("hash").agg(F.first("spans").alias("spans")), "pii-spans")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.xxhash64(key, text).alias("hash"))
    rows = materialize(rows.withColumn("n", F.monotonically_increasing_id()), "pii-rows")
    touched = rows.join(found, "hash").select("n", F.col(f"_row.{text}").alias("text"), "spans")
    clean = map_batches(touched, _redactor(remove), "n long, clean string")
    joined = rows.join(clean, "n", "left")
    return joined.select(
        *[F.coalesce("clean", f"_row.{c}").alias(c) if c == text else F.col(f"_row.{c}") for c in docs.columns]
    )

