"""Benchmark decontamination by spaced-seed hashing.

Fixed masks look at 5 of at most 6 words and ignore the other, so a window
still hashes alike when the word at the ignored place is substituted. Windows
of all documents and of all test items are hashed under each mask and joined on
the hash. Every hit fixes an alignment; around it the words of both texts are
compared, stretches that tolerate substitutions are found, and the share of
the item's words they cover decides.

The masks lose nothing: the running score of a stretch stays above zero, so
its first five matches lie in its first six words and are those of a mask.

Test items of at most ``HELD_WORDS`` words in all are sent to every executor,
and a document is joined and verified where it is read: only its leaks leave
the task. More items are joined by shuffle, where a bit filter of fixed size,
built from the items' hashes, keeps out windows that match none. Both give the
same rows.

Defined results: words are runs of letters, digits and ``_``, lower-cased; in
scripts written without spaces each character is a word. Items of fewer than
``SHORTEST`` words cannot be told from chance by a part of them: they match
where all their words stand in a row, and with fewer than ``WITHIN`` words only
a document that holds nothing else. Items without words match nothing, null and
empty texts neither. Null and repeated ids of documents: rows are told apart by
id and text together, and equal rows are judged alike. Items with a null id
count like others; repeated items count once per id. Other columns are kept by
``without_leaks`` and not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import WORD, WordHashes, by_ids, map_batches
from martflow.session import materialize

# Thai to Lao, Burmese, Khmer, kana and Han.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
HAS_UNSPACED = re.compile(f"[{UNSPACED}]")
WORD_OR_SIGN = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+")

# Fixed masks: 1 is looked at, 0 ignored. With PENALTY 2 and STRETCH 5 every
# stretch begins with one of them.
MASKS = ("11111", "111101", "111011")
SHORTEST = 5
WITHIN = 3  # words of the shortest item that is looked for inside documents
# The masks by their salts; those of short items are as long as the item.
KINDS = dict(enumerate(MASKS, 1)) | {10 + n: "1" * n for n in range(1, SHORTEST)}
HELD_WORDS = 1_000_000  # 24 bytes for each mask and word, and 8 a word
CHUNK = 100_000  # hits that a task expands at a time
FILTER_BITS = 24
COVERAGE = 0.5  # share of an item's words that must be matched
PENALTY = 2  # a substitution costs as much as so many matches earn
STRETCH = 5  # matches a stretch needs at least


def words_of(text: str | None) -> list[str]:
    low = (text or "").lower()
    if low.isascii() or not HAS_UNSPACED.search(low):
        return WORD.findall(low)
    return WORD_OR_SIGN.findall(low)


def window_hashes(words: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """A hash for each window, of the words the mask looks at."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    factor = 0xD6E8FEB86659FD93
    for i, looked_at in enumerate(mask):
        if looked_at == "1":
            total += words[i : i + n] * np.uint64(factor)
            factor = factor * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF | 1
    total ^= total >> np.uint64(32)
    total *= np.uint64(0xD6E8FEB86659FD93)
    return total ^ (total >> np.uint64(29))


def kinds_of(n: int) -> list[int]:
    """Salts of the masks that find an item of ``n`` words."""
    return list(range(1, len(MASKS) + 1)) if n >= SHORTEST else [10 + n] if n else []


def doc_windows(words: np.ndarray, kinds: list[int]) -> Iterator[np.ndarray]:
    """The hashes of each kind at every place of a document."""
    for salt in kinds:
        short = salt - 10
        if 0 < short < WITHIN and len(words) != short:
            continue
        yield window_hashes(words, KINDS[salt], salt)


def _item_words():
    hashes = WordHashes()

    def work(batch):
        words = [hashes.of(words_of(text)).astype(np.int64) for text in batch["text"]]
        return {"n": batch["n"], "item_id": batch["item_id"], "words": words}

    return work


def _item_windows():
    def work(batch):
        out = {"n": [], "h": [], "at": []}
        for n, words in zip(batch["n"], batch["words"], strict=True):
            words = np.array(words, dtype=np.int64).astype(np.uint64)
            for salt in kinds_of(len(words)):
                found = window_hashes(words, KINDS[salt], salt).astype(np.int64).tolist()
                out["n"] += [n] * len(found)
                out["h"] += found
                out["at"] += range(len(found))
        return out

    return work


def marked(bits: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Places of the hashes whose bit is set."""
    slot = found >> np.uint64(64 - FILTER_BITS)
    return np.flatnonzero(bits[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1))


def _doc_hits(bits, kinds: list[int]):
    def make():
        hashes = WordHashes()

        def work(batch):
            out = {"uid": [], "h": [], "at": []}
            for uid, text in zip(batch["uid"], batch["text"], strict=True):
                for found in doc_windows(hashes.of(words_of(text)), kinds):
                    hit = marked(bits.value, found)
                    if len(hit):
                        out["uid"] += [uid] * len(hit)
                        out["h"] += found[hit].astype(np.int64).tolist()
                        out["at"] += hit.tolist()
            return out

        return work

    return make


def _filter_of(windows: DataFrame) -> np.ndarray:
    """One bit per hash prefix that occurs; at most 2**(FILTER_BITS - 6) words are collected."""
    slot = F.shiftrightunsigned("h", 64 - FILTER_BITS)
    words = windows.select(
        F.shiftright(slot, 6).alias("word"), (slot % 64).cast("int").alias("bit")
    ).distinct()
    words = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint64)
    return bits


def stretches(same: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint [start, end) with the largest matches less penalties, found
    left to right: one ends where its running score falls below zero."""
    found, score, best, start, end = [], 0, 0, 0, 0
    for i, s in enumerate(same.tolist()):
        if score == 0 and s:
            start, best, end = i, 0, i
        score += 1 if s else -PENALTY if score > 0 else 0
        if score > best:
            best, end = score, i + 1
        if score <= 0:
            if best:
                found.append((start, end))
            score = best = 0
    if best:
        found.append((start, end))
    return found


def matched_words(doc: np.ndarray, item: np.ndarray, shifts: list[int]) -> np.ndarray:
    """For each word of the item, whether a stretch of some alignment matches it."""
    hit = np.zeros(len(item), dtype=bool)
    seen: set[tuple[int, bytes]] = set()
    for shift in shifts:
        low, high = max(0, -shift), min(len(item), len(doc) - shift)
        if high <= low:
            continue
        same = doc[low + shift : high + shift] == item[low:high]
        if (low, same.tobytes()) in seen:
            continue
        seen.add((low, same.tobytes()))
        if len(item) < SHORTEST:
            if same.all() and len(same) == len(item) and (len(item) >= WITHIN or len(doc) == len(item)):
                hit[:] = True
        else:
            for a, b in stretches(same):
                if int(same[a:b].sum()) >= STRETCH:
                    hit[low + a : low + b] |= same[a:b]
        if hit.all():
            break
    return hit


def least_matched(size: int, coverage: float) -> int:
    """Words that must be matched of an item of ``size`` words."""
    return size if size < SHORTEST else max(STRETCH, math.ceil(coverage * size))


class HeldItems:
    """Test items as arrays: their words, and their windows sorted by hash."""

    def __init__(self, ids: list, words: list[np.ndarray]):
        self.ids, self.words = ids, words
        found: list[tuple[int, np.ndarray]] = [
            (i, window_hashes(w, KINDS[salt], salt)) for i, w in enumerate(words) for salt in kinds_of(len(w))
        ]
        hashes = np.concatenate([np.zeros(0, np.uint64), *[h for _, h in found]])
        order = np.argsort(hashes, kind="stable")
        item = np.concatenate([np.zeros(0, np.int32), *[np.full(len(h), i, np.int32) for i, h in found]])[order]
        at = np.concatenate([np.zeros(0, np.int32), *[np.arange(len(h), dtype=np.int32) for _, h in found]])[order]
        self.item, self.at = item, at
        self.hashes, self.first = np.unique(hashes[order], return_index=True)
        self.first = np.append(self.first, len(order))
        self.kinds = sorted({salt for w in words for salt in kinds_of(len(w))})
        self.bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
        slot = self.hashes >> np.uint64(64 - FILTER_BITS)
        np.bitwise_or.at(self.bits, slot >> np.uint64(6), np.uint64(1) << (slot & np.uint64(63)))

    def alignments(self, doc: np.ndarray) -> dict[int, list[int]]:
        """Shifts of each item that a window of the document hits."""
        found: dict[int, set[int]] = {}
        for hashes in doc_windows(doc, self.kinds):
            places = marked(self.bits, hashes)
            if not len(places):
                continue
            index = np.minimum(np.searchsorted(self.hashes, hashes[places]), len(self.hashes) - 1)
            real = self.hashes[index] == hashes[places]
            places, index = places[real], index[real]
            if not len(places):
                continue
            many = self.first[index + 1] - self.first[index]
            cuts = np.searchsorted(np.cumsum(many), np.arange(0, many.sum(), CHUNK), side="right")
            for low, high in zip(cuts, [*cuts[1:], len(many)], strict=True):
                if low == high:
                    continue
                n = many[low:high]
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                window = np.repeat(self.first[index[low:high]], n) + within
                pairs = np.stack([self.item[window], np.repeat(places[low:high], n) - self.at[window]])
                for item, shift in np.unique(pairs, axis=1).T.tolist():
                    found.setdefault(item, set()).add(shift)
        return {item: sorted(shifts) for item, shifts in found.items()}


LEAKS = "uid long, doc_id long, item_id long, matched int, item_words int"


def _judge_in_place(held, coverage: float):
    def make():
        hashes, items = WordHashes(), held.value

        def work(batch):
            out = {"uid": [], "doc_id": [], "item_id": [], "matched": [], "item_words": []}
            for uid, name, text in zip(batch["uid"], batch["doc_id"], batch["text"], strict=True):
                doc = hashes.of(words_of(text))
                for item, shifts in items.alignments(doc).items():
                    words = items.words[item]
                    matched = int(matched_words(doc, words, shifts).sum())
                    if matched >= least_matched(len(words), coverage):
                        for column, value in zip(out, (uid, name, items.ids[item], matched, len(words)), strict=True):
                            out[column].append(value)
            return out

        return work

    return make


def _verifier(coverage: float):
    def make():
        hashes = WordHashes()

        def work(batch):
            out = {"uid": [], "doc_id": [], "item_id": [], "matched": [], "item_words": []}
            for i, shifts in enumerate(batch["shifts"]):
                words = np.array(batch["words"][i], dtype=np.int64).astype(np.uint64)
                matched = int(matched_words(hashes.of(words_of(batch["text"][i])), words, sorted(shifts)).sum())
                if matched >= least_matched(len(words), coverage):
                    row = (batch["uid"][i], batch["doc_id"][i], batch["item_id"][i], matched, len(words))
                    for column, value in zip(out, row, strict=True):
                        out[column].append(value)
            return out

        return work

    return make


def _judge_by_shuffle(rows: DataFrame, tests: DataFrame, kinds: list[int], coverage: float) -> DataFrame:
    """The leaks, where there are more items than a task should hold."""
    windows = materialize(map_batches(tests.select("n", "words"), _item_windows, "n long, h long, at int"), "item-windows")
    bits = rows.sparkSession.sparkContext.broadcast(_filter_of(windows))
    hits = map_batches(rows.select("uid", "text"), _doc_hits(bits, kinds), "uid long, h long, at int")
    aligned = hits.join(windows.withColumnRenamed("at", "item_at"), "h")
    pairs = (
        aligned.select("uid", "n", (F.col("at") - F.col("item_at")).alias("shift"))
        .groupBy("uid", "n")
        .agg(F.collect_set("shift").alias("shifts"))
    )
    pairs = materialize(pairs, "aligned")
    wanted = materialize(pairs.select("uid").distinct(), "aligned-ids")
    found = by_ids(rows, wanted, "uid").join(pairs, "uid").join(tests, "n")
    return map_batches(found, _verifier(coverage), LEAKS)


def leaks(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    coverage: float = COVERAGE,
    held_words: int = HELD_WORDS,
) -> DataFrame:
    """(``uid``, ``doc_id``, ``item_id``, ``matched``, ``item_words``) for every
    document and item with at least ``coverage`` of the item's words in the
    document. ``uid`` is a hash of id and text. Written."""
    tests = items.select(
        F.monotonically_increasing_id().alias("n"), F.col(item_key).cast("long").alias("item_id"), F.col(item_text).alias("text")
    )
    tests = materialize(map_batches(tests, _item_words, "n long, item_id long, words array<long>"), "items")
    rows = docs.select(
        F.xxhash64(key, text).alias("uid"), F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")
    ).filter(F.col("text").isNotNull())
    size = F.size("words")
    total, *some = tests.agg(
        F.sum(size + 1), *[F.max(size == n) for n in range(1, SHORTEST)], F.max(size >= SHORTEST)
    ).first()
    if (total or 0) <= held_words:
        held = tests.select("item_id", "words").toArrow()
        words = [np.array(w, dtype=np.int64).astype(np.uint64) for w in held["words"].to_pylist()]
        broadcast = docs.sparkSession.sparkContext.broadcast(HeldItems(held["item_id"].to_pylist(), words))
        checked = map_batches(rows, _judge_in_place(broadcast, coverage), LEAKS)
    else:
        kinds = [salt for n, there in enumerate(some, 1) if there for salt in kinds_of(n)]
        checked = _judge_by_shuffle(rows, tests, kinds, coverage)
    best = checked.groupBy("uid", "doc_id", "item_id")
    return materialize(best.agg(F.max("matched").alias("matched"), F.max("item_words").alias("item_words")), "leaks")


def without_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **parameters) -> DataFrame:
    """The rows of ``docs`` that hold no test item."""
    found = leaks(docs, items, key, text, **parameters).select(F.col("uid").alias("_uid")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.xxhash64(key, text).alias("_uid"))
    return by_ids(rows, materialize(found, "leaked"), "_uid", "left_anti").select("_row.*")
