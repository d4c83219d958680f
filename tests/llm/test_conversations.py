"""Conversation repair against exhaustive search and a plain reading of the contract."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from conftest import SMALL

from martflow.llm import conversations
from martflow.llm.conversations import derive_long, lightest, repair_of

SCHEMA = "conv_id long, turn long, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")
SPACES = " \t\n\x0b\x0c\r"


def applied(messages, audit):
    """Cost and repaired (role, text) of an audit over (role, text, fault); None if it cannot be."""
    cost, out, rest = 0, [], list(messages)
    for letter in audit:
        if letter == "I":
            cost += 5
            out.append((None, ""))
            continue
        role, text, fault = rest.pop(0)
        if letter == "D":
            cost += 2
            continue
        if fault in ("blank", "duplicate"):
            return None
        cost += 5 * (fault == "truncated") + (letter == "R")
        out.append((role if letter == "K" else None, text))
    free = [i for i, (role, _) in enumerate(out) if role is None]
    for roles in itertools.product(("user", "assistant"), repeat=len(free)) if len(free) < 9 else []:
        named = list(out)
        for i, role in zip(free, roles):
            named[i] = (role, named[i][1])
        if PATTERN.fullmatch("".join(r[:1] or " " for r, _ in named)):
            return cost, named
    return None


def cheapest(messages):
    """Every audit with as many inserts as could pay."""
    n, best = len(messages), None
    for inserts in range(2 * n // 5 + 1):
        for places in itertools.combinations(range(n + inserts), inserts):
            for letters in itertools.product("KRD", repeat=n):
                it = iter(letters)
                audit = "".join("I" if i in places else next(it) for i in range(n + inserts))
                done = applied(messages, audit)
                if done and (best is None or (done[0], audit) < best[:2]):
                    best = (done[0], audit, done[1])
    return best


def by_recursion(messages):
    """The same for longer ones, from the end: best letters for the rest of the messages."""

    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(None)
    def best(i, before, inserts):
        found = [(0, "")] if i == len(messages) and before in ("", "a") else []
        nxt = "a" if before == "u" else "u"
        if inserts:
            later = best(i, nxt, inserts - 1)
            found += [(later[0] + 5, "I" + later[1])] if later else []
        if i < len(messages):
            role, _, fault = messages[i]
            ways = [("D", 2, before)]
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                ways.append(("R", 1 + more, nxt))
                if (before, role[:1]) in follow:
                    ways.append(("K", more, role[:1]))
            for letter, cost, state in ways:
                later = best(i + 1, state, inserts)
                found += [(later[0] + cost, letter + later[1])] if later else []
        return min(found, default=None)

    cost, audit = best(0, "", 2 * len(messages) // 5)
    out, before, rest = [], "", list(messages)
    for letter in audit:
        role, text, _ = rest.pop(0) if letter != "I" else ("", "", "")
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if before == "u" else "user"
        before = role[:1]
        out.append((role, text))
    return cost, audit, out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(SPACES)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def by_hand(rows, ids):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    result = {}
    for conv in ids:
        group = sorted(groups[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        messages = faults_of(group)
        cost, audit, out = by_recursion(tuple(messages))
        turns = [t for t, _, _ in group if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        kinds = [f for _, _, f in messages]
        initials = [r[:1] for _, r, _ in group]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        text = "\n".join(f"{r}:{t}" for r, t in out)
        counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
        result[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return result


def coded(messages):
    names = {"blank": "b", "duplicate": "d", "truncated": "t", "": ""}
    return "".join(conversations.code_of(role[:1], names[fault]) for role, _, fault in messages)


def some_messages(rng, n):
    roles = ["system", "user", "assistant", "tool", "", "user", "assistant"]
    return [(rng.choice(roles), "x", rng.choice(["", "", "", "truncated", "blank", "duplicate"])) for _ in range(n)]


def test_agenda_equals_exhaustive_search():
    rng = random.Random(5)
    for n in (0, 1, 2, 3, 4, 5):
        for _ in range(60 if n < 5 else 25):
            messages = some_messages(rng, n)
            cost, audit, _ = cheapest(messages)
            assert repair_of(coded(messages)) == (cost, audit) == by_recursion(tuple(messages))[:2]


def test_joined_spans_equal_one_agenda(monkeypatch):
    rng = random.Random(6)
    for span in (1, 2, 3, 5):
        monkeypatch.setattr(conversations, "SPAN", span)
        for n in range(1, 24):
            messages = some_messages(rng, n)
            assert lightest(derive_long(coded(messages))) == by_recursion(tuple(messages))[:2]


def collected(found):
    rows = [tuple(r) for r in found.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


AWKWARD = [
    (1, None, None, None), (1, None, "user", "Null turn."), (1, 3, "user", None), (1, 3, "user", "Tie b."), (1, 3, "user", "Tie a."),
    (1, 3, "assistant", "Tie."), (None, 1, "user", "No id."), (None, 1, "user", "No id."), (2, 9, "", ""), (2, -4, "user", " \t\n"),
    (3, 1, "user", "Again."), (3, 2, "assistant", "One."), (3, 5, "user", "Again."), (3, 6, "assistant", "cut"), (3, 7, "user", "Again. "),
    (4, 0, "system", "Be kind!"), (4, 1, "assistant", "日本語 ñ 😀?"), (5, 1, "user", "w " * 200_000 + "."), (5, 2, "assistant", "Ja.\x0b"),
    (6, 2, "tool", "Out."), (7, 2**62, "user", "Far."),
]


def test_awkward_rows(prepared):
    rows = AWKWARD + AWKWARD[10:12]
    table = prepared.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", head string, part int")
    assert collected(conversations.repairs(table)) == by_hand(rows, {r[0] for r in rows})
    harmed = conversations.repairs(conversations.damage(table), every=table)
    assert collected(harmed) == by_hand(damaged(rows), {r[0] for r in rows})


def test_nothing(prepared):
    table = prepared.createDataFrame([], SCHEMA)
    assert conversations.repairs(table).count() == 0
    assert conversations.repaired(table).count() == 0
    one = prepared.createDataFrame([(8, 1, "user", "x")], SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    assert collected(conversations.repairs(table, every=one)) == {8: (0, 0, 0, 0, 0, 0, "", empty)}


@pytest.mark.parametrize("partitions", [1, 7])
def test_a_conversation_over_many_partitions(prepared, partitions):
    rng = random.Random(7)
    roles = ["user", "assistant", "system", "tool"]
    rows = [(1, rng.randrange(900), rng.choice(roles), rng.choice(["Yes.", "no", "", f"Text {i}."])) for i in range(1500)]
    rows += [(c, t, rng.choice(roles), f"Short {t}.") for c in (0, 2, 3) for t in range(5)]
    prepared.conf.set("spark.sql.shuffle.partitions", str(partitions))
    prepared.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = collected(conversations.repairs(prepared.createDataFrame(rows, SCHEMA)))
    finally:
        prepared.conf.set("spark.sql.shuffle.partitions", "8")
        prepared.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    import sys

    sys.setrecursionlimit(20_000)
    small = by_hand([r for r in rows if r[0] != 1], {0, 2, 3})
    assert {c: found[c] for c in small} == small
    group = sorted((r[1:] for r in rows if r[0] == 1), key=lambda r: (r[0], r[1], r[2]))
    codes = coded(faults_of(group))
    cost, audit = lightest(conversations.derive(codes, starts=(0,), goals=(0, 3)))
    assert found[1][5:7] == (cost, audit)
    kinds = [f for _, _, f in faults_of(group)]
    assert found[1][1:4] == tuple(kinds.count(k) for k in ("blank", "duplicate", "truncated"))


def test_repaired_messages(prepared):
    table = prepared.createDataFrame(AWKWARD, SCHEMA)
    texts = defaultdict(list)
    for r in sorted(conversations.repaired(table).collect(), key=lambda r: (str(r.conv_id), r.position)):
        assert r.position == len(texts[r.conv_id])
        texts[r.conv_id].append(f"{r.role}:{r.text}")
    digests = {c: f[-1] for c, f in collected(conversations.repairs(table)).items()}
    assert digests == {c: hashlib.sha256("\n".join(texts[c]).encode()).hexdigest() for c in digests}


def test_query_equals_the_contract(prepared):
    from martflow.llm.queries import QUERIES

    rows = [tuple(r) for r in prepared.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(QUERIES["op11_conversation_repair"](prepared, SMALL)) == by_hand(damaged(rows), {r[0] for r in rows})
