"""Conversation structure repair by lightest derivations.

A conversation is a list of messages in order of turn (nulls first; ties by
role, then text). A message has at most one fault, the first of: *blank* (no
character but white space), *duplicate* (role and text seen earlier in the
conversation), *truncated* (the last character that is not white space does
not end a sentence). A repair edits messages in order until the initials of
their roles read ``(s?(ua)+)?``:

    K  keep                      0      D  delete                    2
    R  give the role that fits   1      I  insert an empty message   5

Blank and duplicate messages must be deleted; a truncated one that stays
costs 5 more. The repair is the cheapest, of several the one whose letters,
the *audit*, are least in ASCII order.

Method. An item (p, n, q) says that the first n messages of a span lead from
state p of the role pattern to q; its weight is (cost, audit). Deductions add
one edit, or join the items of neighbouring spans. They are superior in
Knuth's sense in the order (cost, n, audit): an edit of cost 0 takes a
message, so no result is lighter than what it is made of. They are monotone:
two audits of equal cost over the same messages differ before either ends, as
the longer would hold an insert more. So items are final when they leave the
agenda, and the search ends with the goal item.

Scale. Messages are sorted by conversation and turn over range partitions, so
a long conversation is spread over tasks; each task derives its spans, and the
few conversations that cross partitions join one row per span. Texts are
shuffled once, for the digest of the repaired conversation, which is one
sequential hash and so is computed by one task per conversation, as a stream
that keeps one message at a time and the audit.

Nulls in ids or turns group and sort as nulls; null roles and texts count as
one space. Repeated rows are messages. Other columns are not read. Empty
tables give empty results.
"""

from __future__ import annotations

import hashlib
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from martflow.operators.joins import replicate
from martflow.session import materialize

# White space is blank, tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
ENDINGS = ".!?"

KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED = 5

# States of the role pattern: nothing yet, after s, after u, after a.
STATES = range(4)
READS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FITTING = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
ACCEPTED = (0, 3)
LEGAL = {"su", "ua", "au"}

# Messages an agenda takes at once; longer spans are joined from such.
SPAN = 64

# Characters of a text that sort ties of turn and role; its digest sorts the rest.
HEAD = 32

ORDER = ["turn", "role", "head", "digest"]


def _edits(code: str, state: int) -> list[tuple[int, str, int]]:
    """Cost, letter and next state of every edit of a message.

    The code is the initial of its role (o: none that can be kept), upper case
    if the message is truncated, or x if it must go.
    """
    found = [(DELETE, "D", state)]
    if code != "x":
        more = TRUNCATED if code.isupper() else 0
        kept = READS.get((state, code.lower()))
        if kept is not None:
            found.append((KEEP + more, "K", kept))
        found.append((REROLE + more, "R", FITTING[state][1]))
    return found


EDITS = {code: [_edits(code, state) for state in STATES] for code in "suaoSUAOx"}


def code_of(initial: str, fault: str) -> str:
    """How ``EDITS`` calls a message with this initial and fault (b, d, t or none)."""
    if fault in ("b", "d"):
        return "x"
    known = initial if initial in ("s", "u", "a") else "o"
    return known.upper() if fault == "t" else known


def derive(codes: str, starts=STATES, goals=()) -> dict[tuple[int, int], tuple[int, str]]:
    """Lightest (cost, audit) from each start to each state over all messages.

    With ``goals``, only the item that reaches one of them first.
    """
    total, chart, done = len(codes), set(), {}
    agenda = [(0, 0, "", p, p) for p in starts]
    while agenda:
        cost, n, audit, p, q = heappop(agenda)
        if (p, n, q) in chart:
            continue
        chart.add((p, n, q))
        if n == total:
            done[p, q] = cost, audit
            if q in goals:
                return {(p, q): done[p, q]}
        else:
            for more, letter, state in EDITS[codes[n]][q]:
                if (p, n + 1, state) not in chart:
                    heappush(agenda, (cost + more, n + 1, audit + letter, p, state))
        state = FITTING[q][1]
        if (p, n, state) not in chart:
            heappush(agenda, (cost + INSERT, n, audit + "I", p, state))
    return done


def join_spans(left: dict, right: dict) -> dict:
    """Items of two neighbouring spans, joined where one ends as the other starts."""
    costs: dict[tuple[int, int], list] = {}
    for (p, r), (a, _) in left.items():
        for (s, q), (b, _) in right.items():
            if r == s:
                costs.setdefault((p, q), []).append((a + b, r))
    joined = {}
    for (p, q), ways in costs.items():
        least = min(ways)[0]
        joined[p, q] = least, min(left[p, r][1] + right[r, q][1] for cost, r in ways if cost == least)
    return joined


def join_all(spans: list[dict]) -> dict:
    """Items of a row of spans, joined in pairs, then pairs of pairs, and so on."""
    while len(spans) > 1:
        pairs = [join_spans(*spans[i : i + 2]) for i in range(0, len(spans) - 1, 2)]
        spans = pairs + spans[len(pairs) * 2 :]
    return spans[0]


def derive_long(codes: str) -> dict:
    """``derive`` for any number of messages."""
    return join_all([derive(codes[i : i + SPAN]) for i in range(0, max(1, len(codes)), SPAN)])


def lightest(items: dict) -> tuple[int, str]:
    """The lightest of the items that lead from the start to the end of the pattern."""
    return min(items[0, q] for q in ACCEPTED if (0, q) in items)


def repair_of(codes: str) -> tuple[int, str]:
    """Cost and audit of the repair of a whole conversation."""
    items = derive(codes, starts=(0,), goals=ACCEPTED) if len(codes) <= SPAN else derive_long(codes)
    return lightest(items)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the checksum of ``conv_id:turn``: some dropped, emptied,
    without sentence ends, repeated, or given the user's role."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select(
        "conv_id", "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(key) % 20).alias("_kind"),
    )
    kind = F.col("_kind")
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ENDINGS, "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("_copy"),
    ).drop("_copy")


def _messages(conversations: DataFrame, key: str) -> DataFrame:
    text = F.coalesce("text", F.lit(" "))
    return conversations.select(
        F.col(key).alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.substring(text, 1, HEAD).alias("head"),
        F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"),
    )


def _fault(text: Column) -> Column:
    """b if blank, t if truncated, else empty."""
    bare = F.rtrim(text, F.lit(BLANKS))
    return F.when(bare == "", "b").when(F.instr(F.lit(ENDINGS), F.right(bare, F.lit(1))) == 0, "t").otherwise("")


def _faults(messages: DataFrame) -> DataFrame:
    """Messages without texts, with their fault; d also where an earlier turn has the same."""
    light = materialize(messages.select("conv", *ORDER, _fault(F.col("text")).alias("fault")), "messages")
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    seen = light.where("fault <> 'b'").groupBy("conv", "role", "digest")
    repeated = seen.agg(F.min(when).alias("first"), F.max(when).alias("last")).where("first < last")
    first = materialize(repeated.drop("last"), "repeated-messages").alias("f")
    m = light.alias("m")
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"f.{c}")) for c in ("conv", "role", "digest")]
    later = F.col("f.first") < F.struct(F.col("m.turn").isNotNull().alias("known"), F.col("m.turn").alias("turn"))
    fault = F.when((F.col("m.fault") != "b") & F.coalesce(later, F.lit(False)), "d").otherwise(F.col("m.fault"))
    return m.join(replicate(first), same, "left").select("m.conv", *[f"m.{c}" for c in ORDER], fault.alias("fault"))


def _spans(faults: DataFrame, conv: str) -> DataFrame:
    """One row per conversation and partition: its items there, or its repair if all of it is there."""
    schema = (
        f"conv {conv}, turn long, role string, head string, digest binary, part int, messages long, "
        "blank long, duplicate long, truncated long, cost long, audit string, "
        "paths array<struct<p: int, q: int, cost: long, audit: string>>"
    )
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def record(start, codes, counts, crosses):
        row = {"conv": start[0], **dict(zip(ORDER, start[1:])), "part": TaskContext.get().partitionId()}
        row |= {"messages": len(codes), **dict(zip(("blank", "duplicate", "truncated"), map(counts.count, "bdt")))}
        row |= {"cost": None, "audit": None, "paths": None}
        if crosses:
            row["paths"] = [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in derive_long(codes).items()]
        else:
            row["cost"], row["audit"] = repair_of(codes)
        return row

    def run(batches):
        start, codes, faults_, last, ended, made = None, [], [], None, 0, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv", *ORDER, "fault"))):
                here, fault = row[:-1], row[-1]
                if start is None or here[0] != start[0]:
                    if start is not None:
                        made.append(record(start, "".join(codes), "".join(faults_), ended == 0))
                        ended += 1
                    start, codes, faults_, last = here, [], [], None
                if here == last and fault != "b":
                    fault = "d"
                last = here
                codes.append(code_of(here[2][:1], fault))
                faults_.append(fault)
            if len(made) >= 1000:
                yield pa.RecordBatch.from_pylist(made, schema=arrow)
                made = []
        if start is not None:
            made.append(record(start, "".join(codes), "".join(faults_), True))
        yield pa.RecordBatch.from_pylist(made, schema=arrow)

    ordered = faults.repartitionByRange("conv", *ORDER).sortWithinPartitions("conv", *ORDER)
    return ordered.mapInArrow(run, schema)


def _across(spans: DataFrame) -> DataFrame:
    """The repairs of conversations that lie in several partitions, cut into their spans again."""
    schema = spans.drop("paths").schema

    def whole(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        items = [{(w["p"], w["q"]): (w["cost"], w["audit"]) for w in r["paths"]} for r in rows]
        cost, audit = lightest(join_all(items))
        at = 0
        for i, r in enumerate(rows):
            begin, left = at, r["messages"]
            while left:
                left -= audit[at] != "I"
                at += 1
            if i == len(rows) - 1:
                at = len(audit)
            r["cost"], r["audit"] = cost if i == 0 else 0, audit[begin:at]
            del r["paths"]
        return pa.Table.from_pylist(rows, schema=to_arrow_schema(schema))

    return spans.where("paths IS NOT NULL").groupBy("conv").applyInArrow(whole, schema)


class _Repair:
    """One conversation as its spans and messages arrive in order."""

    def __init__(self, conv):
        self.conv, self.state, self.audit, self.left = conv, 0, [], iter("")
        self.turns, self.low, self.high, self.turn = 0, None, None, None
        self.before, self.illegal, self.cost = None, 0, 0
        self.counts = [0, 0, 0]
        self.hash, self.any = hashlib.sha256(), False

    def _stays(self, role, text):
        self.state = READS[self.state, role[:1]]
        self.hash.update((f"\n{role}:{text}" if self.any else f"{role}:{text}").encode())
        self.any = True
        return role, text

    def _insert(self):
        return ("I", *self._stays(FITTING[self.state][0], ""))

    def rest(self):
        """The inserts that end a span."""
        return [self._insert() for _ in self.left]

    def span(self, audit, cost, counts):
        made = self.rest()
        self.left = iter(audit)
        self.audit.append(audit)
        self.cost += cost
        self.counts = [a + b for a, b in zip(self.counts, counts)]
        return made

    def message(self, turn, role, text):
        if turn is not None:
            self.turns += self.turn != turn
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
        self.illegal += self.before is not None and self.before + role[:1] not in LEGAL
        self.before = role[:1]
        made = []
        for letter in self.left:
            if letter == "I":
                made.append(self._insert())
                continue
            if letter != "D":
                role = FITTING[self.state][0] if letter == "R" else role
                made.append((letter, *self._stays(role, text)))
            break
        return made

    def result(self):
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        names = ("blank", "duplicate", "truncated")
        return {
            "conv": self.conv, "gaps": gaps, **dict(zip(names, self.counts)), "illegal": self.illegal,
            "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest(),
        }


RESULT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
REPAIRED = "position long, role string, text string, edit string"


def _streamed(conversations: DataFrame, key: str, every: DataFrame | None, messages: bool) -> DataFrame:
    kind = conversations.schema[key].dataType.simpleString()
    rows = _messages(conversations, key)
    spans = materialize(_spans(_faults(rows), kind), "spans")
    found = spans.where("paths IS NULL").drop("paths").unionByName(_across(spans))
    ids = (conversations if every is None else every).select(F.col(key).alias("conv")).distinct()
    nothing = {"turn": "long", "role": "string", "head": "string", "digest": "binary"}
    empty = {c: F.lit(None).cast(t) if t == "long" else F.lit("").cast(t) for c, t in nothing.items()}
    stream = (
        ids.withColumns({**empty, "kind": F.lit(0)})
        .unionByName(found.drop("part", "messages").withColumn("kind", F.lit(1)), allowMissingColumns=True)
        .unionByName(rows.withColumn("kind", F.lit(2)), allowMissingColumns=True)
    )
    ordered = stream.repartition("conv").sortWithinPartitions("conv", *ORDER, "kind")
    schema = f"conv {kind}, {REPAIRED if messages else RESULT}"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    taken = ("conv", "kind", "turn", "role", "text", "audit", "cost", "blank", "duplicate", "truncated")

    def run(batches):
        now, made, position = None, [], 0

        def keep(stayed):
            nonlocal position
            if messages:
                for letter, role, text in stayed:
                    made.append({"conv": now.conv, "position": position, "role": role, "text": text, "edit": letter})
                    position += 1

        def end():
            if now is not None:
                keep(now.rest())
                if not messages:
                    made.append(now.result())

        for batch in batches:
            for conv, what, turn, role, text, audit, cost, *counts in zip(*(batch.column(c).to_pylist() for c in taken)):
                if now is None or conv != now.conv:
                    end()
                    now, position = _Repair(conv), 0
                if what == 1:
                    keep(now.span(audit, cost, counts))
                elif what == 2:
                    keep(now.message(turn, role, text))
            if made:
                yield pa.RecordBatch.from_pylist(made, schema=arrow)
                made = []
        end()
        yield pa.RecordBatch.from_pylist(made, schema=arrow)

    return ordered.mapInArrow(run, schema).withColumnRenamed("conv", key)


def repairs(conversations: DataFrame, key: str = "conv_id", every: DataFrame | None = None) -> DataFrame:
    """One row per conversation: its faults, the cost and audit of its repair, and
    the SHA-256 of the repaired messages, ``role:text`` joined by newlines.

    ``gaps`` counts turns missing between the least and the greatest, ``illegal``
    neighbours whose roles do not follow each other. Conversations of the table
    ``every`` that have no message have zeros and an empty repair.
    """
    return _streamed(conversations, key, every, messages=False)


def repaired(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """The messages of the repaired conversations by ``position``, with the edit each got."""
    return _streamed(conversations, key, None, messages=True)
