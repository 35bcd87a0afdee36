"""Repair of conversations by iterative-deepening A*.

Turns are kept, given another role, deleted or inserted until the roles read as an optional system
turn and then pairs of user and assistant. The search goes depth first, in ASCII order of the edits
and under a cost bound that rises to the least cost not yet refuted, so the first path that arrives
is the cheapest and, of the cheapest, the least in ASCII order. A transposition table keeps, for
every place and role state, the cost that is known not to be enough.

Rows are dealt by ranges of conversation and turn, so that one conversation may lie in many tasks.
Conversations of more than ``PIECE_ROWS`` turns, and those at the ends of a task, are searched in
pieces: from every role state to every other. Which way through the pieces is the cheapest follows
from these few numbers per piece, and gives the same edits as a search of the whole, because the
edits of a piece end with those of its last row, so none begins another.
"""

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import saved, table
from assay.plans.skew import salted_join

BLANKS = " \t\n\x0b\x0c\r"
#: Most rows and characters of a piece; a longer row is a piece of its own.
PIECE_ROWS, PIECE_CHARS = 32, 1 << 22
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
BY_INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LEGAL = {(START, SYSTEM), (START, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
LEGAL_PAIRS = {"su", "ua", "au"}
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
NEVER = 1 << 60
#: What is inserted after the last turn, by the state it leaves.
TAILS = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}

Row = tuple[str, str]  # initial of the role, fault


def alternate(state: int) -> int:
    """The state after an inserted or re-roled turn: an assistant follows a user, a user all others."""
    return ASSISTANT if state == USER else USER


class Search:
    """Edits of some rows from one role state to another; ``end`` None: to a complete conversation."""

    def __init__(self, rows: list[Row], start: int, end: int | None):
        self.rows, self.start, self.end = rows, start, end
        self.states = [BY_INITIAL.get(initial) for initial, _ in rows]
        self.forced = [fault in ("blank", "duplicate") for _, fault in rows]
        self.extra = [TRUNCATED if fault == "truncated" else 0 for _, fault in rows]
        n = len(rows)
        # Behind each place: what faults cost at least, the next row that may stay, and the unlawful neighbours.
        self.faults, self.after, self.broken = [0] * (n + 1), [n] * (n + 1), [0] * (n + 1)
        for i in range(n - 1, -1, -1):
            self.faults[i] = self.faults[i + 1] + (DELETE if self.forced[i] else self.extra[i])
            self.after[i] = self.after[i + 1] if self.forced[i] else i
            if not self.forced[i]:
                self.broken[i] = self._broken(self.states[i], i + 1)
        self.enough: dict[tuple[int, int], int] = {}
        self.path: list[str] = []

    def _broken(self, state: int | None, i: int) -> int:
        following = self.after[i]
        if following < len(self.rows):
            return ((state, self.states[following]) not in LEGAL) + self.broken[following]
        return int(state not in (START, ASSISTANT)) if self.end is None else int(state != self.end)

    def least(self, i: int, state: int) -> int:
        """No less can be needed: an edit costs 2 beyond the faults and mends two unlawful neighbours at most."""
        broken = self._broken(state, i)
        return self.faults[i] + broken + broken % 2

    def reachable(self) -> bool:
        if self.end is None or self.end == self.start:
            return True
        if self.end == SYSTEM:
            return self.start == START and any(s == SYSTEM and not f for s, f in zip(self.states, self.forced))
        return bool(self.rows) and self.end != START

    def run(self) -> tuple[int, str] | None:
        """Cost and edits, or None if there is no way."""
        if not self.reachable():
            return None
        bound = self.least(0, self.start)
        while (needed := self._search(0, self.start, bound)) is not None:
            bound = needed
        return bound, "".join(reversed(self.path))

    def _search(self, i: int, state: int, left: int) -> int | None:
        """None if ``left`` is enough from here, with the edits put on the path; else a cost that is needed at least."""
        place = (i, state)
        needed = max(self.enough.get(place, 0), self.least(i, state))
        if needed > left:
            return needed
        last = i == len(self.rows)
        if last and (state in (START, ASSISTANT) if self.end is None else state == self.end):
            return None
        # Also holds for ways that come back here: they leave less than this.
        self.enough[place] = left + 1
        needed = NEVER
        for edit, cost, i2, state2 in self._edits(i, state, last):
            more = self._search(i2, state2, left - cost)
            if more is None:
                self.path.append(edit)
                return None
            needed = min(needed, cost + more)
        self.enough[place] = max(needed, left + 1)
        return self.enough[place]

    def _edits(self, i: int, state: int, last: bool) -> Iterator[tuple[str, int, int, int]]:
        if not last:
            yield "D", DELETE, i + 1, state
        if not last or self.end is None:
            yield "I", INSERT, i, alternate(state)
        if not last and not self.forced[i]:
            if (state, self.states[i]) in LEGAL:
                yield "K", self.extra[i], i + 1, self.states[i]
            yield "R", REROLE + self.extra[i], i + 1, alternate(state)


def applied(turns: list[dict], start: int, edits: str) -> Iterator[tuple[str, str, str, int | None]]:
    """Edit, role, text and turn for each edit of ``turns``; deleted turns too."""
    state, rest = start, iter(turns)
    for edit in edits:
        row = next(rest) if edit != "I" else {"role": "", "text": "", "turn": None}
        role = row["role"]
        if edit == "K":
            state = BY_INITIAL[role[:1]]
        elif edit in "IR":
            state = alternate(state)
            role = "user" if state == USER else "assistant"
        yield edit, role, row["text"], row["turn"]


TURN = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("fault", pa.string())])
OPTION = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())])
TURN_DDL = "struct<turn: bigint, role: string, text: string, fault: string>"
OPTION_DDL = "struct<start: int, `end`: int, cost: bigint, edits: string>"


def fault(text: str, repeated: bool) -> str | None:
    """The first fault of a turn: blank, duplicate or truncated."""
    held = text.rstrip(BLANKS)
    if not held:
        return "blank"
    if repeated:
        return "duplicate"
    return None if held[-1] in ".!?" else "truncated"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            yield from batch.slice(at, 1024).to_pylist()


def _batched(rows: Iterator[dict], schema: pa.Schema, most: int = 256) -> Iterator[pa.RecordBatch]:
    """Rows in batches bounded by number and by characters of their turns."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(t["text"]) for t in row.get("turns", ()))
        if len(held) >= most or chars > PIECE_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _pieces(rows: Iterator[dict]) -> Iterator[dict]:
    """The sorted rows of a task cut into pieces, with the edits of all ways through each."""
    part, number = TaskContext.get().partitionId(), 0
    held: list[list[dict]] = []  # the pieces of the conversation read last, if it may end here

    def piece(conv_id, turns: list[dict], whole: bool) -> dict:
        nonlocal number
        number += 1
        kinds = [(t["role"][:1], t["fault"]) for t in turns]
        ways = [(START, None)] if whole else [(a, b) for a in STATES for b in STATES]
        options = [
            {"start": a, "end": b, "cost": found[0], "edits": found[1]}
            for a, b in ways
            if (found := Search(kinds, a, b).run()) is not None
        ]
        return {"conv_id": conv_id, "part": part, "piece": number, "whole": whole, "turns": turns, "options": options}

    # The first and the last conversation of a task may go on in another one.
    first = True
    conversations = groupby(rows, key=lambda row: row["conv_id"])
    ahead = next(conversations, None)
    while ahead:
        conv_id, mine = ahead
        held, chars, before = [], 0, None
        several = False
        for row in mine:
            if not row["present"]:
                continue
            same = before is not None and all(row[c] == before[c] for c in ("turn", "role", "text"))
            before = row
            turn = {c: row[c] for c in ("turn", "role", "text")}
            turn["fault"] = fault(row["text"], row["repeated"] or same)
            if len(held) >= PIECE_ROWS or (held and chars + len(row["text"]) > PIECE_CHARS):
                yield piece(conv_id, held, False)
                held, chars, several = [], 0, True
            held.append(turn)
            chars += len(row["text"])
        ahead = next(conversations, None)
        yield piece(conv_id, held, not (first or several or ahead is None))
        first = False


def _stitched(rows: Iterator[dict]) -> Iterator[dict]:
    """The way through the pieces of each conversation: their states, and the edits after the last."""
    for _, pieces in groupby(rows, key=lambda row: row["conv_id"]):
        names, costs, order = [], [], []
        for row in pieces:
            names.append((row["part"], row["piece"]))
            cost = np.full((4, 4), NEVER, np.int64)
            rank = np.full((4, 4), 127, np.int8)
            for place, option in enumerate(row["options"]):
                cost[option["start"], option["end"]] = option["cost"]
                rank[option["start"], option["end"]] = place
            costs.append(cost)
            order.append(rank)
        # The least cost from each state behind a piece to the end of the conversation.
        togo = [np.array([INSERT * len(TAILS[state]) for state in STATES], np.int64)]
        for cost in reversed(costs):
            togo.append(np.minimum((cost + togo[-1]).min(axis=1), NEVER))
        togo.reverse()
        state = START
        for i, (part, piece) in enumerate(names):
            total = costs[i][state] + togo[i + 1]
            best = [end for end in STATES if total[end] == total.min()]
            end = min(best, key=lambda e: order[i][state][e])
            tail = TAILS[end] if i + 1 == len(names) else ""
            yield {"part": part, "piece": piece, "start": state, "end": end, "tail": tail}
            state = end


def repair(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """Pieces of conversations with their cheapest edits, from ``turns(conv_id, turn, role, text)``.

    Gives ``conv_id, part, piece, whole, turns, start, edits, cost``: the turns of a conversation are
    those of its pieces in order of ``part`` and ``piece``, ``edits`` has a letter per edit (D, I, K, R).
    Turns are taken by ``turn``, nulls first, then role, then MD5 of the text; equal rows stand
    side by side and all but the first are duplicates. Null roles and texts count as one blank; the
    null conversation is one like others. A role without initial fits nowhere. Rows for which ``present`` is false
    only make their conversation known. Other columns are ignored; an empty table gives no rows.
    """
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.lit(True) if present is None else present).alias("present"),
    ).withColumn("print", F.md5(F.col("text").cast("binary")))
    said = rows.where("present").groupBy("conv_id", "role", "print").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"), F.count("*").alias("_n")
    )
    # Only what was said twice can be a duplicate, so the other side of the join is small in most tables.
    twice = said.where("_n > 1")
    marked = salted_join(
        rows, twice.select("conv_id", "role", "print", "first"), ["conv_id", "role", "print"], ["turn"], "left",
        null_safe=True, counts=twice.select("conv_id", "role", "print", "_n"),
    )
    later = F.struct(F.col("turn").isNotNull().alias("known"), "turn") > F.col("first")
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "print")]
    dealt = (
        marked.select("conv_id", "turn", "role", "text", "present", "print", F.coalesce(later, F.lit(False)).alias("repeated"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("print")
    )
    kind = turns.schema["conv_id"].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema(
            [
                ("conv_id", first.schema.field("conv_id").type),
                ("part", pa.int32()),
                ("piece", pa.int64()),
                ("whole", pa.bool_()),
                ("turns", pa.list_(TURN)),
                ("options", pa.list_(OPTION)),
            ]
        )

        def all_batches():
            yield first
            yield from batches

        for found in _batched(_pieces(_rows(all_batches())), schema):
            yield found

    name = kind.simpleString()
    pieces = saved(
        dealt.mapInArrow(
            cut,
            f"conv_id {name}, part int, piece long, whole boolean, turns array<{TURN_DDL}>, options array<{OPTION_DDL}>",
        ),
        "pieces",
    )

    way = pa.schema([("part", pa.int32()), ("piece", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("tail", pa.string())])

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(_stitched(_rows(batches)), way, 4096)

    # Costs and the ASCII order of the edits are all that the choice needs; the turns stay where they are.
    ranked = F.array_sort(
        "options", lambda a, b: F.when(a["edits"] < b["edits"], -1).when(a["edits"] > b["edits"], 1).otherwise(0)
    )
    narrow = F.transform(ranked, lambda o: F.struct(o["start"].alias("start"), o["end"].alias("end"), o["cost"].alias("cost")))
    ways = (
        pieces.where("NOT whole")
        .select("conv_id", "part", "piece", narrow.alias("options"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "piece")
        .mapInArrow(stitch, "part int, piece long, start int, `end` int, tail string")
    )
    columns = ["conv_id", "part", "piece", "whole", "turns", "start"]
    taken = F.filter("options", lambda o: (o["start"] == F.col("start")) & (o["end"] == F.col("end")))[0]
    parts = (
        pieces.where("NOT whole")
        .join(ways, ["part", "piece"])
        .withColumn("_taken", taken)
        .select(
            *columns,
            F.concat("_taken.edits", "tail").alias("edits"),
            (F.col("_taken.cost") + INSERT * F.length("tail")).alias("cost"),
        )
    )
    wholes = pieces.where("whole").withColumn("_taken", F.col("options")[0]).withColumn("start", F.lit(START))
    return wholes.select(*columns, F.col("_taken.edits").alias("edits"), F.col("_taken.cost").alias("cost")).unionByName(parts)


def repaired_turns(pieces: DataFrame) -> DataFrame:
    """``conv_id, part, piece, step, edit, turn, role, text`` per edit of :func:`repair`, in order of part, piece, step.

    Deleted turns have the edit D, inserted ones no turn and an empty text.
    """

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema(
                [(c, batch.schema.field(c).type) for c in ("conv_id", "part", "piece")]
                + [("step", pa.int32()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]
            )
            for row in _rows([batch]):
                found = [
                    {c: row[c] for c in ("conv_id", "part", "piece")}
                    | {"step": step, "edit": edit, "turn": turn, "role": role, "text": text}
                    for step, (edit, role, text, turn) in enumerate(applied(row["turns"], row["start"], row["edits"]))
                ]
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=schema)

    kind = pieces.schema["conv_id"].dataType.simpleString()
    return pieces.select("conv_id", "part", "piece", "turns", "start", "edits").mapInArrow(
        edits, f"conv_id {kind}, part int, piece long, step int, edit string, turn long, role string, text string"
    )


class Report:
    """What is told of one conversation, added up piece by piece."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.turns = 0
        self.lowest = self.highest = self.initial = None
        self.edits: list[str] = []
        self.hash, self.begun = hashlib.sha256(), False

    def add(self, row: dict) -> None:
        for turn in row["turns"]:
            if turn["fault"]:
                setattr(self, turn["fault"], getattr(self, turn["fault"]) + 1)
            initial = turn["role"][:1]
            self.illegal += self.initial is not None and self.initial + initial not in LEGAL_PAIRS
            self.initial = initial
            if turn["turn"] is not None and turn["turn"] != self.highest:
                self.turns += 1
                self.lowest = turn["turn"] if self.lowest is None else self.lowest
                self.highest = turn["turn"]
        for edit, role, text, _ in applied(row["turns"], row["start"], row["edits"]):
            if edit != "D":
                self.hash.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode())
                self.begun = True
        self.cost += row["cost"]
        self.edits.append(row["edits"])

    def row(self, conv_id) -> dict:
        gaps = 0 if self.lowest is None else self.highest - self.lowest + 1 - self.turns
        return {
            "conv_id": conv_id, "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate,
            "truncated": self.truncated, "illegal": self.illegal, "cost": self.cost,
            "audit": "".join(self.edits), "repaired_sha256": self.hash.hexdigest(),
        }


LONGS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def reports(pieces: DataFrame) -> DataFrame:
    """One row per conversation of :func:`repair`: faults, cost, edits and a digest of the repaired turns.

    A digest takes the turns one after another, so the pieces of a conversation pass through one
    task, one at a time; conversations that are one piece stay where they are.
    """

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema(
            [("conv_id", first.schema.field("conv_id").type), *[(c, pa.int64()) for c in LONGS]]
            + [("audit", pa.string()), ("repaired_sha256", pa.string())]
        )

        def small(batch):
            for at in range(0, batch.num_rows, 16):
                yield from batch.slice(at, 16).to_pylist()

        def rows():
            yield from small(first)
            for batch in batches:
                yield from small(batch)

        def all_reports():
            for conv_id, mine in groupby(rows(), key=lambda row: row["conv_id"]):
                report = Report()
                for row in mine:
                    report.add(row)
                yield report.row(conv_id)

        yield from _batched(all_reports(), schema, 1024)

    kind = pieces.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, {', '.join(f'{c} long' for c in LONGS)}, audit string, repaired_sha256 string"
    needed = pieces.select("conv_id", "part", "piece", "whole", "turns", "start", "edits", "cost")
    split = needed.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    return needed.where("whole").mapInArrow(told, ddl).unionByName(split.mapInArrow(told, ddl))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, present`` with the faults that a checksum of ``conv_id:turn`` deals out.

    Nulls count as one blank. Remainders of 20: 0 drops the row, 1 empties its text, 2 takes its
    stops away, 3 repeats it, 4 makes its role user.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    code = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", blank)
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(code == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (code != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(code == 3, 2).otherwise(1))).alias("_copy"),
    )
    return rows.drop("_copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report per conversation after the dealt damage; odd input as in :func:`repair` and :func:`damaged`."""
    rows = damaged(table(spark, sf_dir, "conversations"))
    return reports(repair(rows, F.col("present")))


QUERIES = {"op13_conversation_repair": op13_conversation_repair}

SQL = {
    "op13_conversation_repair": r"""
WITH RECURSIVE bits AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations
), coded AS (
  -- CRC-32 bit by bit
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(0, 8 * length(key)),
             lambda i: ((ascii(key[(i // 8) + 1]) >> CAST(i % 8 AS INTEGER)) & 1)::BIGINT)),
           lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384::BIGINT)), 4294967295::BIGINT) % 20 AS code
  FROM bits
), damaged AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM coded
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen,
         regexp_replace(text, '[\x20\x09-\x0D]+\z', '') AS held
  FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM damaged
  )
), turns AS (
  SELECT conv_id, turn, role, text, i, substr(role, 1, 1) AS initial,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         CASE WHEN held = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
              WHEN right(held, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault
  FROM numbered
), inserts(q, edits, q2, price, lines) AS (
  VALUES (0, '', 0, 0, ''), (1, '', 1, 0, ''), (2, '', 2, 0, ''), (3, '', 3, 0, ''),
         (0, 'I', 2, 2, 'user:' || chr(10)), (1, 'I', 2, 2, 'user:' || chr(10)), (3, 'I', 2, 2, 'user:' || chr(10)),
         (2, 'I', 3, 2, 'assistant:' || chr(10)),
         (0, 'II', 3, 4, 'user:' || chr(10) || 'assistant:' || chr(10)),
         (1, 'II', 3, 4, 'user:' || chr(10) || 'assistant:' || chr(10))
), best AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, CAST(0 AS BIGINT) AS cost, '' AS audit, '' AS lines FROM conversations
  UNION ALL
  SELECT conv_id, i, q, min(cost), arg_min(audit, (cost, audit)), arg_min(lines, (cost, audit))
  FROM (
    SELECT b.conv_id, t.i,
           CASE e.edit WHEN 'D' THEN n.q2 WHEN 'K' THEN CASE t.initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END
                ELSE CASE n.q2 WHEN 2 THEN 3 ELSE 2 END END AS q,
           b.cost + n.price + CASE e.edit WHEN 'D' THEN 3 WHEN 'K' THEN 0 ELSE 2 END
             + CASE WHEN e.edit <> 'D' AND t.fault = 'truncated' THEN 1 ELSE 0 END AS cost,
           b.audit || n.edits || e.edit AS audit,
           b.lines || n.lines || CASE e.edit WHEN 'D' THEN '' WHEN 'K' THEN t.role || ':' || t.text || chr(10)
             ELSE CASE n.q2 WHEN 2 THEN 'assistant:' ELSE 'user:' END || t.text || chr(10) END AS lines
    FROM best b
    JOIN turns t ON t.conv_id IS NOT DISTINCT FROM b.conv_id AND t.i = b.i + 1
    JOIN inserts n ON n.q = b.q
    JOIN (VALUES ('D'), ('K'), ('R')) e(edit) ON e.edit = 'D' OR (t.fault NOT IN ('blank', 'duplicate') AND (e.edit = 'R'
      OR (t.initial = 's' AND n.q2 = 0) OR (t.initial = 'u' AND n.q2 IN (0, 1, 3)) OR (t.initial = 'a' AND n.q2 = 2)))
  ) GROUP BY conv_id, i, q
), ended AS (
  SELECT b.conv_id, min(b.cost + n.price) AS cost,
         arg_min(b.audit || n.edits, (b.cost + n.price, b.audit || n.edits)) AS audit,
         arg_min(b.lines || n.lines, (b.cost + n.price, b.audit || n.edits)) AS lines
  FROM best b JOIN inserts n ON n.q = b.q AND n.q2 IN (0, 3)
  WHERE b.i = (SELECT count(*) FROM turns t WHERE t.conv_id IS NOT DISTINCT FROM b.conv_id)
  GROUP BY b.conv_id
), told AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY conv_id
)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(cost AS BIGINT) AS cost, audit,
       sha256(CASE WHEN lines = '' THEN '' ELSE lines[:-2] END) AS repaired_sha256
FROM ended e LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM e.conv_id
"""
}
