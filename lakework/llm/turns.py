"""Conversations repaired to a grammar of turns by the cheapest edits.

Conversations are dealt by a hash of their id.  A task cuts its rows into segments
of bounded length and solves a batch of them by one recursive DuckDB query: each
recursion takes one more turn of all segments and keeps, for each state of the
grammar, the least cost and its edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import duckdb
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakework.llm.common import arrow_schema, small_or_plain, small_slices, staged

SPACE = " \t\n\x0b\x0c\r"

#: States of ``(s?(ua)+)?``: nothing yet, after s, after u, after a.  Nothing and after a may end.
NONE, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {(NONE, "s"): SYSTEM, (NONE, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDS = (NONE, ASSISTANT)
ROLES = {USER: "user", ASSISTANT: "assistant"}

#: Costs of the edits; a truncated turn that isn't deleted adds TRUNCATED.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

#: Turns of a segment: a recursion is as deep, and a longer conversation goes on in the next segment.
SEGMENT = 128

_INSERTS = {(s, t): ("I", INSERT) for (s, r), t in STEPS.items() if r != "s"}
#: What may be inserted between two turns: nothing, one or two; three cost more than one for the same state.
_BETWEEN = [(s, s, "", 0) for s in range(4)] + [(s, t, *e) for (s, t), e in _INSERTS.items()] + [(s, u, "II", 2 * INSERT) for s, t in _INSERTS for t2, u in _INSERTS if t == t2 and s != u]


def moves() -> list[tuple[str, int, int, int, str]]:
    """(code, state, next state, cost, edits) of one turn and what is inserted after it.

    A turn's code is its role's initial (o for others), upper case if it is
    truncated; x if it must be deleted.
    """
    found = {}
    for code in "xsuaoSUAO":
        cut = TRUNCATED if code.isupper() else 0
        for state in range(4):
            edits = [(state, DELETE, "D")]
            if code != "x":
                edits += [(t, cut, "K") for (s, r), t in STEPS.items() if s == state and r == code.lower()]
                edits += [(t, cut + REROLE, "R") for (s, r), t in STEPS.items() if s == state and r != "s"]
            for after, cost, letter in edits:
                for s, t, letters, more in _BETWEEN:
                    if s == after:
                        key, value = (code, state, t), (cost + more, letter + letters)
                        found[key] = min(found.get(key, value), value)
    return [(*key, *value) for key, value in sorted(found.items())]


#: Equal costs of one state and as many turns never have edits that begin one another, so a least prefix stays least.
RECURSION = """
WITH RECURSIVE best(id, start, i, state, cost, audit) AS (
  SELECT s.id, s.start, 0, o.state, o.cost, o.audit FROM segments s JOIN openings o ON s.start = o.start
  UNION ALL
  SELECT id, start, i + 1, state, least_.cost, least_.audit FROM (
    SELECT b.id, b.start, b.i, m.after AS state, min({'cost': b.cost + m.cost, 'audit': b.audit || m.edits}) AS least_
    FROM best b JOIN segments s ON b.id = s.id AND b.start = s.start JOIN moves m ON m.state = b.state AND m.code = substr(s.codes, b.i + 1, 1)
    WHERE b.i < length(s.codes) GROUP BY b.id, b.start, b.i, m.after
  )
)
SELECT b.id, b.start, b.state, b.cost, b.audit FROM best b JOIN segments s ON b.id = s.id AND b.start = s.start WHERE b.i = length(s.codes)
"""

#: The start of a conversation may insert before its first turn (start -1); a later segment's inserts are its predecessor's.
_OPENINGS = [(-1, t, cost, letters) for s, t, letters, cost in _BETWEEN if s == NONE] + [(s, s, 0, "") for s in range(4)]


class Solver:
    """Least costs and edits of segments, by DuckDB."""

    def __init__(self):
        self.db = duckdb.connect(":memory:")
        self.db.execute("SET threads = 1")
        self.db.execute("SET temp_directory = ''")
        self.db.execute("CREATE TABLE moves(code VARCHAR, state INT, after INT, cost BIGINT, edits VARCHAR)")
        self.db.executemany("INSERT INTO moves VALUES (?, ?, ?, ?, ?)", moves())
        self.db.execute("CREATE TABLE openings(start INT, state INT, cost BIGINT, audit VARCHAR)")
        self.db.executemany("INSERT INTO openings VALUES (?, ?, ?, ?)", _OPENINGS)

    def solve(self, segments: set[tuple[str, int]]) -> dict[tuple[str, int], list[tuple[int, int, str]]]:
        """For each (codes, start) the (state, cost, audit) of the states it may end in; equal segments are solved once."""
        keys = sorted(segments)
        table = pa.table({"id": pa.array(range(len(keys)), pa.int64()), "codes": pa.array([k[0] for k in keys], pa.string()), "start": pa.array([k[1] for k in keys], pa.int32())})
        self.db.register("segments", table)
        found: dict[tuple[str, int], list[tuple[int, int, str]]] = {k: [] for k in keys}
        for i, _, state, cost, audit in self.db.execute(RECURSION).fetchall():
            found[keys[i]].append((state, cost, audit))
        self.db.unregister("segments")
        return found


class Conversation:
    """What is known of a conversation while its turns stream by: counts, and a path for each state."""

    def __init__(self, conv_id, long: bool):
        self.conv_id, self.long = conv_id, long
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.least, self.last = 0, None, None
        self.initial, self.before, self.seen = None, None, set()
        #: state: cost, edits, digest and whether it has turns; None before the first segment
        self.paths: dict[int, tuple[int, str, object, bool]] | None = None

    def code(self, turn, role: str, text: str, ending: str, later: bool | None) -> str:
        """Count a turn's fault and tell its code; turns come in order."""
        if turn is not None and turn != self.last:
            self.turns += 1
            self.last = turn
            self.least = turn if self.least is None else self.least
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        same = (turn, role, text)
        if self.long:
            again = later or same == self.before
            self.before = same
        else:
            again = (role, text) in self.seen
            self.seen.add((role, text))
        if ending == "":
            self.blank += 1
            return "x"
        if again:
            self.duplicate += 1
            return "x"
        code = initial if initial in ("s", "u", "a") else "o"
        if ending not in ".!?":
            self.truncated += 1
            return code.upper()
        return code

    def starts(self) -> tuple[int, ...]:
        return (-1,) if self.paths is None else tuple(range(4))

    def advance(self, codes: str, rows: list[tuple[str, str]], table: dict, last: bool) -> None:
        """Go through a segment, solved for each start: the best way into each state, with the digest of what it leaves."""
        before = {-1: (0, "", hashlib.sha256(), False)} if self.paths is None else self.paths
        best: dict[int, tuple[int, str, int, str]] = {}
        for start, (cost, audit, _, _) in before.items():
            for state, more, edits in table[codes, start]:
                if last and state not in ENDS:
                    continue
                way = cost + more, audit + edits, start, edits
                if state not in best or way[:2] < best[state][:2]:
                    best[state] = way
        if last:
            state = min(best, key=lambda s: best[s][:2])
            best = {state: best[state]}
        self.paths = {}
        for state, (cost, audit, start, edits) in best.items():
            digest, some = before[start][2].copy(), before[start][3]
            for _, role, text in replay(edits, rows, max(start, NONE)):
                digest.update(f"{chr(10) if some else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                some = True
            self.paths[state] = cost, audit, digest, some

    def result(self) -> tuple:
        cost, audit, digest, _ = next(iter(self.paths.values()))
        gaps = self.last - self.least + 1 - self.turns if self.turns else 0
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest.hexdigest()


def replay(edits: str, rows, state: int = NONE) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns that edits leave of (role, text) rows, from a state on."""
    rows = iter(rows)
    for edit in edits:
        if edit == "D":
            next(rows)
            continue
        role, text = next(rows) if edit != "I" else ("", "")
        if edit == "K":
            state = STEPS[state, role[:1]]
        else:
            state = USER if state != USER else ASSISTANT
            role = ROLES[state]
        yield edit, role, text


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): the rows with their hashed damage.

    A null role or text is one space, as a null id or turn is in the hash's key.  A
    dropped row stays as a row without text that is ``gone``, so no conversation is lost.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), part("role").alias("role"), part("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), "kind")
    return rows.select("conv_id", "turn", "role", "text", (F.col("kind") == 0).alias("gone"), F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _flagged(rows: DataFrame, long_turns: int) -> DataFrame:
    """Rows with their last character besides whitespace, whether their conversation is long, and if so whether an earlier turn says the same.

    Within a conversation of up to ``long_turns`` turns the task that has it remembers
    what was said.  For longer ones an aggregation finds the first turn of each text.
    """
    ending = F.right(F.rtrim(F.col("text"), F.lit(SPACE)), F.lit(1)).alias("ending")
    counts = staged(rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > long_turns).select(F.col("conv_id").alias("long_id"), F.lit(True).alias("long")), "turns-long")
    if not counts.limit(1).count():
        return rows.select("*", ending, F.lit(False).alias("long"), F.lit(False).alias("later"))
    counts = small_or_plain(counts, 1_000_000)
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    marked = rows.join(counts, F.col("conv_id").eqNullSafe(F.col("long_id")), "left").select(*rows.columns, ending, F.coalesce("long", F.lit(False)).alias("long"))
    marked = marked.withColumn("said", F.when(F.col("long"), said))
    place = F.struct(F.col("turn").isNotNull().alias("p"), F.col("turn").alias("t"))
    first = marked.where("long and not gone").groupBy(F.col("conv_id").alias("first_id"), F.col("said").alias("first_said")).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    first = small_or_plain(staged(first, "turns-first"), 200_000, "first_said")
    joined = marked.join(first, (F.col("said") == F.col("first_said")) & F.col("conv_id").eqNullSafe(F.col("first_id")), "left")
    return joined.select(*rows.columns, "ending", "long", F.coalesce(place > F.col("first"), F.lit(False)).alias("later"))


def _results(id_type: T.DataType) -> T.StructType:
    counts = [T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return T.StructType([T.StructField("conv_id", id_type), *counts, T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])


def repair(rows: DataFrame, long_turns: int = 4096, batch_rows: int = 20_000, batch_chars: int = 8_000_000, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, gone): counts of faults, the cheapest edits and the repaired digest.

    Turns are taken by turn (nulls first), then role and text, so that the order of
    equal turns is defined.  A turn's first fault counts: blank, duplicate (said before by the
    same role), truncated.  Keep costs 0, rerole 2, delete 3 (a must for blanks and duplicates),
    insert 2, an undeleted truncated turn 1.  Of the cheapest edits that leave role initials of
    the grammar, the ASCII-least are the audit.  An empty role has no initial and can't be kept.
    ``gone`` rows only keep their conversation; one of nothing else has zeros, an empty audit and
    the digest of an empty string.  Null ids are a conversation.  Roles and texts mustn't be null.
    No rows, no result.

    Conversations are dealt by a hash of their id and stream through a task in order: it
    holds ``batch_rows`` turns or ``batch_chars`` characters, and one more.  A conversation of
    any length goes on from segment to segment with a cost, edits and a running digest for each
    state.  A digest over a whole conversation is one sequence, so one task makes it.
    """
    schema = _results(rows.schema["conv_id"].dataType)
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver: Solver | None = None
        waiting: list[tuple[Conversation, str, list, bool]] = []
        at: Conversation | None = None
        codes: list[str] = []
        turns: list[tuple[str, str]] = []
        held = chars = 0

        def solved() -> pa.RecordBatch:
            nonlocal solver, held, chars
            solver = solver or Solver()
            # only the first of a conversation's segments has one start; the others' are known when it is solved
            starts, wanted = {}, set()
            for conv, text, _, _ in waiting:
                wanted |= {(text, s) for s in starts.get(conv, conv.starts())}
                starts[conv] = range(4)
            table, done = solver.solve(wanted), []
            for conv, text, rows_, last in waiting:
                conv.advance(text, rows_, table, last)
                if last:
                    done.append(conv.result())
            waiting.clear()
            held = chars = 0
            return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], f.type) for k, f in enumerate(arrow)], schema=arrow)

        def close(last: bool) -> None:
            nonlocal codes, turns
            waiting.append((at, "".join(codes), turns, last))
            codes, turns = [], []

        for batch in batches:
            for part in small_slices(*batch.columns):
                for conv_id, turn, role, text, gone, ending, long, later in zip(*(c.to_pylist() for c in part), strict=True):
                    if at is None or at.conv_id != conv_id:
                        if at is not None:
                            close(True)
                        at = Conversation(conv_id, long)
                    if not gone:
                        if len(codes) >= segment:
                            close(False)
                        codes.append(at.code(turn, role, text, ending, later))
                        turns.append((role, text))
                        held, chars = held + 1, chars + len(text)
                    if (held >= batch_rows or chars >= batch_chars) and waiting:
                        yield solved()
                        held, chars = len(turns), sum(len(t) for _, t in turns)
        if at is not None:
            close(True)
            yield solved()

    flagged = _flagged(rows.select("conv_id", "turn", "role", "text", "gone"), long_turns)
    dealt = flagged.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return dealt.select("conv_id", "turn", "role", "text", "gone", "ending", "long", "later").mapInArrow(run, schema)


REPAIRED = ("place", "role", "text", "edit")


def repaired_turns(rows: DataFrame, results: DataFrame) -> DataFrame:
    """The repaired conversations as rows: conv_id, place from 0, role, text and the edit that left them.

    ``results`` are ``repair``'s of the same rows.  Each conversation's edits come before its
    turns in its task's order, so nothing is joined and nothing but one turn and the edits is held.
    """
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("place", T.LongType()), *(T.StructField(c, T.StringType()) for c in REPAIRED[1:])])
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def values():
            for batch in batches:
                for part in small_slices(*batch.columns):
                    yield from zip(*(c.to_pylist() for c in part), strict=True)

        stream, out = values(), []
        for conv_id, audit, _, _ in stream:
            # exactly the turns that the edits take follow their head
            turns = ((role, text) for _, _, role, text in stream)
            for place, (edit, role, text) in enumerate(replay(audit, turns)):
                out.append((conv_id, place, role, text, edit))
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, r, strict=True)) for r in out], schema=arrow)
                    out = []
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, r, strict=True)) for r in out], schema=arrow)

    null = F.lit(None)
    heads = results.select("conv_id", "audit", F.lit(0).alias("k"), null.cast("long").alias("turn"), null.cast("string").alias("role"), null.cast("string").alias("text"))
    bodies = rows.where("not gone").select("conv_id", null.cast("string").alias("audit"), F.lit(1).alias("k"), "turn", "role", "text")
    dealt = heads.unionByName(bodies).repartition("conv_id").sortWithinPartitions("conv_id", "k", F.col("turn").asc_nulls_first(), "role", "text")
    return dealt.select("conv_id", "audit", "role", "text").mapInArrow(run, schema)
