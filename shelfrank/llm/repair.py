"""Repair of conversation structure by depth-first branch and bound over edits.

A conversation should read: a system turn or none, then user and assistant in turn, ending with the assistant. Its rows are
kept, given another role or deleted, and empty turns may be inserted; the cheapest edits are wanted, and of those the ones
whose initials come first as text.

A node of the search is a row and what the last turn that stands was; a branch is a prefix of edits with its cost. Branches
wait on an explicit stack. A branch goes if its cost and the suffix lower bound of its node exceed the incumbent (cost,
audit), or if the node's dominance table holds a prefix as cheap whose audit comes first: the rest of both is the same, so
the worse prefix can never win. When the stack is empty the incumbent is proved.

Rows are dealt to tasks by ranges of (conversation, turn), so a conversation of any length is spread over many tasks. It is
cut into segments of bounded length; a segment is solved for every pair of states before and after it, the costs of a
conversation's segments are chained, and each segment then takes the edits of its chosen pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.session import materialise

#: Rows and bytes of text of a segment; rows that one task reads, on average.
SEGMENT = 512
SEGMENT_BYTES = 8 << 20
TASK_ROWS = 200_000

#: What stands before a node: nothing, a system turn, a user's, an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
DELETE, RENAME, INSERT, CUT_SHORT = 2, 1, 5, 5
#: The role that may be inserted or given in each state, and the state after it.
WANTED = ("user", "user", "assistant", "user")
AFTER = (USER, USER, ASSISTANT, USER)
#: Codes of rows: three times the role's kind and the fault's.
INITIALS = "sua"
SOUND, TRUNCATED, FORCED = range(3)
#: State after a row of each kind of role is kept, by state; -1 where it can't be.
KEPT = ((SYSTEM, USER, -1, -1), (-1, USER, -1, -1), (-1, -1, ASSISTANT, -1), (-1, USER, -1, -1))
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: Turns that must be inserted at the end of a conversation, by state.
TAIL = ("", "II", "I", "")
FAR = 1 << 60

# ---- search ----------------------------------------------------------------------------------


def _bounds(codes: bytes, goals: dict[int, str]) -> list[tuple[int, int, int]]:
    """Suffix lower bounds per row for nothing, a user's turn wanted, an assistant's turn wanted.

    A relaxation: after a system turn counts as after an assistant's, so a conversation could end there.
    """
    ends = [FAR, FAR, FAR]
    for state, tail in goals.items():
        at = (0, 1, 2, 1)[state]
        ends[at] = 0 if state in (SYSTEM, ASSISTANT) else min(ends[at], INSERT * len(tail))
    none, user, assistant = ends
    out = [(none, user, assistant)]
    for code in reversed(codes):
        role, fault = divmod(code, 3)
        if fault == FORCED:
            own = [none + DELETE, user + DELETE, assistant + DELETE]
        else:
            add = CUT_SHORT * fault
            give = add + RENAME
            to_a, to_u = assistant + (add if role == 1 else give), user + (add if role == 2 else give)
            own = [
                min(none + DELETE, to_a, user + add if role == 0 else FAR),
                min(user + DELETE, to_a),
                min(assistant + DELETE, to_u),
            ]
        none = min(own[0], INSERT + own[2])
        user = min(own[1], INSERT + own[2])
        assistant = min(own[2], INSERT + own[1])
        out.append((none, user, assistant))
    out.reverse()
    return out


def search(codes: bytes, entry: int, goals: dict[int, str]) -> tuple[int, str] | None:
    """Least (cost, audit) from a state over all rows to one of the goals, each with the insertions that end it.

    Insertions stand before the row that they make fit or in a goal's ending. None if no goal can be reached.
    """
    bound = _bounds(codes, goals)
    phase = (0, 1, 2, 1)
    n = len(codes)
    incumbent: tuple[int, str] | None = None
    table: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "", False)]
    while stack:
        row, state, cost, audit, inserted = stack.pop()
        if incumbent:
            least = cost + bound[row][phase[state]]
            if least > incumbent[0] or least == incumbent[0] and audit > incumbent[1][: len(audit)]:
                continue
        if not inserted:
            known = table.get((row, state))
            if known is not None and known <= (cost, audit):
                continue
            table[row, state] = (cost, audit)
        if row == n:
            tail = goals.get(state)
            if tail is not None and (incumbent is None or (cost + INSERT * len(tail), audit + tail) < incumbent):
                incumbent = (cost + INSERT * len(tail), audit + tail)
            continue
        role, fault = divmod(codes[row], 3)
        found = [(row + 1, state, cost + DELETE, audit + "D", False)] if not inserted else []
        if fault != FORCED:
            add = cost + CUT_SHORT * fault
            kept = KEPT[state][role]
            if kept >= 0:
                found.append((row + 1, kept, add, audit + "K", False))
            if kept != AFTER[state]:
                found.append((row + 1, AFTER[state], add + RENAME, audit + "R", False))
            if not inserted:
                # a turn that is inserted only to be followed by a deletion may as well stand behind it
                found.append((row, AFTER[state], cost + INSERT, audit + "I", True))
        # the most hopeful branch, then the first letter, is looked at first
        ranked = [(c + bound[r][phase[s]], a, r, s, c, i) for r, s, c, a, i in found]
        ranked.sort(reverse=True)
        stack.extend((r, s, c, a, i) for f, a, r, s, c, i in ranked if f < FAR)
    return incumbent


@lru_cache(maxsize=1 << 14)
def solve(codes: bytes) -> tuple[int, str]:
    """Cost and audit of a whole conversation; deleting all rows always does."""
    return search(codes, START, dict(enumerate(TAIL)))


@lru_cache(maxsize=1 << 8)
def solve_segment(codes: bytes) -> tuple[list[int], list[int], list[str]]:
    """For every state before (by four) and after: the cost, the audit's place among those of its state before, the audit."""
    costs, ranks, audits = [], [], []
    for entry in range(4):
        found = [search(codes, entry, {leave: ""}) or (FAR, "") for leave in range(4)]
        costs += [c for c, _ in found]
        audits += [a for _, a in found]
        ranks += [sorted(a for _, a in found).index(a) for _, a in found]
    return costs, ranks, audits


def edited(audit: str, entry: int, rows: dict[int, tuple[str, str]]) -> list[tuple[str, str, str]]:
    """The turns that stand after the edits: (edit, role, text)."""
    state, at, out = entry, 0, []
    for edit in audit:
        if edit == "I":
            out.append((edit, WANTED[state], ""))
            state = AFTER[state]
            continue
        if edit != "D":
            role, text = rows[at]
            out.append((edit, role if edit == "K" else WANTED[state], text))
            state = KEPT[state][kind_of(role)] if edit == "K" else AFTER[state]
        at += 1
    return out


def kind_of(role: str) -> int:
    """0 to 2 for s, u and a, by the first character; 3 for all else."""
    at = INITIALS.find(role[0]) if role else -1
    return at if at >= 0 else 3


# ---- rows ------------------------------------------------------------------------------------


def _blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def _in_order(turns: DataFrame, known: DataFrame, parts: int) -> DataFrame:
    """Rows of all conversations in ranges of (conv_id, turn, key), in that order inside each.

    Kind 0 has the first row of a role and text in a conversation, with both; kind 1 counts the rows of a turn with one
    role and text, the first row included; kind -1 only says that the conversation exists.
    """
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumn("key", F.unhex(F.sha2(F.concat(F.col("role"), F.lit("\0"), F.col("text")), 256)))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    texts = (
        rows.groupBy("conv_id", "key")
        .agg(
            # a null turn comes first
            F.min(F.struct(F.col("turn").isNotNull().alias("there"), "turn"))["turn"].alias("turn"),
            F.first("role").alias("role"),
            F.first("text").alias("text"),
        )
        .withColumn("blank", _blank(F.col("text")))
        .withColumn(
            "fault",
            F.when(F.col("blank"), FORCED).when(F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), SOUND).otherwise(TRUNCATED),
        )
        .select(
            "conv_id", "turn", "key", F.lit(0).alias("kind"), F.lit(1).cast("long").alias("n"), kind.alias("role_kind"),
            "fault", "blank",
            *(F.when(F.col("fault") != FORCED, F.col(c)).alias(c) for c in ("role", "text")),
        )
    )
    counted = (
        rows.select("conv_id", "turn", "key", kind.alias("role_kind"), _blank(F.col("text")).alias("blank"))
        .groupBy("conv_id", "turn", "key", "role_kind", "blank")
        .agg(F.count("*").alias("n"))
        .select(
            "conv_id", "turn", "key", F.lit(1).alias("kind"), "n", "role_kind", F.lit(FORCED).alias("fault"), "blank",
            F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
        )
    )
    named = known.select("conv_id").distinct()
    named = named.select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit(b"").alias("key"), F.lit(-1).alias("kind"),
        F.lit(0).cast("long").alias("n"), F.lit(3).alias("role_kind"), F.lit(FORCED).alias("fault"),
        F.lit(False).alias("blank"), *(F.lit(None).cast("string").alias(c) for c in ("role", "text")),
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "key")]
    ranged = texts.unionByName(counted).unionByName(named).repartitionByRange(parts, *order)
    return ranged.sortWithinPartitions(*order, "kind").withColumn("part", F.spark_partition_id())


class _Segment:
    """Rows of one conversation that one task reads in turn, up to a number."""

    def __init__(self):
        self.codes = bytearray()
        self.rows: dict[int, tuple[str, str]] = {}
        self.size = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_kind = self.last_kind = self.first_turn = self.last_turn = None

    def add(self, kind: int, fault: int, turn: int | None, n: int = 1) -> None:
        if self.codes:
            self.illegal += (self.last_kind, kind) not in LEGAL
        else:
            self.first_kind = kind
        self.illegal += n - 1
        self.last_kind = kind
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.codes += bytes([3 * kind + fault]) * n


TURNS = "array<struct<edit:string,role:string,text:string>>"
COUNTS = ("blank", "duplicate", "truncated", "illegal")
_RAW = pa.list_(pa.struct([("at", pa.int32()), ("role", pa.string()), ("text", pa.string())]))
_TURNS = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))


def _segments(ordered: DataFrame, segment: int, segment_bytes: int) -> DataFrame:
    """One row per segment: a conversation that lies whole in one is repaired at once, the others give their costs."""
    kind = ordered.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {kind}, part int, seg int, whole boolean, blank long, duplicate long, truncated long, illegal long, "
        f"cost long, audit string, turns {TURNS}, first_kind int, last_kind int, first_turn long, last_turn long, n_turns long, "
        "costs array<long>, ranks array<int>, audits array<string>, rows array<struct<at:int,role:string,text:string>>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = [0]
        seg = 0
        part, conv, conv_value, now, whole, before = -1, None, None, None, False, None
        id_type = None

        def end(last: bool) -> None:
            nonlocal seg, now, whole
            codes = bytes(now.codes)
            alone = whole and last
            cost = audit = turns = costs = ranks = audits = rows = None
            if alone:
                cost, audit = solve(codes)
                turns = [dict(zip(("edit", "role", "text"), t, strict=True)) for t in edited(audit, START, now.rows)]
            else:
                costs, ranks, audits = solve_segment(codes)
                rows = [{"at": at, "role": role, "text": text} for at, (role, text) in now.rows.items()]
            out.append((
                conv_value, part, seg, alone, now.blank, now.duplicate, now.truncated, now.illegal, cost, audit, turns,
                now.first_kind, now.last_kind, now.first_turn, now.last_turn, now.turns, costs, ranks, audits, rows,
            ))
            held[0] += now.size + 1000
            seg += 1
            now, whole = _Segment(), False

        def flush() -> pa.RecordBatch:
            types = [
                id_type, pa.int32(), pa.int32(), pa.bool_(), *[pa.int64()] * 5, pa.string(), _TURNS, pa.int32(), pa.int32(),
                *[pa.int64()] * 3, pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string()), _RAW,
            ]
            arrays = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)]
            out.clear()
            held[0] = 0
            return pa.RecordBatch.from_arrays(arrays, names=names)

        names = [c.strip().split()[0] for c in schema.replace("struct<at:int,role:string,text:string>", "x").replace(TURNS, "x").split(",")]
        for batch in batches:
            id_type = batch.schema.field(0).type
            for own, turn, key, kind_, n, role_kind, fault, blank, role, text, part_ in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if now is None or own != conv:
                    # the first conversation of a task may have begun in another one
                    inner = now is not None
                    if inner:
                        end(True)
                    now, whole, part, conv, conv_value = _Segment(), inner, part_, own, own
                    before = None
                if kind_ < 0:
                    continue
                if kind_ == 0:
                    if len(now.codes) >= segment or now.size and now.size + len(text or "") > segment_bytes:
                        end(False)
                    if role is not None:
                        now.rows[len(now.codes)] = (role, text)
                        now.size += len(text)
                    now.blank += blank
                    now.truncated += fault == TRUNCATED
                    now.add(role_kind, fault, turn)
                    before = (turn, key)
                    continue
                n -= before == (turn, key)
                while n:
                    if len(now.codes) >= segment:
                        end(False)
                    some = min(n, segment - len(now.codes))
                    if blank:
                        now.blank += some
                    else:
                        now.duplicate += some
                    now.add(role_kind, FORCED, turn, some)
                    n -= some
                if held[0] > 4 << 20 or len(out) >= 2000:
                    yield flush()
        if now is not None:
            # and the last one may go on in another
            whole = False
            end(True)
        if out:
            yield flush()

    columns = ("conv_id", "turn", "key", "kind", "n", "role_kind", "fault", "blank", "role", "text", "part")
    return ordered.select(*columns).mapInArrow(run, schema)


# ---- chain -----------------------------------------------------------------------------------

CHAIN = "part int, seg int, piece long, n_pieces long, entry int, leave int, tail string, gaps long, more_illegal long"


def chain(table: pa.Table) -> pa.Table:
    """States before and after each segment of one conversation, by the costs of all.

    From the last segment back, the least cost to the end from every state; from the first on, of the states that reach it
    the one whose audit comes first. Audits of one segment have as many letters other than I and end with one, so none is
    the beginning of another.
    """
    rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["seg"]))
    ahead = [INSERT * len(t) for t in TAIL]
    togo = [ahead]
    for r in reversed(rows):
        ahead = [min(r["costs"][4 * q + p] + ahead[p] for p in range(4)) for q in range(4)]
        togo.append(ahead)
    togo.reverse()
    state, out, last_kind, last_turn, first_turn, n_turns = START, [], None, None, None, 0
    for k, r in enumerate(rows):
        leave = min(range(4), key=lambda p: (r["costs"][4 * state + p] + togo[k + 1][p], r["ranks"][4 * state + p]))
        joint = last_kind is not None and r["first_kind"] is not None and (last_kind, r["first_kind"]) not in LEGAL
        if r["first_turn"] is not None:
            n_turns += r["n_turns"] - (r["first_turn"] == last_turn)
            first_turn = r["first_turn"] if first_turn is None else first_turn
            last_turn = r["last_turn"]
        last_kind = r["last_kind"] if r["last_kind"] is not None else last_kind
        out.append([r["part"], r["seg"], k, len(rows), state, leave, "", 0, int(joint)])
        state = leave
    out[-1][6] = TAIL[state]
    out[0][7] = last_turn - first_turn + 1 - n_turns if n_turns else 0
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in CHAIN.split(", ")]
    return pa.table([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def repair(
    turns: DataFrame, known: DataFrame | None = None, segment: int = SEGMENT, segment_bytes: int = SEGMENT_BYTES
) -> DataFrame:
    """Repaired conversations in pieces: ``conv_id, piece, n_pieces, gaps, blank, duplicate, truncated, illegal, cost, audit,
    turns`` (edit, role, text of what stands).

    ``turns`` has conv_id, turn, role, text. A conversation's rows are taken by turn (nulls first), rows of one turn by the
    SHA-256 of role and text. Null roles and texts count as one space; a null conv_id is a conversation of its own. A row's
    first fault counts: blank, duplicate (its role and text came before), truncated (no mark ``.!?`` at its end). Blank and
    duplicate rows are deleted; other roles than those that begin with s, u or a are renamed or deleted. ``gaps`` are turn
    numbers that lack, without null turns. Almost all conversations are one piece; all counts and costs of a longer one are
    summed over its pieces, its audits and turns follow each other. ``known`` lists conversations (column conv_id) that have
    a row even if none of their turns is left: one piece without edits. Further columns are ignored.
    """
    spark = turns.sparkSession
    known = turns if known is None else known
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns.count() // TASK_ROWS))
    found = materialise(_segments(_in_order(turns, known, parts), segment, segment_bytes), "repair-segments")
    gaps = F.when(F.col("n_turns") > 0, F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns")).otherwise(0)
    whole = found.where("whole").select(
        "conv_id", F.lit(0).cast("long").alias("piece"), F.lit(1).cast("long").alias("n_pieces"), gaps.cast("long").alias("gaps"),
        *COUNTS, "cost", "audit", "turns",
    )
    split = found.where(~F.col("whole"))
    slim = split.select("conv_id", "part", "seg", "costs", "ranks", "first_kind", "last_kind", "first_turn", "last_turn", "n_turns")
    chosen = slim.groupBy("conv_id").applyInArrow(chain, CHAIN)
    pair = (F.col("entry") * 4 + F.col("leave")).cast("int")
    joined = split.join(chosen, ["part", "seg"]).select(
        "conv_id", "piece", "n_pieces", "gaps", "blank", "duplicate", "truncated",
        (F.col("illegal") + F.col("more_illegal")).alias("illegal"),
        (F.get("costs", pair) + INSERT * F.length("tail")).alias("cost"),
        F.concat(F.get("audits", pair), "tail").alias("audit"),
        "rows", "entry",
    )

    names = whole.columns

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                audit, rows, entry = (one.column(c)[0].as_py() for c in (9, 10, 11))
                turns = edited(audit, entry, {r["at"]: (r["role"], r["text"]) for r in rows})
                own = pa.array([[dict(zip(("edit", "role", "text"), t, strict=True)) for t in turns]], _TURNS)
                yield pa.RecordBatch.from_arrays([*one.columns[:10], own], names=names)

    return whole.unionByName(joined.mapInArrow(apply, whole.schema))


def repaired_turns(pieces: DataFrame) -> DataFrame:
    """``conv_id, piece, place, edit, role, text``: the turns that stand, in order by piece and place."""
    return pieces.select("conv_id", "piece", F.posexplode("turns").alias("place", "own")).select("conv_id", "piece", "place", "own.*")


def digests(pieces: DataFrame) -> DataFrame:
    """One row per conversation: counts, cost, audit and ``repaired_sha256`` of its lines ``role:text``.

    A conversation of one piece is hashed by a built-in function. The pieces of longer ones pass a task one by one: a hash
    needs its text in order, but no more of it in memory than one piece.
    """
    sums = ("gaps", *COUNTS, "cost")
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    one = pieces.where("n_pieces = 1").select("conv_id", *sums, "audit", F.sha2(lines, 256).alias("repaired_sha256"))

    names = one.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, audits, seen, hashed = [0] * len(sums), [], False, hashlib.sha256()
        for batch in batches:
            for k in range(batch.num_rows):
                piece, n_pieces, *own, audit, text, n_lines = (c[k].as_py() for c in batch.columns[1:])
                if piece == 0:
                    total, audits, seen, hashed = [0] * len(sums), [], False, hashlib.sha256()
                total = [a + b for a, b in zip(total, own, strict=True)]
                audits.append(audit)
                if n_lines:
                    hashed.update(b"\n" * seen + text.encode())
                    seen = True
                if piece == n_pieces - 1:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(k, 1),
                            *(pa.array([x], pa.int64()) for x in total),
                            pa.array(["".join(audits)]),
                            pa.array([hashed.hexdigest()]),
                        ],
                        names=names,
                    )

    more = (
        pieces.where("n_pieces > 1")
        .select("conv_id", "piece", "n_pieces", *sums, "audit", lines.alias("lines"), F.size("turns").alias("n_lines"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "piece")
    )
    return one.unionByName(more.mapInArrow(run, one.schema))
