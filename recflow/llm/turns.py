"""Repair of conversations: the cheapest edits after which the roles follow ``(s?(ua)+)?``.

Rows are sorted over the cluster by conversation and turn and packed in parts of bounded size, so that a
conversation of any length is spread over tasks. A part gives, for every state it can begin in, the cheapest
edits to every state it can end in; the parts of a conversation are then joined in order, and every part
carries out its own edits.

Both steps keep one survivor per state in a tree of back pointers with reference counts. Once all survivors
share an ancestor, the edits up to it are emitted and forgotten. Survivors of equal cost are compared on
their whole unresolved edits, so ties always go to the least letters.

Rules: a null conv_id is a conversation of its own, a null turn stands first, a null role or text is one
space; rows of one turn are taken by role and text, so repeated rows stand together; a role or text may be
empty or very long (a part holds at least one row); other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import product

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import map_batches
from recflow.operators.joins import lookup
from recflow.session import materialize

# A part holds about so many rows and characters.
PART_ROWS = 512
PART_CHARS = 1 << 18

START, SYSTEM, USER, ASSISTANT = range(4)
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
LEGAL = ("su", "ua", "au")
NAMES = {USER: "user", ASSISTANT: "assistant"}
AFTER = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
# The only role that can be inserted or given in a state.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}

Move = tuple[int, int, int, str]
# Where a part begins among the edits of a conversation, and in which state; no edit for comparisons.
MARKS = {state: chr(state) for state in AFTER}
UNMARKED = dict.fromkeys(AFTER)


class Node:
    __slots__ = ("parent", "edits", "refs", "depth")

    def __init__(self, parent: Node | None, edits: str):
        self.parent, self.edits, self.refs = parent, edits, 0
        self.depth = parent.depth + 1 if parent else 0


class Survivors:
    """The cheapest edits that lead to each state, the ones that all states share already emitted."""

    def __init__(self, state: int):
        self.root = Node(None, "")
        self.root.refs = 1
        self.best = {state: (0, self.root)}

    def _less(self, a: Node, last_a: str, b: Node, last_b: str) -> bool:
        """Whether the edits of one path stand before those of the other, from their common ancestor on."""
        left, right = [last_a], [last_b]
        while a is not b:
            if a.depth >= b.depth:
                left.append(a.edits)
                a = a.parent
            else:
                right.append(b.edits)
                b = b.parent
        return "".join(reversed(left)).translate(UNMARKED) < "".join(reversed(right)).translate(UNMARKED)

    def step(self, moves: Iterable[Move]) -> None:
        """Follow the moves (from, to, cost, edits) out of the present states."""
        best: dict[int, tuple[int, Node, str]] = {}
        for a, b, cost, edits in moves:
            if a not in self.best:
                continue
            total, node = self.best[a]
            total += cost
            old = best.get(b)
            if old is None or total < old[0] or total == old[0] and self._less(node, edits, old[1], old[2]):
                best[b] = total, node, edits
        before, self.best = self.best, {}
        for state, (total, parent, edits) in _worthwhile(best).items():
            node = parent
            if edits:
                node = Node(parent, edits)
                parent.refs += 1
            node.refs += 1
            self.best[state] = total, node
        for _, node in before.values():
            self._release(node)

    def _release(self, node: Node) -> None:
        node.refs -= 1
        while node.refs == 0 and node.parent is not None:
            node = node.parent
            node.refs -= 1

    def resolved(self) -> str:
        """The edits up to the last ancestor of all survivors, which becomes the root."""
        if self.root.refs != 1 or any(node is self.root for _, node in self.best.values()):
            return ""
        path, node = [], next(iter(self.best.values()))[1]
        while node is not self.root:
            path.append(node)
            node = node.parent
        ends = {id(node) for _, node in self.best.values()}
        out = []
        while path and self.root.refs == 1 and id(self.root) not in ends:
            self.root = path.pop()
            out.append(self.root.edits)
        self.root.parent, self.root.edits = None, ""
        return "".join(out)

    def edits(self, state: int) -> str:
        """The unresolved edits that lead to a state."""
        node, path = self.best[state][1], []
        while node is not self.root:
            path.append(node.edits)
            node = node.parent
        return "".join(reversed(path))


def _worthwhile(best: dict[int, tuple]) -> dict[int, tuple]:
    """Without the states that cannot lead to the cheapest edits.

    What follows SYSTEM can follow ASSISTANT at the same cost. What follows START can follow ASSISTANT at
    three more, a system row that START would keep being deleted. USER is one insertion before ASSISTANT.
    """
    costs = [best[s][0] + extra for s, extra in ((ASSISTANT, 0), (USER, INSERT)) if s in best]
    if not costs:
        return best
    bound = min(costs)
    slack = {START: DELETE, SYSTEM: 0}
    return {s: x for s, x in best.items() if s not in slack or x[0] <= bound + slack[s]}


def _insertions() -> dict[int, dict[int, tuple[int, str]]]:
    """For each state, the states that none, one or two insertions lead to."""
    out = {}
    for state in AFTER:
        reached, now = {state: (0, "")}, state
        for count in (1, 2):
            now = NEXT[now]
            reached.setdefault(now, (INSERT * count, "I" * count))
        out[state] = reached
    return out


INSERTIONS = _insertions()
# The edits that end a conversation.
LAST: list[Move] = [
    (a, ASSISTANT, *INSERTIONS[a][ASSISTANT]) for a in (SYSTEM, USER, ASSISTANT)
] + [(START, START, 0, "")]


def _moves(initial: str, fault: int) -> list[Move]:
    """The cheapest insertions and one edit of a row, from each state to each."""
    found: dict[tuple[int, int], tuple[int, str]] = {}
    cut = CUT if fault == TRUNCATED else 0

    def offer(a: int, b: int, cost: int, edits: str) -> None:
        found[a, b] = min(found.get((a, b), (cost, edits)), (cost, edits))

    for a in AFTER:
        for b, (cost, inserted) in INSERTIONS[a].items():
            offer(a, b, cost + DELETE, inserted + "D")
            if fault in (BLANK, DUPLICATE):
                continue
            if initial in AFTER[b]:
                offer(a, AFTER[b][initial], cost + cut, inserted + "K")
            offer(a, NEXT[b], cost + cut + REROLE, inserted + "R")
    return [(a, b, cost, edits) for (a, b), (cost, edits) in found.items()]


MOVES = {(i, f): _moves(i, f) for i, f in product(("s", "u", "a", ""), range(4))}


def transfers(initials: list[str], faults: list[int], starts: Iterable[int]) -> list[Move]:
    """(from, to, cost, edits): the cheapest edits of these rows between the states."""
    out = []
    for start in starts:
        paths, done = Survivors(start), []
        for initial, fault in zip(initials, faults):
            paths.step(MOVES[initial if initial in ("s", "u", "a") else "", fault])
            done.append(paths.resolved())
        shared = "".join(done)
        out += [(start, s, cost, shared + paths.edits(s)) for s, (cost, _) in paths.best.items()]
    return out


def carry_out(
    roles: list[str], texts: list[str], edits: str, state: int
) -> list[tuple[str, str]]:
    """The repaired rows of a part that begins in a state."""
    out, row = [], 0
    for edit in edits:
        if edit == "I":
            state = NEXT[state]
            out.append((NAMES[state], ""))
            continue
        if edit == "K":
            state = AFTER[state][roles[row][:1]]
            out.append((roles[row], texts[row]))
        elif edit == "R":
            state = NEXT[state]
            out.append((NAMES[state], texts[row]))
        row += 1
    return out


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


# ---- rows


def _filled(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(" "))


def _conversation(column: str = "conv_id") -> Column:
    """A text that tells all conversations apart, the null one too."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


BLANK_TEXT = r"^[\x20\x09-\x0D]*\z"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"


def faults(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, fault) of every row.

    Whether the same role and text stood in an earlier turn comes from one aggregation and is joined back for
    the texts that occur again; of equal rows in one turn, ``_packed`` finds the first.
    """
    rows = turns.select("conv_id", "turn", _filled("role").alias("role"), _filled("text").alias("text"))
    said = [_conversation(), F.length("role").cast("string"), F.col("role"), F.col("text")]
    rows = rows.withColumn("said", F.md5(F.concat_ws(":", *said)))
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = rows.groupBy("said").agg(F.min(at).alias("first"), F.count("*").alias("n")).where(F.col("n") > 1)
    fault = (
        F.when(F.col("text").rlike(BLANK_TEXT), BLANK)
        .when(F.coalesce(at > F.col("first"), F.lit(False)), DUPLICATE)
        .when(~F.col("text").rlike(ENDED), TRUNCATED)
        .otherwise(FINE)
    )
    return lookup(rows, first.drop("n"), ["said"], "left").select("conv_id", "turn", "role", "text", fault.alias("fault"))


def _packed(limit_rows: int, limit_chars: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Parts out of sorted rows. ``opens`` tells that the conversation surely begins with the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        conv, last, size, opens, held = None, None, 0, False, ([], [], [])
        schema = None

        def record() -> pa.RecordBatch:
            roles, texts, found = held
            columns = [
                pa.array([conv], schema.field("conv_id").type),
                pa.array([part], pa.int64()),
                pa.array([opens], pa.bool_()),
                pa.array([roles], pa.list_(pa.string())),
                pa.array([texts], pa.list_(pa.string())),
                pa.array([found], pa.list_(pa.int8())),
            ]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "part", "opens", "roles", "texts", "faults"])

        for batch in batches:
            schema = schema or batch.schema
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault"))):
                other = last is None or row[0] != conv
                if held[0] and (other or len(held[0]) >= limit_rows or size >= limit_chars):
                    yield record()
                    part, size, opens, held = part + 1, 0, False, ([], [], [])
                if other:
                    opens = last is not None
                again = not other and row[1:4] == last[1:4]
                conv, last = row[0], row
                held[0].append(row[2])
                held[1].append(row[3])
                held[2].append(DUPLICATE if again and row[4] != BLANK else row[4])
                size += len(row[3])
        if held[0]:
            yield record()

    return run


def parts(turns: DataFrame, limit_rows: int = PART_ROWS, limit_chars: int = PART_CHARS) -> DataFrame:
    """(conv_id, part, opens, roles, texts, faults), written once; parts of a conversation ascend."""
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    rows = faults(turns).repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = (
        f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, part bigint, opens boolean, "
        "roles array<string>, texts array<string>, faults array<tinyint>"
    )
    return materialize(map_batches(rows, _packed(limit_rows, limit_chars), schema), "conversation-parts")


def _in_order(df: DataFrame) -> DataFrame:
    """Whole conversations in one partition each, their parts in order; read as a stream."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", "part")


MOVE = pa.struct([("a", pa.int8()), ("b", pa.int8()), ("cost", pa.int64()), ("edits", pa.string())])


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        moves, inside, ends = [], [], []
        for opens, roles, found in zip(*(batch.column(c).to_pylist() for c in ("opens", "roles", "faults"))):
            initials = [r[:1] for r in roles]
            found_moves = transfers(initials, found, (START,) if opens else AFTER)
            moves.append([dict(zip(("a", "b", "cost", "edits"), m)) for m in found_moves])
            inside.append([*(found.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)), illegal_pairs(initials)])
            ends.append([initials[0], initials[-1]])
        columns = {
            "conv_id": batch.column("conv_id"),
            "part": batch.column("part"),
            "moves": pa.array(moves, pa.list_(MOVE)),
            "counts": pa.array(inside, pa.list_(pa.int64())),
            "ends": pa.array(ends, pa.list_(pa.string())),
        }
        yield pa.RecordBatch.from_pydict(columns)


COUNTED = ("blank", "duplicate", "truncated", "illegal")
CHOSEN = ("conv_id", "part", "state", "edits", "cost", *COUNTED)


class _Conversation:
    """The parts of one conversation, joined in order."""

    def __init__(self, conv: object):
        self.conv, self.paths = conv, Survivors(START)
        self.pieces: list[list] = []  # resolved, [state, edits]
        self.numbers: list[int] = []  # of the parts not yet handed out
        self.counts, self.last = [0] * len(COUNTED), None

    def add(self, part: int, moves: list[dict], counts: list[int], ends: list[str]) -> list[tuple]:
        """Take a part; the rows of parts whose edits are now known."""
        if self.last is not None:
            self.counts[-1] += self.last + ends[0] not in LEGAL
        self.counts, self.last = [x + y for x, y in zip(self.counts, counts)], ends[1]
        self.numbers.append(part)
        self.paths.step((m["a"], m["b"], m["cost"], MARKS[m["a"]] + m["edits"]) for m in moves)
        self._cut(self.paths.resolved())
        known, self.pieces = self.pieces[:-1], self.pieces[-1:]  # insertions may follow the last one
        return self._rows(known)

    def _cut(self, edits: str) -> None:
        head, *marked = re.split("([\x00-\x03])", edits)
        if head:
            self.pieces[-1][1] += head
        self.pieces += [[ord(m), e] for m, e in zip(marked[::2], marked[1::2])]

    def _rows(self, pieces: list[list]) -> list[tuple]:
        named, self.numbers = self.numbers[: len(pieces)], self.numbers[len(pieces) :]
        nothing = [None] * (1 + len(COUNTED))
        return [(self.conv, n, state, edits, *nothing) for n, (state, edits) in zip(named, pieces)]

    def finish(self) -> list[tuple]:
        """The rows of the remaining parts; the last has the cost and the counts."""
        self.paths.step(LAST)
        end = min(self.paths.best, key=lambda s: (self.paths.best[s][0], self.paths.edits(s).translate(UNMARKED)))
        self._cut(self.paths.edits(end))
        *rows, final = self._rows(self.pieces)
        return [*rows, (*final[:4], self.paths.best[end][0], *self.counts)]


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every part the state it begins in and its edits, read in the order of the conversations."""
    types = [pa.int64(), pa.int8(), pa.string(), *[pa.int64()] * (1 + len(COUNTED))]
    kind, now = None, None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate([kind, *types])]
        return pa.RecordBatch.from_arrays(columns, CHOSEN)

    for batch in batches:
        kind, rows = batch.schema.field("conv_id").type, []
        for conv, *part in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "moves", "counts", "ends"))):
            if now is None or conv != now.conv:
                rows += now.finish() if now else []
                now = _Conversation(conv)
            rows += now.add(*part)
        yield out(rows)
    if now:
        yield out(now.finish())


TURN = pa.struct([("role", pa.string()), ("text", pa.string())])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("roles", "texts", "edits", "state")]
        turns = [[{"role": r, "text": t} for r, t in carry_out(*row)] for row in zip(*columns)]
        kept = {n: batch.column(n) for n in ("conv_id", "part", "edits", "cost", *COUNTED)}
        yield pa.RecordBatch.from_pydict(kept | {"turns": pa.array(turns, pa.list_(TURN))})


def repair(turns: DataFrame, limit_rows: int = PART_ROWS, limit_chars: int = PART_CHARS) -> DataFrame:
    """(conv_id, part, edits, cost, blank, duplicate, truncated, illegal, turns) of rows (conv_id, turn, role, text).

    ``turns`` are the repaired rows of a part, an array of (role, text); the parts of a conversation stand in
    the order of ``part``. ``edits`` has K for a kept, R for a changed, D for a deleted row and I for an
    inserted one. The cost and the counts of the whole conversation stand with its last part, else null.
    """
    conv = f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, part bigint"
    packed = parts(turns, limit_rows, limit_chars)
    move = "struct<a: tinyint, b: tinyint, cost: bigint, edits: string>"
    summaries = map_batches(packed, _summaries, f"{conv}, moves array<{move}>, counts array<bigint>, ends array<string>")
    sums = ", ".join(f"{c} bigint" for c in ("cost", *COUNTED))
    chosen = map_batches(_in_order(summaries), _choose, f"{conv}, state tinyint, edits string, {sums}")
    joined = lookup(packed.drop("opens", "faults"), chosen.drop("conv_id"), ["part"])
    said = "array<struct<role: string, text: string>>"
    return map_batches(joined, _repaired, f"{conv}, edits string, {sums}, turns {said}")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "cost", *COUNTED, "audit", "repaired_sha256"]
    kind, conv, found, sums, edits, written = None, None, None, None, [], False

    def out(rows: list[tuple]) -> pa.RecordBatch:
        types = [kind, *[pa.int64()] * (1 + len(COUNTED)), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    for batch in batches:
        kind, rows = batch.schema.field("conv_id").type, []
        for key, done, turns, *counts in zip(
            *(batch.column(c).to_pylist() for c in ("conv_id", "edits", "turns", "cost", *COUNTED))
        ):
            if found is None or key != conv:
                if found:
                    rows.append((conv, *sums, "".join(edits), found.hexdigest()))
                conv, found, edits, written = key, hashlib.sha256(), [], False
            lines = [f"{t['role']}:{t['text']}" for t in turns]
            if lines:
                found.update(("\n" * written + "\n".join(lines)).encode("utf-8", "surrogatepass"))
                written = True
            edits.append(done)
            sums = counts
        yield out(rows)
    if found:
        yield out([(conv, *sums, "".join(edits), found.hexdigest())])


def report(turns: DataFrame, repaired: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``: gaps, fault counts, cost, audit and digest.

    ``turns`` are the rows that were repaired. A conversation without rows has zeros and empty edits.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    sums = ", ".join(f"{c} bigint" for c in ("cost", *COUNTED))
    schema = f"conv_id {kind}, {sums}, audit string, repaired_sha256 string"
    found = map_batches(_in_order(repaired), _digests, schema)
    turn = F.col("turn")
    gaps = turns.groupBy("conv_id").agg(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn).alias("gaps"))
    gaps = gaps.toDF("conv_id", "gaps").select(_conversation().alias("key"), "gaps")
    all_ids = conversations.select("conv_id").distinct().withColumn("key", _conversation())
    found = found.withColumn("key", _conversation()).drop("conv_id")
    whole = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (
        all_ids.join(gaps, "key", "left")
        .join(found, "key", "left")
        .select(
            "conv_id",
            *[whole(c) for c in ("gaps", *COUNTED, "cost")],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
        )
    )


def damage(turns: DataFrame) -> DataFrame:
    """The rows with faults put in by rule, nulls of role and text as one space.

    crc32(``conv_id:turn``) mod 20 decides: 0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it,
    3 repeats the row, 4 gives it to the user.
    """
    where = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    code = F.crc32(F.concat_ws(":", *where).cast("binary")) % 20
    text = _filled("text")
    return (
        turns.select("conv_id", "turn", _filled("role").alias("role"), text.alias("text"), code.alias("code"))
        .where(F.col("code") != 0)
        .withColumn("text", F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
        .withColumn("role", F.when(F.col("code") == 4, "user").otherwise(F.col("role")))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("code") == 3, 2).otherwise(1))))
        .select("conv_id", "turn", "role", "text")
    )
