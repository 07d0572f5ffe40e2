import hashlib
import random
import re
import zlib

import pytest

from recflow.llm import queries, turns

SHAPE = re.compile("(s?(ua)+)?")
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SCHEMA = "conv_id long, turn long, role string, text string"


def slow_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(name.encode()) % 20
        if code == 0:
            continue
        if code == 1:
            text = ""
        if code == 2:
            text = re.sub("[.!?]", "", text)
        if code == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if code == 3 else 1)
    return out


def slow_faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        text = " " if text is None else text
        role = " " if role is None else role
        bare = text.strip(SPACE)
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def slow_repair(rows):
    """Dijkstra over (row, roles so far as a state) with whole edit strings: the least (cost, edits)."""
    import heapq

    faults = slow_faults(rows)
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, edits, at, state, made = heapq.heappop(heap)
        if at == len(rows) and state in ("", "a"):
            return cost, edits, list(made)
        if (at, state) in done:
            continue
        done.add((at, state))
        for new in "ua":
            if new in follow[state]:
                name = {"u": "user", "a": "assistant"}[new]
                heapq.heappush(heap, (cost + 2, edits + "I", at, new, (*made, (name, ""))))
        if at == len(rows):
            continue
        role, text, fault = rows[at][2], rows[at][3], faults[at]
        heapq.heappush(heap, (cost + 3, edits + "D", at + 1, state, made))
        if fault in ("blank", "duplicate"):
            continue
        more = int(fault == "truncated")
        if role[:1] and role[0] in follow[state]:
            heapq.heappush(heap, (cost + more, edits + "K", at + 1, role[0], (*made, (role, text))))
        for new in "ua":
            if new in follow[state]:
                name = {"u": "user", "a": "assistant"}[new]
                heapq.heappush(heap, (cost + 2 + more, edits + "R", at + 1, new, (*made, (name, text))))


def slow_report(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    cost, audit, made = slow_repair(rows)
    known = [r[1] for r in rows if r[1] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    faults = slow_faults(rows)
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
    assert SHAPE.fullmatch("".join(r[0] for r, _ in made))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def by_conversation(rows):
    out = {}
    for row in rows:
        out.setdefault(row[0], []).append(row)
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def as_dict(df):
    rows = df.collect()
    found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(found) == len(rows)
    return found


def test_query_equals_brute_force(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select(*SCHEMA.replace(" long", "").replace(" string", "").split(", ")).collect()]
    damaged = by_conversation(slow_damage(rows))
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    expected = {c: slow_report(damaged[c]) if c in damaged else empty for c in {r[0] for r in rows}}
    assert as_dict(queries.op13_conversation_repair(spark, data)) == expected


def random_rows(seed, conversations, length):
    pick = random.Random(seed)
    rows = []
    for conv in [None, *range(conversations)]:
        for _ in range(pick.randint(1, length)):
            turn = pick.choice([None, *range(length)])
            role = pick.choice(["user", "user", "assistant", "assistant", "system", "tool", "", "u", None])
            text = pick.choice([None, "", " \n", "Yes.", "No", "Yes. ", "ok!", "so?  ", "a.b", "é", "x.\n"] + [f"t{i}." for i in range(40)])
            rows.append((conv, turn, role, text))
    return rows


@pytest.mark.parametrize("limit", [1, 3, 512])
def test_odd_rows_and_parts_of_any_size(spark, limit):
    rows = random_rows(limit, 60, 14)
    filled = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = as_dict(turns.report(frame, turns.repair(frame, limit_rows=limit), frame))
    assert got == {c: slow_report(r) for c, r in by_conversation(filled).items()}


def test_long_conversation_and_long_text(spark):
    pick = random.Random(3)
    rows = [(7, i, pick.choice(["user", "assistant", "system"]), f"text {i % 700}" + pick.choice(["", ".", "?"])) for i in range(3000)]
    rows += [(8, 0, "user", "x" * 9_000_000 + "."), (8, 1, "assistant", "y" * 9_000_000)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    repaired = turns.repair(frame)
    assert repaired.where("conv_id = 7").count() > 3
    expected = {c: slow_report(r) for c, r in by_conversation(rows).items()}
    assert as_dict(turns.report(frame, repaired, frame)) == expected


def test_unresolved_edits_stay_few():
    paths = turns.Survivors(turns.START)
    pick, longest = random.Random(1), 0
    for _ in range(20_000):
        paths.step(turns.MOVES[pick.choice(["s", "u", "a", ""]), pick.choice([0, 0, 1, 3])])
        paths.resolved()
        longest = max(longest, *(node.depth - paths.root.depth for _, node in paths.best.values()))
    assert longest < 60


def test_empty_table_strings_as_ids_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert turns.report(empty, turns.repair(empty), empty).collect() == []
    rows = [("a", 1, "user", "Hi.", 5, "x"), ("a", 2, "assistant", "Yes.", 6, "y"), (None, 1, "system", "Be.", 7, "z")]
    frame = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string, part int, `edits` string")
    got = as_dict(turns.report(frame, turns.repair(frame), frame))
    assert got["a"][5:7] == (0, "KK") and got[None][5:7] == (3, "D")
    parts = turns.repair(frame).where("conv_id = 'a'").collect()
    assert [(t.role, t.text) for t in parts[0].turns] == [("user", "Hi."), ("assistant", "Yes.")]
