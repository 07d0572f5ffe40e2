"""Secret scans with one combined automaton.

The heads of all rules are compiled into one deterministic automaton that marks, in a single pass over the
bytes, the places where the head of some rule ends. A head is the shortest beginning that tells a match from
other text. Only around marks, the rule's own automata find the leftmost start (walking back over the head)
and the longest end (walking on). Matches of a rule are leftmost and do not overlap; a match
that fails the rule's check is dropped, but still takes up its place.

Null and empty texts have no spans. Positions count code points, ends are exclusive. Spans of different
rules may overlap. Repeated rows get the same spans each.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import keyed, others, parts, per_batch, raw
from recflow.llm.automaton import Automaton, Scanner, compiled


@dataclass(frozen=True)
class Rule:
    """``head``: what every match begins with. ``least``: code points that ``group`` must have, 0 being the match."""

    kind: str
    head: bytes
    tail: bytes
    fold: bool = False
    group: int = 0
    least: int = 0

    @property
    def pattern(self) -> bytes:
        return self.head + self.tail


BASE = (
    Rule(
        "assign",
        rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
        rb"""\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        fold=True,
        group=2,
        least=8,
    ),
    Rule("access", rb"AKIA", rb"[A-Z0-9]+", least=16),
    # single letters are hex digits, so here the least length is part of the head
    Rule("hex", rb"[0-9a-f]{32}", rb"[0-9a-f]*"),
)
MORE = (
    Rule("bearer", rb"bearer\x20", rb"\x20*([A-Za-z0-9._~+/-]+)", fold=True, group=1, least=16),
    Rule("github", rb"gh[oprsu]_", rb"([A-Za-z0-9]+)", group=1, least=16),
    Rule("jwt", rb"eyJ", rb"[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    # The key too: to its END line, or else over the lines of base64, of which a short one needs a line break before it.
    Rule(
        "private",
        rb"-----BEGIN\x20",
        rb"""[A-Z\x20]*PRIVATE\x20KEY-----(?:(?:-{0,4}[^-])*-{5,}END\x20[A-Z\x20]*PRIVATE\x20KEY-----"""
        rb"""|(?:(?:\s|\\[nr])*(?:Proc-Type|DEK-Info):[^\n\\]*)*(?:(?:[\s"',>]|\\[nr])*[A-Za-z0-9+/=]{16,}"""
        rb"""|[\x20\t]*(?:\r?\n|(?:\\r)?\\n)[\x20\t]*[A-Za-z0-9+/=]+)*)""",
    ),
    Rule("slack", rb"xox[abprs]-", rb"([A-Za-z0-9-]+)", group=1, least=10),
    Rule("url", rb"[a-z]+://", rb"[^\s:@/]+:[^\s:@/]+@"),
)
RULES = BASE + MORE
PLACEHOLDER = "[SECRET]"
SPANS = "spans array<struct<kind:string,start:bigint,end:bigint>>"


class SecretScanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        patterns = [(r.pattern, r.fold) for r in rules]
        heads = [(r.head, r.fold) for r in rules]
        self.rules = rules
        self.scanner = Scanner(Automaton(heads, anywhere=True))
        self.forward = [Automaton([p], anywhere=False) for p in patterns]
        self.backward = [Automaton([h], anywhere=False, back=True) for h in heads]
        self.checks = [compiled(*p) for p in patterns]

    def _resolve(self, rule: int, marks: list[int], text: bytes) -> Iterator[tuple[int, int]]:
        done = i = 0
        while i < len(marks):
            start = self.backward[rule].longest(text, marks[i], -1, done)
            end = -1 if start < 0 else self.forward[rule].longest(text, start, 1, len(text))
            if end < 0:
                i += 1
                continue
            done = end
            i = bisect_right(marks, done)
            group, least = self.rules[rule].group, self.rules[rule].least
            if not least or len(self.checks[rule].fullmatch(text, start, done).group(group)) >= least:
                yield start, done

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """For each text (start, rule number, end) in bytes, sorted."""
        owner, end, bits = self.scanner.ends(texts)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for rule in range(len(self.rules)):
            own = np.flatnonzero(bits >> rule & 1)
            cuts = np.flatnonzero(np.diff(owner[own])) + 1
            for some in np.split(own, cuts) if len(own) else ():
                k = int(owner[some[0]])
                found[k] += [(s, rule, e) for s, e in self._resolve(rule, end[some].tolist(), texts[k])]
        return [sorted(x) for x in found]


def _code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    places = sorted({p for s, _, e in spans for p in (s, e)})
    at, count, number = 0, 0, {}
    for p in places:
        count += len(text[at:p].decode("utf-8", "replace"))
        number[p], at = count, p
    return [(number[s], number[e]) for s, _, e in spans]


def redacted(text: bytes, spans: list[tuple[int, int, int]]) -> bytes:
    """The text with every run of overlapping spans replaced by the placeholder."""
    out, done = [], 0
    for start, _, end in spans:
        if start >= done:
            out += [text[done:start], PLACEHOLDER.encode()]
        done = max(done, end)
    return b"".join([*out, text[done:]])


def find(docs: DataFrame, redact: bool = False) -> DataFrame:
    """The columns of ``docs`` and ``spans`` (kind, start, end) by start, then by the order of the rules.

    The text is left out, or comes with every secret replaced if ``redact`` is set; a null text stays null.
    """
    scanner = SecretScanner()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [r.kind for r in scanner.rules]
        for batch in parts(batches):
            given = raw(batch)
            texts = [t or b"" for t in given]
            found = scanner.spans(texts)
            rows = [
                [{"kind": kinds[r], "start": a, "end": b} for (_, r, _), (a, b) in zip(s, _code_points(t, s))]
                for s, t in zip(found, texts)
            ]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            columns = keyed(batch) | {"spans": pa.array(rows, kind)}
            if redact:
                new = [t if t is None or not s else redacted(t, s) for t, s in zip(given, found)]
                columns["text"] = pa.array(new, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return per_batch(docs.select(*others(docs, "text", "spans"), "text"), run, SPANS + ", text string" * redact)


def digest(spans: str) -> Column:
    """kind:start:end of all spans, comma-joined."""
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(parts, ",")
