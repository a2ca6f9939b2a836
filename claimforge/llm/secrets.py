"""Secret scans by one combined automaton.

All rules are compiled together: each regular expression is reversed, its Thompson
automaton joined with the others', made deterministic by subset construction and
minimised into one transition array. A single pass over a text's bytes, right to
left, then tells for every place which rules have a match that starts there. At
those rare places the rule's own forward automaton finds the longest match.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimforge.llm import arrow

Transitions = list[dict[int, int]]


@dataclass(frozen=True)
class Rule:
    """``pattern`` may use literals, classes, groups, ``|`` and repeats over ASCII.

    Matches are leftmost and longest, without overlap. One counts if it has
    ``least`` characters or, with ``value``, if what follows the first ``value``
    match inside it has. A match that fails is dropped yet still uses up its place.
    """

    kind: str
    pattern: str
    least: int = 0
    value: str | None = None

    def counts(self, text: str) -> bool:
        if self.value is None:
            return len(text) >= self.least
        found = re.match(self.value, text)
        return found is not None and len(text) - found.end() >= self.least


_KEY = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
BASE_RULES = (
    Rule("assign", _KEY + r"[A-Za-z0-9+/_.=-]+", 8, _KEY),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    # Runs are maximal, so a run of 32 or more is what is left of [0-9a-f]+ after the length test.
    Rule("hex", r"[0-9a-f]{32,}", 32),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
)


class _Nfa:
    """Thompson automaton over byte sets."""

    def __init__(self) -> None:
        self.steps: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def build(self, tree, start: int, any_case: bool, reverse: bool) -> int:
        """Add the parsed pattern after ``start``; returns its last state."""
        at = start
        for op, arg in reversed(list(tree)) if reverse else tree:
            at = self._item(op, arg, at, any_case, reverse)
        return at

    def _item(self, op, arg, at: int, any_case: bool, reverse: bool) -> int:
        if op in (sre.LITERAL, sre.IN):
            end = self.state()
            self.steps[at].append((_bytes(op, arg, any_case), end))
            return end
        if op is sre.SUBPATTERN:
            _, add, _, tree = arg
            return self.build(tree, at, any_case or bool(add & re.IGNORECASE), reverse)
        if op is sre.BRANCH:
            end = self.state()
            for tree in arg[1]:
                begin = self.state()
                self.free[at].append(begin)
                self.free[self.build(tree, begin, any_case, reverse)].append(end)
            return end
        if op is sre.MAX_REPEAT:
            low, high, tree = arg
            for _ in range(low):
                at = self.build(tree, at, any_case, reverse)
            if high is sre.MAXREPEAT:
                loop, end = self.state(), self.state()
                self.free[at].append(loop)
                self.free[self.build(tree, loop, any_case, reverse)].append(loop)
                self.free[loop].append(end)
                return end
            end = self.state()
            self.free[at].append(end)
            for _ in range(high - low):
                at = self.build(tree, at, any_case, reverse)
                self.free[at].append(end)
            return end
        raise ValueError(f"a rule can't use {op}")

    def closure(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


def _bytes(op, arg, any_case: bool) -> frozenset[int]:
    if op is sre.LITERAL:
        out = {arg}
    else:
        out = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                out.add(value)
            elif kind is sre.RANGE:
                out.update(range(value[0], value[1] + 1))
            else:
                raise ValueError(f"a class can't use {kind}")
    if any(b > 127 for b in out):
        raise ValueError("rules are over ASCII")
    return frozenset(x for b in out for x in ((ord(chr(b).lower()), ord(chr(b).upper())) if any_case else (b,)))


def compile_rules(rules: tuple[Rule, ...], reverse: bool, everywhere: bool) -> tuple[list[list[int]], list[int]]:
    """Minimal deterministic automaton: rows of 256 next states, and each state's set of matched rules as bits.

    State 0 is the start. ``everywhere`` lets a match begin at any place.
    """
    nfa = _Nfa()
    begin = nfa.state()
    if everywhere:
        nfa.steps[begin].append((frozenset(range(256)), begin))
    ends = {}
    for k, rule in enumerate(rules):
        first = nfa.state()
        nfa.free[begin].append(first)
        ends[nfa.build(sre_parser.parse(rule.pattern), first, False, reverse)] = k
    # Bytes that no rule tells apart share a column.
    sets = sorted({s for steps in nfa.steps for s, _ in steps}, key=sorted)
    column: dict[tuple[bool, ...], int] = {}
    of_byte = [column.setdefault(tuple(b in s for s in sets), len(column)) for b in range(256)]
    some = [of_byte.index(c) for c in range(len(column))]

    names = {nfa.closure({begin}): 0}
    order, table = list(names), []
    for states in order:  # grows meanwhile
        row = []
        for b in some:
            to = nfa.closure({t for s in states for on, t in nfa.steps[s] if b in on})
            if to not in names:
                names[to] = len(order)
                order.append(to)
            row.append(names[to])
        table.append(row)
    marks = [sum(1 << k for end, k in ends.items() if end in states) for states in order]

    part = [sorted(set(marks)).index(m) for m in marks]
    while True:  # split classes until all states of one go to equal classes
        seen: dict[tuple, int] = {}
        new = [seen.setdefault((part[s], *(part[t] for t in table[s])), len(seen)) for s in range(len(table))]
        if len(seen) == len(set(part)):
            break
        part = new
    part = new
    rows: list[list[int]] = [[] for _ in range(len(set(part)))]
    bits = [0] * len(rows)
    for s, p in enumerate(part):  # the start is seen first and so is class 0
        rows[p], bits[p] = [part[table[s][of_byte[b]]] for b in range(256)], marks[s]
    return rows, bits


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        rows, bits = compile_rules(rules, reverse=True, everywhere=True)
        # States without a match come first; states are multiplied by 256.
        order = sorted(range(len(rows)), key=lambda s: bits[s] > 0)
        name = {s: 256 * k for k, s in enumerate(order)}
        self.table = [name[t] for s in order for t in rows[s]]
        self.start, self.first_match = name[0], 256 * sum(not b for b in bits)
        self.matched = {name[s]: [k for k in range(len(rules)) if bits[s] >> k & 1] for s in order if bits[s]}
        self.forward = [compile_rules((r,), reverse=False, everywhere=False) for r in rules]

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """``(start, rule, end)`` of all matches that count, sorted; places are bytes."""
        table, state, match = self.table, self.start, self.first_match
        begins: dict[int, list[int]] = {}
        left = reversed(data)
        for b in left:
            state = table[state + b]
            if state >= match:
                for k in self.matched[state]:
                    begins.setdefault(k, []).append(left.__length_hint__())
        out = []
        for k, places in begins.items():
            used, (rows, bits) = 0, self.forward[k]
            for begin in reversed(places):
                if begin >= used:
                    state, used = 0, begin
                    for at in range(begin, len(data)):
                        state = rows[state][data[at]]
                        if bits[state]:
                            used = at + 1
                        elif all(t == state for t in rows[state]):
                            break
                    if self.rules[k].counts(data[begin:used].decode()):
                        out.append((begin, k, used))
        return sorted(out)


@functools.lru_cache(maxsize=4)
def _scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def _places(data: bytes) -> np.ndarray:
    """For each place between bytes the code points before it."""
    return np.append(0, np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = BASE_RULES,
    more: tuple[Rule, ...] = MORE_RULES,
) -> DataFrame:
    """Per row ``n_<kind>`` of each base rule, ``base_sha256`` and ``spans`` (``kind:start:end``, comma-joined).

    Places count code points, ends are exclusive. Spans are sorted by start, then
    by the rules' order. Null and empty texts have no spans; null ids and repeated
    rows are kept, and columns other than id and text are ignored.
    """
    every, kinds = (*rules, *more), [r.kind for r in (*rules, *more)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = _scanner(every).spans
        for batch in batches:
            out: list[list] = [[] for _ in range(len(rules) + 2)]
            for text in batch.column(1).to_pylist():
                data = text.encode()
                found = spans(data)
                place = _places(data) if found and len(data) != len(text) else range(len(data) + 1)
                named = [(k, f"{kinds[k]}:{place[a]}:{place[b]}") for a, k, b in found]
                for k in range(len(rules)):
                    out[k].append(sum(x == k for x, _ in named))
                base = ",".join(s for k, s in named if k < len(rules))
                out[-2].append(hashlib.sha256(base.encode()).hexdigest())
                out[-1].append(",".join(s for _, s in named))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in out[:-2]), *(pa.array(c, pa.string()) for c in out[-2:])],
                [id_col, *(f"n_{k}" for k in kinds[: len(rules)]), "base_sha256", "spans"],
            )

    schema = f"`{id_col}` long, " + "".join(f"n_{r.kind} long, " for r in rules) + "base_sha256 string, spans string"
    return arrow.in_small_batches(docs).select(F.col(id_col).cast("long"), F.coalesce(text_col, F.lit(""))).mapInArrow(run, schema)


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    return scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
