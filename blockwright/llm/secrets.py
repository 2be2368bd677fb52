"""Secret scan: all rules in one deterministic automaton, run over bytes many texts at a time.

Rule patterns become one NFA, subset construction and minimisation turn it into a transition array over classes of bytes.
Texts of a batch lie end to end, a byte that no text holds between them, and are dealt to lanes of equal length; one
gather moves all lanes one byte on. A lane starts in the start state; where its predecessor ended elsewhere, it is run
again from the true state until both runs agree. The bytes where a rule accepts are the ends of matches; small automata of the
rule, backward then forward, give the leftmost longest span around each.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from blockwright.llm.arrays import slices, text_bytes
from blockwright.llm.shared import with_text

SEPARATOR = 255
LANES = 2048
SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches leftmost longest (a length inside an open run belongs in ``least``, as counting it multiplies the states); a match stays if its last ``tail`` group, or the whole, has ``least`` characters."""

    kind: str
    pattern: str
    ignore_case: bool = False
    least: int = 1
    value: str = ""  # the bytes of the value at the end of the match; empty: the whole match is the value


# The rules of this repository, the first three as the scan's contract states them.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", True, 6, "A-Za-z0-9+/_.=-"),
    Rule("access", r"AKIA[A-Z0-9]+", False, 20),
    Rule("hex", r"[0-9a-f]{24,}", False, 24),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]+", False, 40),
)
RULES = BASE + MORE


class _Nfa:
    def __init__(self):
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def add(self, tree, at: int, fold: bool) -> int:
        for op, arg in tree:
            at = self._one(op, arg, at, fold)
        return at

    def _one(self, op, arg, at: int, fold: bool) -> int:
        if op is sre.LITERAL or op is sre.IN:
            found = {arg} if op is sre.LITERAL else {c for kind, x in arg for c in (range(x[0], x[1] + 1) if kind is sre.RANGE else [x])}
            if fold:
                found |= {ord(x) for c in found for x in (chr(c).lower(), chr(c).upper())}
            to = self.state()
            self.moves[at].append((frozenset(found), to))
            return to
        if op is sre.SUBPATTERN:
            return self.add(arg[3], at, fold)
        if op is sre.BRANCH:
            to = self.state()
            for branch in arg[1]:
                self.free[self.add(branch, at, fold)].append(to)
            return to
        if op is sre.MAX_REPEAT:
            low, high, inner = arg
            for _ in range(low):
                at = self.add(inner, at, fold)
            if high is sre.MAXREPEAT:
                loop = self.state()
                self.free[at].append(loop)
                self.free[self.add(inner, loop, fold)].append(loop)
                return loop
            out = self.state()
            self.free[at].append(out)
            for _ in range(high - low):
                at = self.add(inner, at, fold)
                self.free[at].append(out)
            return out
        raise ValueError(f"not in a rule: {op}")

    def closed(self, states) -> frozenset[int]:
        out, todo = set(states), list(states)
        while todo:
            for x in self.free[todo.pop()]:
                if x not in out:
                    out.add(x)
                    todo.append(x)
        return frozenset(out)

    def reversed(self, start: int, end: int) -> tuple[_Nfa, int, int]:
        back = _Nfa()
        for _ in self.moves:
            back.state()
        for a, row in enumerate(self.moves):
            for found, b in row:
                back.moves[b].append((found, a))
        for a, row in enumerate(self.free):
            for b in row:
                back.free[b].append(a)
        return back, end, start


class Automaton:
    """Minimal deterministic automaton: ``table[state, class]``, ``accepts[state]`` as bits of rules, start state 0."""

    def __init__(self, nfa: _Nfa, start: list[int], ends: dict[int, int], search: bool):
        groups = {f for row in nfa.moves for f, _ in row}
        keys = [tuple(b in f for f in groups) for b in range(256)]
        names = {k: i for i, k in enumerate(dict.fromkeys(keys))}
        self.classes = np.array([names[k] for k in keys], np.uint8)
        sample = [keys.index(k) for k in names]
        first = nfa.closed(start)
        states, rows, todo = {first: 0}, [], [first]
        for here in todo:
            row = []
            for b in sample:
                to = {x for s in here for f, x in nfa.moves[s] if b in f}
                to = nfa.closed(to | set(start) if search else to)
                if to not in states:
                    states[to] = len(states)
                    todo.append(to)
                row.append(states[to])
            rows.append(row)
        bits = [sum(1 << r for s, r in ends.items() if s in q) for q in states]
        self._minimise(np.array(rows), np.array(bits))
        self.dead = next((s for s in range(len(self.table)) if not self.accepts[s] and (self.table[s] == s).all()), -1)

    def _minimise(self, rows: np.ndarray, bits: np.ndarray) -> None:
        """Moore's refinement; block 0 holds the start state."""
        block = np.unique(bits, return_inverse=True)[1]
        while True:
            new = np.unique(np.column_stack([block, block[rows]]), axis=0, return_inverse=True)[1].ravel()
            if new.max() == block.max():
                break
            block = new
        first = np.zeros(block.max() + 1, int)
        first[block[::-1]] = np.arange(len(block))[::-1]
        order = np.concatenate([[block[0]], [b for b in range(len(first)) if b != block[0]]])
        name = np.argsort(order)
        self.table = name[block[rows[first[order]]]].astype(np.uint16)
        self.accepts = bits[first[order]]

    def longest(self, data: np.ndarray, at: int, step: int, stop: int) -> int:
        """From ``at`` on, going by ``step`` to before ``stop``: the last place after which the automaton accepts; ``at`` if none."""
        state, last = 0, at
        while at != stop:
            state = self.table[state, self.classes[data[at]]]
            if state == self.dead:
                break
            at += step
            if self.accepts[state]:
                last = at
        return last


class Scanner:
    """The combined search automaton of all rules, and each rule's own for the exact span."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        nfa, starts, ends, self.forward, self.backward = _Nfa(), [], {}, [], []
        for r, rule in enumerate(rules):
            tree = sre_parser.parse(rule.pattern)
            starts.append(nfa.state())
            ends[nfa.add(tree, starts[-1], rule.ignore_case)] = r
            own = _Nfa()
            begin = own.state()
            end = own.add(tree, begin, rule.ignore_case)
            self.forward.append(Automaton(own, [begin], {end: 0}, False))
            back, b, e = own.reversed(begin, end)
            self.backward.append(Automaton(back, [b], {e: 0}, False))
        self.all = Automaton(nfa, starts, ends, True)
        self.value = [frozenset(b for b in range(256) if chr(b) in _expand(r.value)) if r.value else None for r in rules]

    def states(self, data: np.ndarray, lanes: int = LANES) -> np.ndarray:
        """The state after each byte, from the start state."""
        lanes = max(1, min(lanes, len(data) // 256))
        length = -(-len(data) // lanes)
        classes = np.full(lanes * length, self.all.classes[SEPARATOR], np.uint8)
        classes[: len(data)] = self.all.classes[data]
        columns = np.ascontiguousarray(classes.reshape(lanes, length).T)
        width = self.all.table.shape[1]
        flat = (self.all.table.astype(np.int32) * width).ravel()
        out = np.empty((length, lanes), np.int32)
        now = np.zeros(lanes, np.int32)
        for i in range(length):
            now = flat[now + columns[i]]
            out[i] = now
        redo, whole = np.flatnonzero(out[-1, :-1]) + 1, {}
        while len(redo):
            ends, now, live, left = out[-1].copy(), out[-1, redo - 1], redo, redo[:0]
            for i in range(length):
                now = flat[now + columns[i, live]]
                differs = now != out[i, live]
                out[i, live] = now
                now, live = now[differs], live[differs]
                if not len(live):
                    break
            else:
                left = live[live < lanes - 1]
            again = []
            for lane in left.tolist():  # a match as long as a lane: the next lanes are run from that state all at once
                state = int(out[-1, lane])
                while lane < lanes - 1 and out[-1, lane] == state:
                    if state not in whole:
                        run, now = np.empty_like(out), np.full(lanes, state, np.int32)
                        for i in range(length):
                            now = flat[now + columns[i]]
                            run[i] = now
                        whole = {state: run}
                    lane += 1
                    before = out[-1, lane]
                    out[:, lane] = whole[state][:, lane]
                    if out[-1, lane] == before:
                        break
                else:
                    if lane < lanes - 1 and out[-1, lane] != ends[lane]:
                        again.append(lane + 1)
            redo = np.unique(np.array(again, int))
        return out.T.reshape(-1)[: len(data)] // width

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """For each text its spans (start, rule, end) in bytes, sorted."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(offsets) - 1)]
        for i, j in slices(offsets, SLICE_BYTES):
            at = offsets[i : j + 1] - offsets[i]
            raw = data[offsets[i] : offsets[j]]
            place = np.arange(len(raw)) + np.repeat(np.arange(j - i), np.diff(at))
            joined = np.full(len(raw) + j - i, SEPARATOR, np.uint8)
            joined[place] = raw
            begin = at[:-1] + np.arange(j - i)
            bits = self.all.accepts[self.states(joined)]
            hits = np.flatnonzero(bits)
            owner = np.searchsorted(begin, hits, "right") - 1
            for r in range(len(self.rules)):
                of = (bits[hits] >> r) & 1 == 1
                self._rule(r, joined, begin, hits[of], owner[of], out, i)
        return [sorted(x) for x in out]

    def _rule(self, r: int, data: np.ndarray, begin: np.ndarray, hits: np.ndarray, owner: np.ndarray, out: list, first: int) -> None:
        done = doc = -1
        for hit, own in zip(hits.tolist(), owner.tolist(), strict=True):
            low = int(begin[own])
            done = low if own != doc else done
            doc = own
            if hit < done:
                continue
            start = self.backward[r].longest(data, hit, -1, done - 1) + 1
            if start > hit:  # its beginning belongs to the match before
                continue
            end = self.forward[r].longest(data, start, 1, len(data))
            done = end
            if self._long_enough(r, data, start, end):
                out[first + own].append((start - low, r, end - low))

    def _long_enough(self, r: int, data: np.ndarray, start: int, end: int) -> bool:
        if self.value[r] is None:
            return end - start >= self.rules[r].least
        # the value begins after the first ':' or '=' with its blanks and quote
        text = bytes(data[start:end])
        k = min(x for x in (text.find(b":"), text.find(b"=")) if x >= 0) + 1
        while text[k : k + 1] == b" ":
            k += 1
        k += text[k : k + 1] in (b'"', b"'")
        return len(text) - k >= self.rules[r].least


def _expand(spec: str) -> str:
    out, k = "", 0
    while k < len(spec):
        if spec[k + 1 : k + 2] == "-" and k + 2 < len(spec):
            out += "".join(map(chr, range(ord(spec[k]), ord(spec[k + 2]) + 1)))
            k += 3
        else:
            out += spec[k]
            k += 1
    return out


@lru_cache(4)
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    """Compiled once a Python worker."""
    return Scanner(rules)


def _points(data: np.ndarray, low: int, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte spans as spans of code points."""
    if not spans:
        return []
    last = max(e for _, _, e in spans)
    count = np.concatenate([[0], np.cumsum((data[low : low + last] & 0xC0) != 0x80)])
    return [(int(count[s]), r, int(count[e])) for s, r, e in spans]


def _scan(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = scanner(rules)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            rows = [_points(data, int(offsets[k]), x) for k, x in enumerate(found.spans(data, offsets))]
            spans = [[{"kind": rules[r].kind, "start": s, "end": e} for s, r, e in row] for row in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))], [*batch.schema.names, "secret_spans"])

    return run


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, text and secret_spans (kind, start, end: code points, end exclusive; by start, then rule), one row for each of ``docs``.

    Spans of one kind don't overlap, leftmost first and longest; those of different kinds may. Null and empty texts have
    none. No shuffle: each batch of texts is scanned where it lies.
    """
    return with_text(docs).mapInArrow(_scan(rules), "doc_id long, text string, secret_spans array<struct<kind:string,start:bigint,end:bigint>>")


def _redact(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = scanner(rules)
        for batch in batches:
            column = batch.schema.get_field_index("text")
            data, offsets = text_bytes(batch.column(column))
            texts = []
            for text, low, spans in zip(batch.column(column), offsets[:-1].tolist(), found.spans(data, offsets), strict=True):
                value, at, out = text.as_py(), 0, []
                if spans:
                    for s, r, e in _points(data, low, spans):
                        if s >= at:
                            out.append(value[at:s] + f"[{rules[r].kind}]")
                        at = max(at, e)
                    value = "".join(out) + value[at:]
                texts.append(value)
            yield batch.set_column(column, "text", pa.array(texts, pa.string()))

    return run


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by its kind in brackets; overlapping spans become one. Null texts stay null."""
    return docs.mapInArrow(_redact(rules), docs.schema)
