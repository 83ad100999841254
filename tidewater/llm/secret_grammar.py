"""Secret scans with an inferred grammar (operator 1).

The base rules (an assignment with a telling name, an access key id, a run of
hex digits) find the labelled credentials. Their values, as strings of
character classes, are counted whole in Spark: as one prefix tree per kind of
``DEPTH`` symbols, and as steps and ends after each symbol, the suffix states.
A prefix becomes a state of the tree, with all before it, if what follows it
differs from its suffix state by more than ``EFFECT`` beyond chance; a passage
that leaves the tree goes on in the suffix states. So a rare format counts as
soon as it is frequent enough to tell, and the states are those of the formats,
however large the corpus is. Merging states whose outgoing and final
frequencies don't differ by the Hoeffding bound turns a tree into a
probabilistic automaton. The same is done with all other long runs of
credential characters, as the background. An unseen step has a fixed share of
the probability, so a verdict doesn't depend on the number of credentials.

Every candidate, i.e. every such run outside the base spans, is then scored:
the log-likelihood of its format under the best kind against the background's.
Those above ``THRESHOLD`` nats become spans of kind ``like_<kind>``. Texts are
read once; candidates and base spans travel as a small table.

Spans are code point offsets, end exclusive. Null and empty texts have none;
every row, repeated or with a null id, gets its own result row.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import slices, stage, whole_text

# The patterns of the base rules and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20
KINDS = ("assign", "access", "hex")

#: Runs of at least this many credential characters are candidates.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
DEPTH, EFFECT = 20, 0.1
#: Share of a state's probability that is dealt evenly over all steps.
UNSEEN = 0.01
ALPHA = 0.05
THRESHOLD = 12.0
#: Distinct prefixes that a task holds before it hands them on.
FLUSH = 200_000

_CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ")
_CODES = "dhlHU"
_TO_CLASS = str.maketrans({c: code for chars, code in zip(_CLASSES, _CODES, strict=True)
                           for c in chars})
_SPREAD = {code: math.log(len(chars)) for chars, code in zip(_CLASSES, _CODES, strict=True)}
_SYMBOLS = [*_CODES, *"+/_.=-"]
#: Marks the counts of suffix states among the prefixes.
_AFTER = "\0"
_SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) by the rules, in order of start and kind."""
    spans = [("assign", m.start(), m.end(), m.group(2)) for m in ASSIGN.finditer(text)
             if len(m.group(2)) >= ASSIGN_VALUE]
    spans += [("access", m.start(), m.end(), m.group()) for m in ACCESS.finditer(text)
              if m.end() - m.start() >= ACCESS_LENGTH]
    spans += [("hex", m.start(), m.end(), m.group()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, base: list[tuple[str, int, int, str]]) -> list[tuple]:
    """Runs of credential characters that touch no base span."""
    covered: list[list[int]] = []           # the base spans as disjoint intervals
    for _, start, end, _ in base:
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(end, covered[-1][1])
        else:
            covered.append([start, end])
    found, at = [], 0
    for m in CANDIDATE.finditer(text):
        while at < len(covered) and covered[at][1] <= m.start():
            at += 1
        if at == len(covered) or covered[at][0] >= m.end():
            found.append(("other", m.start(), m.end(), m.group()))
    return found


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                               ("end", pa.int32()), ("value", pa.string())]))
    names = ("kind", "start", "end", "value")
    for whole in batches:
        for batch in slices(whole):
            base, free = [], []
            for text in batch.column(1).to_pylist():
                spans = base_spans(text)
                base.append([dict(zip(names, s, strict=True)) for s in spans])
                free.append([dict(zip(names, s, strict=True)) for s in candidates(text, spans)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, kind), pa.array(free, kind)],
                names=["doc_id", "base", "free"])


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    ends: Counter = Counter()

    def emit() -> pa.RecordBatch:
        keys = list(seen)
        out = pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([seen[k] for k in keys], pa.int64()),
             pa.array([ends.get(k, 0) for k in keys], pa.int64())],
            names=["kind", "prefix", "n", "ended"])
        seen.clear()
        ends.clear()
        return out

    for batch in batches:
        for kind, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                               strict=True):
            form = value.translate(_TO_CLASS)
            seen.update([(kind, form[:k]) for k in range(min(len(form), DEPTH) + 1)])
            if len(form) <= DEPTH:
                ends[kind, form] += 1
            for c, n in Counter(form).items():
                seen[kind, _AFTER + c] += n
            for (c, d), n in Counter(zip(form, form[1:], strict=False)).items():
                seen[kind, _AFTER + c + d] += n
            if form:
                ends[kind, _AFTER + form[-1]] += 1
            if len(seen) >= FLUSH:
                yield emit()
    yield emit()


class _Shares:
    """Of each state of an automaton, one row each, the shares of the end and of each
    symbol, how far others may be from them, and the states that the symbols lead to."""

    def __init__(self, automaton: Automaton):
        self.of = automaton
        symbols = sorted({s for edges in automaton.out for s in edges})
        self.column = {s: i for i, s in enumerate(symbols)}
        self.share = np.zeros((len(automaton.n), len(symbols) + 1))
        self.bound = np.full(len(automaton.n), math.inf)    # nothing differs from an empty state
        self.next = np.full((len(automaton.n), len(symbols)), -1)
        for q in range(len(automaton.n)):
            self.put(q)

    def put(self, q: int) -> None:
        of, leaving = self.of, self.of._leaving(q)
        if leaving:
            self.share[q, -1] = of.ended[q] / leaving
            self.bound[q] = of.reach * leaving ** -0.5
        for s, (count, to) in of.out[q].items():
            if leaving:
                self.share[q, self.column[s]] = count / leaving
            if to is not None:
                self.next[q, self.column[s]] = to

    def near(self, among: np.ndarray, state: int) -> np.ndarray:
        """Those of ``among`` that ``Automaton._compatible`` may find alike, every one of
        them: compared step by step together, the last digits left to it."""
        near = np.ones(len(among), bool)
        todo = [(np.arange(len(among)), among, state)]
        while todo:
            which, a, b = todo.pop()
            alive = near[which]
            which, a = which[alive], a[alive]
            apart = np.abs(self.share[a] - self.share[b]).max(axis=1)
            alike = apart <= (self.bound[a] + self.bound[b]) * (1 + 1e-9)
            near[which[~alike]] = False
            which, a = which[alike], a[alike]
            if len(which):
                for column in np.flatnonzero(self.next[b] >= 0):
                    to = self.next[a, column]
                    both = (to >= 0) & (to != self.next[b, column])
                    if both.any():
                        todo.append((which[both], to[both], int(self.next[b, column])))
        return among[near]


class Automaton:
    """A probabilistic automaton learned by state merging from the counts of
    prefixes (tree states, and the open edges that leave them) and of what
    follows each symbol (the suffix states)."""

    def __init__(self, counts: dict[str, tuple[int, int]], states: set[str],
                 after: dict[str, tuple[int, int]], alpha: float = ALPHA):
        self.n: list[int] = []
        self.ended: list[int] = []
        self.out: list[dict[str, list]] = []      # symbol -> [count, state or None]
        ids: dict[str, int] = {}
        for prefix in sorted(counts, key=lambda p: (len(p), p)):
            n, ended = counts[prefix]
            if prefix in states:
                ids[prefix] = self._new_state(n, ended)
            if prefix:
                self.out[ids[prefix[:-1]]][prefix[-1]] = [n, ids.get(prefix)]
        self.suffix = {c: self._new_state(*after[c]) for c in after if len(c) == 1}
        for c, (n, _) in after.items():
            if len(c) == 2:
                self.out[self.suffix[c[0]]][c[1]] = [n, None]
        self.reach = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_states()
        self._settle()

    def _new_state(self, n: int, ended: int) -> int:
        self.n.append(n)
        self.ended.append(ended)
        self.out.append({})
        return len(self.n) - 1

    def _differ(self, k1: int, n1: int, k2: int, n2: int) -> bool:
        if not n1 or not n2:
            return False
        return abs(k1 / n1 - k2 / n2) > self.reach * (n1 ** -0.5 + n2 ** -0.5)

    def _leaving(self, q: int) -> int:
        return self.ended[q] + sum(c for c, _ in self.out[q].values())

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            na, nb = self._leaving(a), self._leaving(b)
            if self._differ(self.ended[a], na, self.ended[b], nb):
                return False
            for s in {*self.out[a], *self.out[b]}:
                ca, ta = self.out[a].get(s, (0, None))
                cb, tb = self.out[b].get(s, (0, None))
                if self._differ(ca, na, cb, nb):
                    return False
                if ta is not None and tb is not None and ta != tb:
                    todo.append((ta, tb))
        return True

    def _fold(self, a: int, b: int) -> tuple[set[int], list[tuple[int, int, str]]]:
        """Add ``b`` and what follows it to ``a``: the states that count more now, and
        the edges (to, from, symbol) that they have now and hadn't before."""
        grown, moved = set(), []
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            grown.add(a)
            self.n[a] += self.n[b]
            self.ended[a] += self.ended[b]
            for s, (count, to) in self.out[b].items():
                mine = self.out[a].setdefault(s, [0, None])
                mine[0] += count
                if mine[1] is None:
                    mine[1] = to
                    if to is not None:
                        moved.append((to, a, s))
                elif to is not None and mine[1] != to:
                    todo.append((mine[1], to))
        return grown, moved

    def _merge_states(self) -> None:
        """Blue states, the children of red ones, in the order of their numbers: each
        is merged into the first red state that it's compatible with, else it is red
        itself. Red states are compared with it many at a time (``_Shares``)."""
        if not self.n:
            return
        shares = _Shares(self)
        red, is_red = np.zeros(len(self.n), int), np.zeros(len(self.n), bool)
        size = 0
        blue: list[tuple[int, int, str]] = []       # a blue state has one edge that leads to it

        def redden(q: int) -> None:
            nonlocal size
            red[size], is_red[q], size = q, True, size + 1
            for s, (_, t) in self.out[q].items():
                if t is not None:
                    heapq.heappush(blue, (t, q, s))

        def first_compatible(q: int) -> int | None:
            at, most = 0, 64
            while at < size:
                for r in shares.near(red[at:min(at + most, size)], q).tolist():
                    if self._compatible(r, q):
                        return r
                at, most = at + most, 4 * most
            return None

        redden(0)
        while blue:
            state, parent, symbol = heapq.heappop(blue)
            found = first_compatible(state)
            if found is None:
                redden(state)
                continue
            self.out[parent][symbol][1] = found
            grown, moved = self._fold(found, state)
            for q in {parent, *grown}:
                shares.put(q)
            for edge in moved:
                if is_red[edge[1]]:
                    heapq.heappush(blue, edge)
        self.states = red[:size].tolist()

    def _settle(self) -> None:
        """Log probabilities, ``UNSEEN`` of them dealt evenly; an open edge and
        an unseen step lead to the symbol's suffix state."""
        self.step: dict[int, dict[str, tuple[float, int]]] = {}
        self.stop: dict[int, float] = {}
        even = UNSEEN / (len(_SYMBOLS) + 1)
        self.rest = math.log(even)
        for q in [*self.states, *self.suffix.values()] if self.n else []:
            share = (1 - UNSEEN) / max(self._leaving(q), 1)
            self.stop[q] = math.log(share * self.ended[q] + even)
            self.step[q] = {s: (math.log(share * c + even), self.suffix[s] if t is None else t)
                            for s, (c, t) in self.out[q].items()}

    def log_likelihood(self, value: str) -> float:
        """Log probability of a string; within a class characters are alike."""
        if not self.n:
            return -math.inf
        q, total = 0, 0.0
        for s in value.translate(_TO_CLASS):
            p, q = self.step[q].get(s) or (self.rest, self.suffix.get(s, q))
            total += p - _SPREAD.get(s, 0.0)
        return total + self.stop[q]


def learn_automata(values: DataFrame) -> dict[str, Automaton]:
    """Automata by kind from ``values`` (kind, value). What comes to the driver
    is the tree states, with their next steps, and the suffix states."""
    counts = stage(values.mapInArrow(_prefixes, "kind string, prefix string, n long, ended long")
                   .groupBy("kind", "prefix")
                   .agg(F.sum("n").alias("n"), F.sum("ended").alias("ended")), "prefixes")
    spark = values.sparkSession
    after: dict[str, dict] = {}
    for r in counts.where(F.col("prefix").startswith(_AFTER)).collect():
        after.setdefault(r["kind"], {})[r["prefix"][1:]] = (r["n"], r["ended"])
    # at most one row per pair of symbols
    usual = [(kind, c[0], c[1:], (n if len(c) == 2 else ended) / seen[c[0]][0])
             for kind, seen in after.items() for c, (n, ended) in seen.items()]
    usual = F.broadcast(spark.createDataFrame(usual, "kind string, last string, symbol string, usual double"))
    tree = counts.where(~F.col("prefix").startswith(_AFTER)).withColumn("size", F.length("prefix"))
    upto = F.col("size") - 1
    steps = tree.where("size > 1").select(
        "kind", F.substring("prefix", F.lit(1), upto).alias("prefix"),
        F.substring("prefix", F.col("size"), F.lit(1)).alias("symbol"), "n")
    ends = tree.where(f"size > 0 AND size < {DEPTH}").select(
        "kind", "prefix", F.lit("").alias("symbol"), F.col("ended").alias("n"))
    followed = steps.union(ends).withColumn("last", F.substring("prefix", -1, 1))
    total = F.sum("n").over(Window.partitionBy("kind", "prefix"))
    followed = (followed.withColumn("total", total).join(usual, ["kind", "last", "symbol"])
                .withColumn("over", F.greatest(F.col("n") / F.col("total") - F.col("usual"), F.lit(0.0)))
                .groupBy("kind", "prefix").agg(F.first("total").alias("n"), F.sum("over").alias("far")))
    # variation distance from the suffix state against its mean and spread by
    # chance, the level shared by all prefixes
    level = math.log(max(tree.count(), 1) / ALPHA) / 2
    chance = (math.sqrt((len(_SYMBOLS) + 1) / 4) + math.sqrt(level)) / F.sqrt("n")
    states: dict[str, set[str]] = {kind: {""} for kind in after}
    for r in followed.where(F.col("far") > EFFECT + chance).select("kind", "prefix").collect():
        states[r["kind"]].update(r["prefix"][:k] for k in range(1, len(r["prefix"]) + 1))
    known = F.broadcast(spark.createDataFrame(
        [(kind, p) for kind, ps in states.items() for p in ps], "kind string, parent string"))
    nodes = tree.withColumn("parent", F.substring("prefix", F.lit(1), F.greatest(upto, F.lit(0))))
    trees: dict[str, dict] = {}
    for r in nodes.join(known, ["kind", "parent"]).collect():
        trees.setdefault(r["kind"], {})[r["prefix"]] = (r["n"], r["ended"])
    return {kind: Automaton(tree, states[kind], after[kind]) for kind, tree in trees.items()}


def _scorer(automata: dict[str, Automaton], threshold: float):
    background = automata.get("other")
    kinds = [(k, automata[k]) for k in KINDS if k in automata]

    def verdict(value: str) -> str | None:
        best = max(((a.log_likelihood(value), k) for k, a in kinds), default=None)
        if best is None:
            return None
        other = background.log_likelihood(value) if background else -math.inf
        return f"like_{best[1]}" if best[0] - other >= threshold else None

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, str | None] = {}
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for base, free in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                                  strict=True):
                count = Counter(s["kind"] for s in base)
                marks = [(s["start"], KINDS.index(s["kind"]), s["kind"], s["end"]) for s in base]
                joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in marks)
                for s in free:
                    if s["value"] not in memo:
                        if len(memo) > FLUSH:
                            memo.clear()
                        memo[s["value"]] = verdict(s["value"])
                    if kind := memo[s["value"]]:
                        marks.append((s["start"], len(KINDS), kind, s["end"]))
                for c, k in zip(cols, KINDS, strict=False):
                    c.append(count[k])
                cols[3].append(hashlib.sha256(joined.encode()).hexdigest())
                cols[4].append(",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(marks)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]],
                 *[pa.array(c, pa.string()) for c in cols[3:]]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return digest


def find_secrets(docs: DataFrame, labelled: DataFrame | None = None,
                 threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans), one row per row
    of ``docs`` (doc_id, text). ``labelled`` (kind, value) adds known
    credentials to those that the rules find."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    found = stage(rows.mapInArrow(_find, f"doc_id long, base {_SPANS}, free {_SPANS}"), "found")
    values = (found.select(F.explode(F.concat("base", "free")).alias("s"))
              .select("s.kind", "s.value"))
    if labelled is not None:
        values = values.union(labelled.select("kind", "value"))
    automata = learn_automata(values)
    return found.mapInArrow(
        _scorer(automata, threshold), "doc_id long, n_assign long, n_access long, n_hex long, "
                                      "base_sha256 string, spans string")
