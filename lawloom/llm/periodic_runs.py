"""Runs of periodically repeated words, and texts with every run cut to its first period.

A run is a longest stretch of words in which words one period apart are the same, with
four periods and six words at least. The suffix automaton of the words is built first.
Its suffix links are a tree, kept as a link-cut tree: the nodes between the root and a
word's own state are the strings that end at the word. Accessing that state recolours
this path with the word's position. Every path segment of one colour that the access
crosses is a string with the same previous end; if the two ends lie at most its length
apart, string and distance are a square, and the square reaches as far left as its period
does. Positions after it carry it to the right, until the run ends.

Only stretches whose five-word windows all occur twice in the stretch go through the
automaton. Every window inside a run of four periods occurs again one period before or
after, so the stretches hold all runs whole.

Scales: documents are independent, and nothing is shuffled. Time is n log n and memory
linear in the words of one stretch, which is one value of one row.

Odd input: null texts and texts without words have no run and an empty collapsed text.
Rows with equal or null ids are rows of their own. Columns beside `doc_id` and `text`
are not read. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawloom.llm.common import map_texts
from lawloom.llm.hashing import hash_windows, mix64

LEAST_WORDS = 6
LEAST_PERIODS = 4
_WINDOW = 5  # what two periods of a run share at least: 6 - 1 words, or 3 periods of 2 and more

RUNS = T.ArrayType(
    T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")]), False
)


class SuffixAutomaton:
    """States 1 (empty), 2, ...; `lengths` and `links` by state, and `ends`, the state of every prefix."""

    def __init__(self, words: list[int]):
        self.lengths, self.links = lengths, links = [0, 0], [0, 0]
        steps: list[dict[int, int]] = [{}, {}]
        self.ends: list[int] = []
        last = 1
        for word in words:
            new = len(lengths)
            lengths.append(lengths[last] + 1)
            links.append(1)
            steps.append({})
            p = last
            while p and word not in steps[p]:
                steps[p][word] = new
                p = links[p]
            if p:
                q = steps[p][word]
                if lengths[q] == lengths[p] + 1:
                    links[new] = q
                else:
                    clone = len(lengths)
                    lengths.append(lengths[p] + 1)
                    links.append(links[q])
                    steps.append(steps[q].copy())
                    links[q] = links[new] = clone
                    while p and steps[p].get(word) == q:
                        steps[p][word] = clone
                        p = links[p]
            last = new
            self.ends.append(new)


class LastEnds:
    """The link tree, coloured by where a state's strings last ended.

    Preferred paths are splay trees ordered by depth; a path's colour is at its root.
    """

    def __init__(self, links: list[int]):
        self.parent = links
        self.left, self.right = [0] * len(links), [0] * len(links)
        self.colour = [-1] * len(links)

    def access(self, state: int, position: int) -> Iterator[tuple[int, int]]:
        """(deepest state, previous end) of each segment up to the root; all of them get the new position."""
        parent, left, right, colour = self.parent, self.left, self.right, self.colour
        below, u = 0, state
        while u:
            # splay u to the root of its path
            p = parent[u]
            while p:
                if left[p] == u:
                    u_left = True
                elif right[p] == u:
                    u_left = False
                else:
                    break
                g = parent[p]
                if g and left[g] == p:
                    g_kind = 1
                elif g and right[g] == p:
                    g_kind = 2
                else:
                    g_kind = 0
                if g_kind == 0:
                    top, up = p, g
                    if u_left:
                        m = left[p] = right[u]
                        right[u] = p
                    else:
                        m = right[p] = left[u]
                        left[u] = p
                    if m:
                        parent[m] = p
                    parent[p] = u
                else:
                    top, up = g, parent[g]
                    if g_kind == 1:
                        if u_left:  # zig-zig
                            m = left[g] = right[p]
                            if m:
                                parent[m] = g
                            right[p] = g
                            parent[g] = p
                            m = left[p] = right[u]
                            if m:
                                parent[m] = p
                            right[u] = p
                            parent[p] = u
                        else:  # zig-zag
                            m = right[p] = left[u]
                            if m:
                                parent[m] = p
                            m = left[g] = right[u]
                            if m:
                                parent[m] = g
                            left[u], right[u] = p, g
                            parent[p] = parent[g] = u
                    elif u_left:
                        m = left[p] = right[u]
                        if m:
                            parent[m] = p
                        m = right[g] = left[u]
                        if m:
                            parent[m] = g
                        left[u], right[u] = g, p
                        parent[p] = parent[g] = u
                    else:
                        m = right[g] = left[p]
                        if m:
                            parent[m] = g
                        left[p] = g
                        parent[g] = p
                        m = right[p] = left[u]
                        if m:
                            parent[m] = p
                        left[u] = p
                        parent[p] = u
                parent[u] = up
                if up:
                    if left[up] == top:
                        left[up] = u
                    elif right[up] == top:
                        right[up] = u
                colour[u] = colour[top]
                p = up
            was = colour[u]
            if was >= 0:
                yield u, was
            if right[u]:
                colour[right[u]] = was
            right[u] = below
            below = u
            u = parent[u]
        colour[below] = position


def runs_of(words: list[int], least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of the words, by start, then period."""
    automaton = SuffixAutomaton(words)
    lengths, tree = automaton.lengths, LastEnds(automaton.links)
    reach: dict[tuple[int, int], int] = {}
    for i, state in enumerate(automaton.ends):
        for node, end in tree.access(state, i):
            period, shared = i - end, lengths[node]
            if shared >= (least_periods - 1) * period and shared + period >= least_words:
                reach[i - shared - period + 1, period] = i
    return [(start, end - start + 1, period) for (start, period), end in sorted(reach.items())]


def stretches(words: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) of the stretches whose five-word windows all occur twice within the stretch.

    Windows are compared by hash; a collision only makes a stretch longer than needed.
    """
    n = len(words) - _WINDOW + 1
    if n < 2:
        return []
    windows = hash_windows(mix64(words.astype(np.uint64) + np.uint64(1)), _WINDOW)
    twice = np.arange(n)
    found = 0  # windows in the current set; it only shrinks
    while len(twice) and len(twice) != found:
        found = len(twice)
        stretch = np.cumsum(np.concatenate(([0], np.diff(twice) > 1))).astype(np.uint64)
        named = mix64(windows[twice] + stretch * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(named, kind="stable")
        same = named[order][1:] == named[order][:-1]
        often = np.zeros(found, dtype=bool)
        often[order[1:][same]] = often[order[:-1][same]] = True
        twice = twice[often]
    if not len(twice):
        return []
    breaks = np.flatnonzero(np.diff(twice) > 1)
    firsts = twice[np.concatenate(([0], breaks + 1))]
    lasts = twice[np.concatenate((breaks, [len(twice) - 1]))]
    return [(a, b + _WINDOW) for a, b in zip(firsts.tolist(), lasts.tolist()) if b + _WINDOW - a >= LEAST_WORDS]


def text_runs(text: bytes) -> tuple[list[tuple[int, int, int]], bytes]:
    """Runs of a text, and its words without those that a run repeats, joined by one space."""
    words = text.split()  # bytes: exactly the six white-space characters
    ids: dict[bytes, int] = {}
    if len(words) < LEAST_WORDS:
        return [], b" ".join(words)
    codes = [ids.setdefault(w, len(ids)) for w in words]
    runs = []
    if len(ids) + LEAST_WORDS - 2 < len(words):  # a run repeats at least five words
        for first, end in stretches(np.array(codes)):
            runs += [(first + start, length, period) for start, length, period in runs_of(codes[first:end])]
    if not runs:
        return [], b" ".join(words)
    runs.sort(key=lambda r: (r[0], r[2]))
    dropped = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    return runs, b" ".join([words[i] for i in np.flatnonzero(np.cumsum(dropped[:-1]) == 0).tolist()])


def find_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, collapsed) of every document: its runs, and its text without their repeats.

    A word is left out if some run contains it after that run's first period.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, collapsed = [], []
            for text in batch.column(1):
                runs, kept = text_runs(text.as_buffer().to_pybytes() if text.is_valid else b"")
                found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                collapsed.append(kept.decode())
            runs_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            columns = [batch.column(0), pa.array(found, type=runs_type), pa.array(collapsed, type=pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "runs", "collapsed"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    return map_texts(docs.select("doc_id", F.col("text").cast("string").alias("text")), scan, schema)
