"""A prefix tree over ordered token sets, searched for sets with a given Jaccard similarity."""

from __future__ import annotations

import numpy as np


class PrefixTree:
    """Sets of local token numbers, stored by their common beginnings.

    Sets are kept in sorted order, so a node is a range [first, end) of them together
    with the tokens that all of them have next. Each node knows the smallest set size
    and the longest remainder below it, which bound the overlap that can still come.
    Sets with the same label are already connected: no search looks for them again.
    """

    def __init__(self, sequences: list[np.ndarray], sizes: np.ndarray, labels: np.ndarray, percent: int):
        keys = [s.astype(">u4").tobytes() for s in sequences]
        self.order = sorted(range(len(keys)), key=keys.__getitem__)
        self.sequences = [sequences[i] for i in self.order]
        self.sizes = sizes[self.order]
        self.labels = labels[self.order]
        self.percent = percent
        self.nodes: list[tuple] = []
        self.root = self._build() if keys else None

    def _build(self) -> int:
        """Nodes as (first, end, leaves_end, edge, smallest_size, longest_rest, children)."""
        todo = [(0, len(self.sequences), 0, None)]
        lengths = np.array([len(s) for s in self.sequences])
        while todo:
            first, end, depth, parent = todo.pop()
            low, high = self.sequences[first], self.sequences[end - 1]
            shared = min(len(low), len(high))
            differs = np.flatnonzero(low[depth:shared] != high[depth:shared])
            deep = depth + int(differs[0]) if len(differs) else shared
            leaves = first
            while leaves < end and len(self.sequences[leaves]) == deep:
                leaves += 1
            node = len(self.nodes)
            edge = low[depth:deep]
            rest = int(lengths[first:end].max()) - deep
            self.nodes.append((first, end, leaves, edge, int(self.sizes[first:end].min()), rest, []))
            if parent is not None:
                self.nodes[parent][6].append(node)
            start = leaves
            while start < end:
                token = self.sequences[start][deep]
                stop = start + 1
                while stop < end and self.sequences[stop][deep] == token:
                    stop += 1
                todo.append((start, stop, deep, node))
                start = stop
        return 0

    def search(self, tokens: np.ndarray, vocabulary: int, size: int, label: int, after: int = -1):
        """Positions of stored sets similar to this one, one at a time, with labels other than `label`.

        The caller may send back the label that the searching set has now. Only stored
        sets behind position `after` are looked at.
        """
        if self.root is None:
            return
        has = np.zeros(vocabulary, dtype=bool)
        has[tokens] = True
        not_after = np.cumsum(has)
        total = len(tokens)
        share, both = self.percent, 100 + self.percent
        todo = [(self.root, 0, -1)]
        while todo:
            at, overlap, last = todo.pop()
            first, end, leaves, edge, smallest, rest, children = self.nodes[at]
            if end <= after + 1 or (self.labels[max(first, after + 1) : end] == label).all():
                continue
            if len(edge):
                overlap += int(has[edge].sum())
                last = int(edge[-1])
            left = total - (int(not_after[last]) if last >= 0 else 0)
            if both * (overlap + min(left, rest)) < share * (size + smallest):
                continue
            for leaf in range(max(first, after + 1), leaves):
                if self.labels[leaf] != label and both * overlap >= share * (size + int(self.sizes[leaf])):
                    changed = yield leaf
                    label = label if changed is None else changed
            todo.extend((child, overlap, last) for child in children)


def _number_tokens(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens found in two sets or more, sorted, and their numbers, the commonest first.

    A token of one set is in no overlap. Starting with common tokens makes sets share paths.
    """
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    common = counts > 1
    values, counts = values[common], counts[common]
    number = np.empty(len(values), dtype=np.int64)
    number[np.lexsort((values, -counts))] = np.arange(len(values))
    return values, number


def _numbered(tokens: np.ndarray, values: np.ndarray, number: np.ndarray) -> np.ndarray:
    if not len(values):
        return np.empty(0, dtype=np.int64)
    at = np.searchsorted(values, tokens)
    at[at == len(values)] = 0
    return np.sort(number[at[values[at] == tokens]])


def links_among(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect exactly what all similar pairs of these sets connect."""
    if len(sets) < 2:
        return []
    values, number = _number_tokens(sets)
    sizes = np.array([len(s) for s in sets])
    tree = PrefixTree([_numbered(s, values, number) for s in sets], sizes, np.arange(len(sets)), percent)
    found = []
    for i, tokens in enumerate(tree.sequences):
        search = tree.search(tokens, len(values), int(tree.sizes[i]), int(tree.labels[i]), after=i)
        answer = None
        while True:
            try:
                other = search.send(answer)
            except StopIteration:
                break
            found.append((int(ids[tree.order[i]]), int(ids[tree.order[other]])))
            mine, theirs = int(tree.labels[i]), int(tree.labels[other])
            tree.labels[tree.labels == theirs] = mine
            answer = mine
    return found


def links_between(
    ids: np.ndarray, sets: list[np.ndarray], labels: np.ndarray,
    guest_ids: np.ndarray, guests: list[np.ndarray], guest_labels: np.ndarray, percent: int,
) -> list[tuple[int, int]]:
    """Links from guests to the stored sets; of stored sets with one label, one link is enough."""
    if not sets or not guests:
        return []
    values, number = _number_tokens([*sets, *guests])
    sizes = np.array([len(s) for s in sets])
    tree = PrefixTree([_numbered(s, values, number) for s in sets], sizes, labels, percent)
    found = []
    for guest, tokens, label in zip(guest_ids, guests, guest_labels, strict=True):
        reached = {int(label)}
        for other in tree.search(_numbered(tokens, values, number), len(values), len(tokens), int(label)):
            if int(tree.labels[other]) not in reached:
                reached.add(int(tree.labels[other]))
                found.append((int(guest), int(ids[tree.order[other]])))
    return found
