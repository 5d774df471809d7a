"""Sorting of suffixes by the deep-shallow method.

Suffixes are sorted by multikey quicksort on eight bytes at a time down to a
shallow depth, all groups of equal prefixes at once. Groups that are still
equal there share long prefixes; a blind trie orders each in which not all are
equal: it keeps only the places where its strings branch, so a string is placed
by a few characters and one comparison.
"""

from __future__ import annotations

import numpy as np

#: Depth, in bytes, at which groups go from quicksort to blind tries.
SHALLOW = 32
_STEP = 8


def _keys(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number that sorts as they do."""
    key = np.zeros(len(at), np.uint64)
    for i in range(_STEP):
        key = key << np.uint64(8) | text[at + i].astype(np.uint64)
    return key


def multikey_quicksort(text: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): the suffixes sorted by their first `depth` bytes, a multiple of
    eight, and whether each is the first of its group of equal prefixes.

    The first eight bytes, where all are one group, are sorted outright. Then in each
    round every group takes the key of its middle member as pivot and is
    split into less, equal and more; equal members go on eight bytes deeper.
    """
    n = len(starts)
    if n == 0:
        return np.arange(0), np.zeros(0, bool)
    keys = _keys(text, starts)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.append(True, keys[1:] != keys[:-1])
    level = np.full(n, _STEP)  # bytes of the group's common prefix
    begin = np.flatnonzero(first)
    sizes = np.diff(np.append(begin, n))
    active = np.flatnonzero(np.repeat(sizes > 1, sizes)) if depth > _STEP else np.arange(0)
    while len(active):
        begins = first[active]
        group = np.cumsum(begins) - 1
        begin = np.flatnonzero(begins)
        sizes = np.diff(np.append(begin, len(active)))
        members = order[active]
        keys = _keys(text, starts[members] + level[active])
        pivot = keys[begin + sizes // 2][group]
        side = np.where(keys < pivot, 0, np.where(keys == pivot, 1, 2))
        # Stable three-way split of every group by counting.
        place = np.empty(len(active), np.int64)
        base = begin[group]
        for value in range(3):
            here = side == value
            before = np.cumsum(here) - here
            place[here] = (base + before - before[begin][group])[here]
            totals = np.add.reduceat(here, begin)
            base = base + totals[group]
        order[active[place]] = members
        sorted_side = np.empty_like(side)
        sorted_side[place] = side
        begins = begins.copy()
        begins[1:] |= sorted_side[1:] != sorted_side[:-1]
        first[active] = begins
        level[active] += _STEP * (sorted_side == 1)
        # A group stays while it has two members and is not deep enough.
        begin = np.flatnonzero(begins)
        sizes = np.diff(np.append(begin, len(active)))
        active = active[np.repeat(sizes > 1, sizes) & (level[active] < depth)]
    return order, first


class BlindTrie:
    """Strings of one length, in order, with the members that share each.

    A node is [place of the branching byte, {byte: child}]; a leaf is (string, members).
    """

    def __init__(self) -> None:
        self.root = None

    def add(self, string: bytes, member: int) -> None:
        if self.root is None:
            self.root = (string, [member])
            return
        node = self.root
        while type(node) is list:  # blindly: only branching bytes are read
            node = node[1].get(string[node[0]]) or next(iter(node[1].values()))
        other = node[0]
        if other == string:
            node[1].append(member)
            return
        shared = next(i for i, (x, y) in enumerate(zip(string, other)) if x != y)
        leaf = (string, [member])
        node, parent = self.root, None
        while type(node) is list and node[0] < shared:
            node, parent = node[1][string[node[0]]], node
        if type(node) is list and node[0] == shared:
            node[1][string[shared]] = leaf
            return
        split = [shared, {other[shared]: node, string[shared]: leaf}]
        if parent is None:
            self.root = split
        else:
            parent[1][string[parent[0]]] = split

    def leaves(self):
        """Lists of members, in the order of their strings."""
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if type(node) is list:
                stack += [child for _, child in sorted(node[1].items(), reverse=True)]
            else:
                yield node[1]


def deep_shallow_sort(text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): the strings of `length` bytes at the starts, sorted, and whether
    each is the first of those equal to it. Equal ones keep their order."""
    shallow = min(SHALLOW, -(-length // _STEP) * _STEP)
    # Past the end, and past the length, keys read zeros that all strings of a start have alike.
    padded = np.concatenate([text, np.zeros(_STEP + shallow, np.uint8)])
    if length < shallow:
        size = shallow + _STEP
        padded = np.concatenate([padded[starts[:, None] + np.arange(length)], np.zeros((len(starts), size - length), np.uint8)], axis=1).ravel()
        return multikey_quicksort(padded, np.arange(len(starts)) * size, shallow)
    order, first = multikey_quicksort(padded, starts, shallow)
    if length == shallow:
        return order, first
    raw = text.tobytes()
    begin = np.flatnonzero(first)
    sizes = np.diff(np.append(begin, len(order)))
    tied = np.flatnonzero(np.repeat(sizes > 1, sizes))
    heads = np.repeat(begin, sizes)[tied]
    differ = np.zeros(len(tied), bool)
    for deep in [*range(shallow, length - _STEP, _STEP), length - _STEP]:
        differ |= _keys(text, starts[order[tied]] + deep) != _keys(text, starts[order[heads]] + deep)
    branching = np.zeros(len(order), bool)
    branching[heads[differ]] = True
    for at, size in zip(begin[branching[begin]].tolist(), sizes[branching[begin]].tolist()):
        trie = BlindTrie()
        members = order[at : at + size].tolist()
        for member, place in zip(members, starts[members].tolist()):
            trie.add(raw[place : place + length], member)
        for leaf in trie.leaves():
            order[at : at + len(leaf)] = leaf
            first[at + 1 : at + len(leaf)] = False
            first[at] = True
            at += len(leaf)
    return order, first
