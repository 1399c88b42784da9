"""Deep-shallow sorting of byte strings in one task.

Strings are sorted by eight bytes at a time, each round splitting the groups of strings
that are equal so far (a multikey quicksort with words for characters, all groups at
once), down to a shallow depth. Groups that are still together have a long common prefix;
a blind trie orders each. It keeps only the places where its strings branch: a string goes down by
the bytes at these places, unseen what lies between, and is then compared once, with the
leaf it came to.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 32  # bytes that are sorted by words; a multiple of 8


def word_at(data: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The eight bytes from `at` on as a big-endian number, zero past `length`."""
    word = np.zeros(len(at), np.uint64)
    last = len(data) - 1
    for k in range(8):
        byte = np.where(k < length, data[np.minimum(at + k, last)], 0)
        word = (word << np.uint64(8)) | byte.astype(np.uint64)
    return word


class BlindTrie:
    """Strings of one group by their branching places."""

    def __init__(self, text: bytes, number: int):
        # A node is [depth, leaf below, children by byte]; a leaf is (text, numbers).
        self.root: list | tuple = (text, [number])

    @staticmethod
    def _common(a: bytes, b: bytes) -> int:
        if a == b:
            return len(a)
        n = min(len(a), len(b))
        differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
        return n - (differ.bit_length() + 7) // 8

    @staticmethod
    def _branch(text: bytes, depth: int) -> int:
        return text[depth] if depth < len(text) else -1

    def insert(self, text: bytes, number: int) -> None:
        node, path = self.root, []
        while isinstance(node, list):
            path.append(node)
            node = node[2].get(self._branch(text, node[0])) or node[1]
        leaf = node
        common = self._common(text, leaf[0])
        if common == len(text) == len(leaf[0]):
            leaf[1].append(number)
            return
        new = (text, [number])
        above = None
        for parent in path:
            if parent[0] == common:
                parent[2][self._branch(text, common)] = new
                return
            if parent[0] > common:
                break
            above = parent
        below = self.root if above is None else above[2][self._branch(text, above[0])]
        split = [common, leaf, {self._branch(leaf[0], common): below, self._branch(text, common): new}]
        if above is None:
            self.root = split
        else:
            above[2][self._branch(text, above[0])] = split

    def leaves(self) -> list[list[int]]:
        """Numbers of equal strings, in the order of the strings."""
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack += [node[2][byte] for byte in sorted(node[2], reverse=True)]
            else:
                out.append(node[1])
        return out


def sort_strings(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, group: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings by (group, bytes), and the class of each in that order: equal
    strings of a group share a class."""
    order = np.argsort(group, kind="stable")
    part = group[order]
    for depth in range(0, SHALLOW, 8):
        shared = _shared(part)
        if not shared.any():
            break
        at = order[shared]
        word = word_at(data, starts[at] + depth, lengths[at] - depth)
        again = np.lexsort((word, part[shared]))
        order[shared] = at[again]
        differ = np.zeros(len(part), bool)
        differ[shared] = np.append(True, word[again][1:] != word[again][:-1])
        part = np.cumsum(differ | _begins(part))
    shared = _shared(part)
    if shared.any():
        raw = data.tobytes()
        firsts = np.flatnonzero(_begins(part))
        sizes = np.diff(np.append(firsts, len(part)))
        apart = np.zeros(len(part), bool)
        for first, size in zip(firsts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            members = order[first : first + size].tolist()
            begins, ends = starts[members].tolist(), (starts[members] + lengths[members]).tolist()
            trie = BlindTrie(raw[begins[0] : ends[0]], members[0])
            for number, a, b in zip(members[1:], begins[1:], ends[1:]):
                trie.insert(raw[a:b], number)
            at = first
            for equal in trie.leaves():
                order[at : at + len(equal)] = equal
                apart[at] = True
                at += len(equal)
        part = np.cumsum(apart | _begins(part))
    return order, part


def _begins(part: np.ndarray) -> np.ndarray:
    return np.append(True, part[1:] != part[:-1])[: len(part)]


def _shared(part: np.ndarray) -> np.ndarray:
    """Whether a string has company in its group."""
    same = part[1:] == part[:-1]
    return np.append(False, same)[: len(part)] | np.append(same, False)[: len(part)]
