"""Deep-shallow sorting of byte strings, and the common extents it gives.

Strings are sorted by multikey quicksort, a few bytes at a time, down to a
shallow depth. Groups that are still equal there share a long prefix; each is
put into a blind trie, which keeps only branching depths and bytes: a string
goes down by the bytes at those depths alone, is compared once with the leaf
it meets, and is inserted where they part.
"""

from __future__ import annotations

import bisect

SHALLOW = 32  # bytes past the known common prefix
STEP = 8


def common(a: bytes, b: bytes, least: int = 0) -> int:
    """Length of the common prefix; the first ``least`` bytes are known to agree."""
    n = min(len(a), len(b))
    x, y = a[least:n], b[least:n]
    if x == y:
        return n
    differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return n - (differ.bit_length() + 7) // 8


class Blind:
    """A blind trie: inner nodes are [depth, {byte or -1: child}], leaves are indexes."""

    def __init__(self, strings: list[bytes], known: int):
        self.strings, self.known, self.root = strings, known, None

    def insert(self, index: int) -> None:
        if self.root is None:
            self.root = index
            return
        text = self.strings[index]
        node = self.root
        while not isinstance(node, int):
            depth, children = node
            byte = text[depth] if depth < len(text) else -1
            node = children.get(byte)
            if node is None:  # any leaf below will do for the comparison
                node = next(iter(children.values()))
        other = self.strings[node]
        part = common(text, other, self.known)
        byte = text[part] if part < len(text) else -1
        met = other[part] if part < len(other) else -1
        # down again to where the two part
        above, at, node = None, None, self.root
        while not isinstance(node, int) and node[0] < part:
            above, at = node, text[node[0]]
            node = node[1][at]
        if not isinstance(node, int) and node[0] == part:
            node[1][byte] = index  # a new byte at a known depth
            return
        fork = [part, {met: node, byte: index}]
        if above is None:
            self.root = fork
        else:
            above[1][at] = fork

    def ordered(self) -> tuple[list[int], list[int]]:
        """Indexes in order, and the common prefix of each with the next."""
        order, shared = [], []
        todo = [(self.root, 0)]
        while todo:
            node, depth = todo.pop()
            if isinstance(node, int):
                if order:
                    shared.append(depth)
                order.append(node)
                continue
            below = sorted(node[1].items(), reverse=True)
            # the first child inherits the depth to what came before
            for i, (_, child) in enumerate(below):
                todo.append((child, depth if i == len(below) - 1 else node[0]))
        return order, shared


def deep_shallow(strings: list[bytes], known: int = 0) -> tuple[list[int], list[int]]:
    """Order of distinct strings, and the common prefix of each with the next.

    All agree in their first ``known`` bytes.
    """
    order: list[int] = []
    todo = [(list(range(len(strings))), known)]
    while todo:
        group, depth = todo.pop()
        if len(group) < 2:
            order += group
        elif depth - known >= SHALLOW:
            trie = Blind(strings, depth)
            for index in group:
                trie.insert(index)
            order += trie.ordered()[0]
        else:
            pivot = strings[group[len(group) // 2]][depth : depth + STEP]
            less, equal, more = [], [], []
            for index in group:
                key = strings[index][depth : depth + STEP]
                (less if key < pivot else equal if key == pivot else more).append(index)
            todo.append((more, depth))
            # a string that ends here is alone with its equal prefix, as all are distinct
            ended = [i for i in equal if len(strings[i]) <= depth + STEP]
            longer = [i for i in equal if len(strings[i]) > depth + STEP]
            todo.append((longer, depth + STEP))
            if ended:
                todo.append((ended, depth + STEP))
            todo.append((less, depth))
    shared = [common(strings[a], strings[b], known) for a, b in zip(order, order[1:])]
    return order, shared


def extents(left: list[bytes], right: list[bytes], length: int, known: int = 0) -> list[tuple[int, int]]:
    """For each place, how far it agrees with others: (to the left, to the right).

    Place i reads ``left[i]`` backwards and ``right[i]`` forwards. Only others
    count with which it has ``length`` bytes or more in common, both sides
    together; the farthest extent of each side is returned, (0, 0) for none.
    The (left, right) pairs are distinct.
    """
    n = len(left)
    best_left, best_right = [0] * n, [0] * n
    # equal sides get one rank; ranks order the left sides
    sides = sorted(set(left))
    order, _ = deep_shallow(sides)
    rank_of = {sides[s]: r for r, s in enumerate(order)}
    rank = [rank_of[x] for x in left]
    rights: dict[bytes, list[int]] = {}
    for i, x in enumerate(right):
        rights.setdefault(x, []).append(i)
    forms = list(rights)
    order, shared = deep_shallow(forms, known)

    def meet(x: int, y: int, agreed: int) -> None:
        back = common(left[x], left[y])
        if back + agreed >= length:
            for z in (x, y):
                best_left[z] = max(best_left[z], back)
                best_right[z] = max(best_right[z], agreed)

    def merge(large: list, small: list, agreed: int) -> list:
        for item in small:
            at = bisect.bisect_left(large, item)
            if at:
                meet(large[at - 1][1], item[1], agreed)
            if at < len(large):
                meet(large[at][1], item[1], agreed)
            large.insert(at, item)
        return large

    # clusters of neighbours in right order, each sorted by left rank
    clusters: list[list] = []
    for r in order:
        members: list = []
        for i in rights[forms[r]]:
            members = merge(members, [(rank[i], i)], len(forms[r]))
        clusters.append(members)
    parent = list(range(len(clusters)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    # from the deepest common prefix up; the smaller cluster joins the larger
    for i in sorted(range(len(shared)), key=lambda i: -shared[i]):
        a, b = find(i), find(i + 1)
        if len(clusters[a]) < len(clusters[b]):
            a, b = b, a
        clusters[a] = merge(clusters[a], clusters[b], shared[i])
        clusters[b] = []
        parent[b] = a
    return list(zip(best_left, best_right))
