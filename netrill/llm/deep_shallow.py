"""Deep-shallow sorting of byte strings, and what a sorted pair of contexts tells.

Strings are sorted by multikey quicksort, eight bytes at a time, down to a shallow depth.
Groups that still agree there have long common prefixes; a blind trie orders them, which
compares each string once in full and otherwise looks at branching bytes only.
"""

from __future__ import annotations

SHALLOW, STEP = 64, 8


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    if a == b:
        return len(a)
    size = min(len(a), len(b))
    differ = int.from_bytes(a[:size], "big") ^ int.from_bytes(b[:size], "big")
    return size - (differ.bit_length() + 7) // 8


def _blind_trie(strings: list[bytes], group: list[int]) -> list[int]:
    """Order of the distinct strings of a group."""

    def byte(text: bytes, depth: int) -> int:
        return text[depth] if depth < len(text) else -1

    # A node is (depth, children by byte); a leaf is the string's number.
    root: tuple | int = group[0]
    for number in group[1:]:
        text, node = strings[number], root
        # Down along branching bytes only; any child will do where the byte is new.
        while not isinstance(node, int):
            depth, children = node
            key = byte(text, depth)
            node = children[key] if key in children else next(iter(children.values()))
        other = strings[node]
        depth = common(text, other)
        # Down again to the place where the string leaves the trie.
        above, key, node = None, 0, root
        while not isinstance(node, int) and node[0] < depth:
            above, key = node, byte(text, node[0])
            node = node[1][key]
        if not isinstance(node, int) and node[0] == depth:
            node[1][byte(text, depth)] = number
            continue
        new = (depth, {byte(text, depth): number, byte(other, depth): node})
        if above is None:
            root = new
        else:
            above[1][key] = new
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, int):
            out.append(node)
        else:
            stack.extend(node[1][key] for key in sorted(node[1], reverse=True))
    return out


def ordered(strings: list[bytes]) -> list[int]:
    """Numbers of distinct strings in the order of their bytes."""
    out: list[int] = []
    stack = [(list(range(len(strings))), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) == 1:
            out.append(group[0])
            continue
        if depth >= SHALLOW:
            out.extend(_blind_trie(strings, group))
            continue
        # Three-way split by the next word. A shorter string's word sorts first: words are
        # compared as bytes, and equal short words mean equal strings, which don't occur.
        pivot = strings[group[len(group) // 2]][depth : depth + STEP]
        less, equal, more = [], [], []
        for number in group:
            word = strings[number][depth : depth + STEP]
            (equal if word == pivot else less if word < pivot else more).append(number)
        for part, at in ((more, depth), (equal, depth + STEP), (less, depth)):
            if part:
                stack.append((part, at))
    return out


def extents(lefts: list[bytes], rights: list[bytes], length: int) -> list[tuple[int, int]]:
    """For each of some different contexts around one place how far it is repeated.

    `lefts` are read backwards from the place, `rights` forwards. A context and another that
    agree on `l` bytes before and `r` bytes after the place share all strings of `length`
    bytes within, if l + r >= length. Given is the largest such l and r, (0, 0) for none.

    Suffixes after the place are sorted; each interval of the order that agrees on `d` bytes is
    visited from the outermost on, and in it the best neighbour by the bytes before the place.
    """
    size = len(lefts)
    out = [(0, 0)] * size

    def found(number: int, left: int, right: int) -> None:
        if left + right >= length:
            out[number] = (max(out[number][0], left), max(out[number][1], right))

    if size == 2:
        left, right = common(*lefts), common(*rights)
        found(0, left, right)
        found(1, left, right)
        return out
    by_right = _order_of_all(rights)
    near = [common(rights[a], rights[b]) for a, b in zip(by_right, by_right[1:])]
    place = [0] * size
    for at, number in enumerate(by_right):
        place[number] = at
    stack = [(0, size, _order_of_all(lefts))]
    while stack:
        low, high, members = stack.pop()
        # Identical bytes after the place agree to the end of the shorter.
        depth = min(near[low : high - 1])
        shared = [common(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        for at, number in enumerate(members):
            before = shared[at - 1] if at else 0
            after = shared[at] if at < len(shared) else 0
            found(number, max(before, after), depth)
        # Deeper intervals hold fewer neighbours, so nothing is found there without enough before.
        if max(shared) + max(len(rights[n]) for n in members) < length:
            continue
        cuts = [low, *[at + 1 for at in range(low, high - 1) if near[at] == depth], high]
        part_of = {}
        for part, (begin, end) in enumerate(zip(cuts, cuts[1:])):
            if end - begin > 1:
                part_of.update((at, part) for at in range(begin, end))
        parts: dict[int, list[int]] = {}
        for number in members:
            part = part_of.get(place[number])
            if part is not None:
                parts.setdefault(part, []).append(number)
        stack.extend((cuts[part], cuts[part + 1], own) for part, own in parts.items())
    return out


def _order_of_all(strings: list[bytes]) -> list[int]:
    """Order of strings that may be equal; equal ones stand together."""
    numbers: dict[bytes, list[int]] = {}
    for number, text in enumerate(strings):
        numbers.setdefault(text, []).append(number)
    distinct = list(numbers)
    return [number for at in ordered(distinct) for number in numbers[distinct[at]]]
