"""Cheapest repair of a sequence of roles, as a shortest path found by the auction algorithm.

A node is a place between rows and a state of the pattern ``(s?(ua)+)?``: nothing yet, after system, after user, after
assistant. Arcs keep, re-role or delete the next row, or insert one; costs are whole numbers and every cycle (insert
user, insert assistant) costs something. Each node has a price, never above the cost of the cheapest arc plus the price where it leads. A path
grows from its origin along arcs that meet that bound; where none does, the last node's price rises to the least such sum and
the path draws back one node. When the path reaches the end, the origin's price is its distance, and every cheapest path
uses only arcs that are tight under the prices, so ties are settled by tracing these in the order of the letters.

Sequences are cut into blocks. A block's end is priced by what follows, so blocks are solved from the last to the first and
traced from the first to the last.
"""

from __future__ import annotations

from functools import lru_cache

#: Rows of a block: an auction may take as many steps as the square of its rows.
BLOCK = 32
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: Where the role of a kept row leads.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The only role that may be given or put in next.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: A code for each row: its role's initial (x: none of the three), in upper case if it is truncated; d: it must go.
MUST_GO = "d"

Prices = tuple[float, ...]
Arc = tuple[str, int, int]
NEVER = float("inf")


def _arcs(codes: str, ends: Prices | None) -> list[list[Arc]]:
    """By node (place * 4 + state): (letter, cost, node). The last node is the end. Without ``ends`` the sequence
    ends here: rows may still be put in after the last one, and it must close with nothing or an assistant."""
    last = len(codes)
    end = (last + 1) * 4
    arcs: list[list[Arc]] = [[] for _ in range(end + 1)]
    for at, code in enumerate(codes):
        more = TRUNCATED if code.isupper() else 0
        for state in STATES:
            out = arcs[at * 4 + state]
            out.append(("D", DELETE, at * 4 + 4 + state))
            out.append(("I", INSERT, at * 4 + NEXT[state]))
            if code != MUST_GO:
                kept = KEPT.get((state, code.lower()))
                if kept is not None:
                    out.append(("K", KEEP + more, at * 4 + 4 + kept))
                out.append(("R", REROLE + more, at * 4 + 4 + NEXT[state]))
    for state in STATES:
        if ends is None:
            arcs[last * 4 + state].append(("I", INSERT, last * 4 + NEXT[state]))
            if state in (START, ASSISTANT):
                arcs[last * 4 + state].append(("", 0, end))
        elif ends[state] != NEVER:
            arcs[last * 4 + state].append(("", int(ends[state]), end))
    # A node that cannot reach the end has no price; arcs to it go.
    reached = [False] * (end + 1)
    reached[end] = True
    for place in range(last, -1, -1):
        for _ in STATES:
            for state in STATES:
                node = place * 4 + state
                reached[node] = reached[node] or any(reached[to] for _, _, to in arcs[node])
    return [[a for a in out if reached[a[2]]] for out in arcs]


def auction(arcs: list[list[Arc]], prices: list[int], origin: int) -> None:
    """Raise ``prices`` until a path of tight arcs leads from ``origin`` to the last node."""
    end = len(arcs) - 1
    path = [origin]
    while path[-1] != end:
        node = path[-1]
        best, to = min((cost + prices[j], j) for _, cost, j in arcs[node])
        if prices[node] < best:
            prices[node] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(to)


@lru_cache(1 << 15)
def _priced(codes: str, ends: Prices | None, origins: tuple[int, ...]) -> tuple[list[list[Arc]], list[int]]:
    arcs = _arcs(codes, ends)
    prices = [0] * len(arcs)
    for origin in origins:
        if arcs[origin]:
            auction(arcs, prices, origin)
    return arcs, prices


def block_prices(codes: str, ends: Prices | None) -> Prices:
    """The cost from each state before the block to the end."""
    # The end prices are lowered by the least of them, which shifts all distances alike and keeps the auction short.
    least = 0 if ends is None else min(ends)
    arcs, prices = _priced(codes, ends if ends is None else tuple(e - least for e in ends), tuple(STATES))
    return tuple(float(prices[s] + least) if arcs[s] else NEVER for s in STATES)


def block_trace(codes: str, ends: Prices | None, states: frozenset[int]) -> tuple[str, frozenset[int]]:
    """The least letters of cheapest paths that leave the block's start in one of ``states`` (all of them on a cheapest
    path), and the states in which these letters may leave its end."""
    least = 0 if ends is None else min(ends)
    arcs, prices = _priced(codes, ends if ends is None else tuple(e - least for e in ends), tuple(sorted(states)))
    known = {len(arcs) - 1: True}

    def leads(node: int) -> bool:
        """Whether tight arcs lead from here to the end. They make no cycle, as every cycle costs something."""
        if node not in known:
            known[node] = any(prices[node] == cost + prices[j] and leads(j) for _, cost, j in arcs[node])
        return known[node]

    nodes, letters = set(states), []
    while True:
        open_arcs = [(letter, j) for node in nodes for letter, cost, j in arcs[node] if prices[node] == cost + prices[j] and leads(j)]
        letter = min(open_arcs)[0]
        if not letter:
            leaving = (node for node in nodes if any(not x and prices[node] == cost + prices[j] for x, cost, j in arcs[node]))
            return "".join(letters), frozenset(node % 4 for node in leaving)
        letters.append(letter)
        nodes = {j for x, j in open_arcs if x == letter}


def blocks(codes: str) -> list[str]:
    return [codes[i : i + BLOCK] for i in range(0, len(codes), BLOCK)] or [""]


def sweep(codes: str, ends: Prices | None) -> list[Prices | None]:
    """What each block of a run ends with (from the first to the last), and the prices before the first at the front."""
    priced: list[Prices | None] = [ends]
    for block in reversed(blocks(codes)):
        priced.append(block_prices(block, priced[-1]))
    return priced[::-1]


def trace(codes: str, ends: Prices | None, states: frozenset[int]) -> tuple[str, frozenset[int]]:
    parts, letters = blocks(codes), []
    for block, after in zip(parts, sweep(codes, ends)[1:] if len(parts) > 1 else [ends], strict=True):
        found, states = block_trace(block, after, states)
        letters.append(found)
    return "".join(letters), states


def crossing(codes: str) -> list[Prices]:
    """By the state behind a run (one that does not end the sequence): the cost from each state before it."""
    return [sweep(codes, tuple(0.0 if s == to else NEVER for s in STATES))[0] for to in STATES]


def cost(codes: str, letters: str) -> int:
    """Of edits to the rows of a run."""
    total, at = 0, 0
    for letter in letters:
        if letter == "I":
            total += INSERT
            continue
        total += {"K": KEEP, "R": REROLE, "D": DELETE}[letter]
        total += TRUNCATED if letter != "D" and codes[at].isupper() else 0
        at += 1
    return total
