"""The steps of the conversation repair: costs, vectors, traces of one chunk.

A row is one symbol: x and y must go (blank, duplicate); s, u, a are roles
that may be kept, o any other; upper case if the text is truncated. A cost
vector holds the least cost from each state to the end of the conversation,
with insertions allowed first, and less its least entry: only differences
between states matter.
"""

from __future__ import annotations

# States: nothing yet, after the system row, user row open, answered.
START, SYSTEM, OPEN, DONE = range(4)
#: The role that fits next in each state, and the state after it.
FITS = (("user", OPEN), ("user", OPEN), ("assistant", DONE), ("user", OPEN))
KEPT = {"s": {START: SYSTEM}, "u": {START: OPEN, SYSTEM: OPEN, DONE: OPEN}, "a": {OPEN: DONE}}
# What the edits cost.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
FAR = 1 << 20
Vector = tuple[int, int, int, int]


def _with_insertions(v: list[int]) -> list[int]:
    """Two insertions reach every state that any number does."""
    for _ in range(2):
        v = [min(v[s], INSERT + v[FITS[s][1]]) for s in range(4)]
    return v


def _level(v: list[int]) -> Vector:
    low = min(v)
    return tuple(x - low for x in v)


#: The vector at the end of a conversation: empty or answered.
END: Vector = _level(_with_insertions([0, FAR, FAR, 0]))
#: The vector that chunks start from before their successor's is known.
SPECULATIVE: Vector = (0, 0, 0, 0)

_steps: dict[tuple[str, Vector], tuple] = {}


def _step(symbol: str, after: Vector) -> tuple[Vector, tuple]:
    """The vector before a row, and for each state the best move there:
    (edit, cost, next state, rows used), ties to the least letter."""
    known = _steps.get((symbol, after))
    if known:
        return known
    if symbol in "xy":
        out = after, tuple(("D", DELETE, s, 1) for s in range(4))
    else:
        extra, kept = TRUNCATED * symbol.isupper(), KEPT.get(symbol.lower(), {})
        uses = []
        for s in range(4):
            moves = [("D", DELETE, s, 1), ("R", REROLE + extra, FITS[s][1], 1)]
            if s in kept:
                moves.append(("K", KEEP + extra, kept[s], 1))
            uses.append(moves)
        cost = _with_insertions([min(c + after[t] for _, c, t, _ in moves) for moves in uses])
        best = []
        for s, moves in enumerate(uses):
            ties = [m for m in moves if m[1] + after[m[2]] == cost[s]]
            if INSERT + cost[FITS[s][1]] == cost[s]:
                ties.append(("I", INSERT, FITS[s][1], 0))
            best.append(min(ties))
        out = _level(cost), tuple(best)
    if len(_steps) > 100_000:
        _steps.clear()
    _steps[symbol, after] = out
    return out


def backward(symbols: str, end: Vector, stored: list[Vector] | None = None) -> list[Vector]:
    """The vectors before each row and, last, at the end. ``stored`` ones are
    renewed only as far back as they differ by more than a constant."""
    vectors = list(stored) if stored else [()] * (len(symbols) + 1)
    vectors[-1] = end
    for i in range(len(symbols) - 1, -1, -1):
        v = _step(symbols[i], vectors[i + 1])[0]
        if v == vectors[i]:
            break
        vectors[i] = v
    return vectors


def trace(symbols: str, vectors: list[Vector], state: int, last: bool) -> tuple[str, int, int]:
    """The cheapest edits from a state (ties: least initials), the state they
    end in and their cost. ``last``: the conversation ends with this chunk."""
    out, cost, i = [], 0, 0
    while i < len(symbols):
        letter, price, state, used = _step(symbols[i], vectors[i + 1])[1][state]
        out.append(letter)
        cost, i = cost + price, i + used
    while last and state not in (START, DONE):
        out.append("I")
        cost, state = cost + INSERT, FITS[state][1]
    return "".join(out), state, cost


def edited(edits: str, roles: list[str], texts: list[str], state: int) -> list[tuple[str, str]]:
    """The repaired (role, text) rows of a chunk."""
    out, i = [], 0
    for letter in edits:
        role, after = FITS[state]
        if letter == "I":
            out.append((role, ""))
            state = after
            continue
        if letter == "R":
            out.append((role, texts[i]))
            state = after
        elif letter == "K":
            out.append((roles[i], texts[i]))
            state = KEPT[roles[i][0]][state]
        i += 1
    return out


def packed(vectors: list[Vector]) -> bytes:
    return bytes(x for v in vectors for x in v)


def unpacked(data: bytes) -> list[Vector]:
    return [tuple(data[i : i + 4]) for i in range(0, len(data), 4)]
