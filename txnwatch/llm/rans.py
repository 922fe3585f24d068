"""A static range asymmetric numeral system over numpy lanes.

Blocks are independent. Inside a block, token ``i`` belongs to lane ``i % LANES``
and step ``i // LANES``; every lane has its own state, and the words that the lanes
put out are interleaved in lane order. Every ``INTERVAL`` steps a checkpoint holds
the lane states and the place in the words, so the sections between checkpoints
decode at the same time, as do all blocks.
"""

import numpy as np

LANES, INTERVAL, BLOCK_TOKENS = 256, 256, 1 << 18
SCALE_BITS = 20
_LOW = np.uint64(1 << 31)
_WORD, _SCALE = np.uint64(32), np.uint64(SCALE_BITS)
_WORD_MASK, _SLOT_MASK = np.uint64((1 << 32) - 1), np.uint64((1 << SCALE_BITS) - 1)


def scaled(counts: np.ndarray) -> np.ndarray:
    """Counts of symbols that occur, as whole shares of 2^20 of at least one."""
    total, whole = int(counts.sum()), 1 << SCALE_BITS
    if len(counts) > whole:
        raise ValueError("more symbols than slots")
    shares = np.maximum(1, (counts.astype(np.float64) * (whole / total)).astype(np.int64))
    surplus = int(shares.sum()) - whole
    if surplus < 0:
        shares[np.argmax(shares)] -= surplus
    while surplus > 0:  # those raised to one are paid for by the largest, in proportion
        spare = shares - 1
        cut = np.minimum(spare, np.ceil(spare * (surplus / spare.sum())).astype(np.int64))
        over = np.cumsum(cut) - surplus
        cut = np.where(over > 0, np.maximum(0, cut - over), cut)
        shares -= cut
        surplus -= int(cut.sum())
    return shares


class Table:
    """Symbols that occur, with their shares; shared by all blocks that name it."""

    def __init__(self, symbols: np.ndarray, shares: np.ndarray):
        self.symbols, self.shares = symbols.astype(np.uint32), shares.astype(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(self.shares)[:-1]]).astype(np.uint64)
        self.place = np.zeros(int(symbols.max()) + 1 if len(symbols) else 0, np.int64)
        self.place[symbols] = np.arange(len(symbols))
        self._of_slot = None

    @classmethod
    def of(cls, ids: np.ndarray) -> "Table":
        counts = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
        symbols = np.flatnonzero(counts)
        return cls(symbols, scaled(counts[symbols]) if len(symbols) else counts)

    @property
    def of_slot(self) -> np.ndarray:
        if self._of_slot is None:
            self._of_slot = np.repeat(np.arange(len(self.symbols), dtype=np.uint32), self.shares.astype(np.int64))
        return self._of_slot


def layout(n: int) -> tuple[int, int]:
    """Blocks and steps for ``n`` tokens; all blocks have as many steps."""
    blocks = max(1, -(-n // BLOCK_TOKENS))
    return blocks, max(1, -(-n // (blocks * LANES)))


def encode(ids: np.ndarray, table: Table) -> list[dict]:
    """Blocks of ``ids``: n tokens, checkpoint states, places in the words, words."""
    blocks, steps = layout(len(ids))
    size = steps * LANES
    padded = np.full(blocks * size, ids[-1], np.int64)
    padded[: len(ids)] = ids
    places = table.place[padded].reshape(blocks, steps, LANES)
    state = np.full((blocks, LANES), _LOW, np.uint64)
    out, counts, marks = [], np.zeros((steps, blocks), np.int64), {}
    emitted = np.zeros(blocks, np.int64)
    for step in range(steps - 1, -1, -1):
        place = places[:, step]
        share = table.shares[place]
        full = state >= share << np.uint64(63 - SCALE_BITS)
        out.append((state[full] & _WORD_MASK).astype(np.uint32))
        state = np.where(full, state >> _WORD, state)
        counts[step] = full.sum(axis=1)
        emitted += counts[step]
        quotient, rest = np.divmod(state, share)
        state = (quotient << _SCALE) + rest + table.before[place]
        if step % INTERVAL == 0:
            marks[step] = (state.copy(), emitted.copy())
    words = np.concatenate(out[::-1])
    owner = np.repeat(np.tile(np.arange(blocks), steps), counts.ravel())
    words = words[np.argsort(owner, kind="stable")]
    ends = np.cumsum(emitted)
    sections = range(0, steps, INTERVAL)
    return [{
        "n": max(0, min(size, len(ids) - block * size)),
        "states": np.stack([marks[step][0][block] for step in sections]),
        "starts": np.array([emitted[block] - marks[step][1][block] for step in sections], np.uint32),
        "words": words[ends[block] - emitted[block]: ends[block]],
    } for block in range(blocks)]


def decode(blocks: list[dict], steps: int, table: Table) -> list[np.ndarray]:
    """Ids of blocks of ``steps`` steps each; all their sections go forward together."""
    words = np.concatenate([block["words"] for block in blocks] + [np.zeros(1, np.uint32)])
    base = np.cumsum([0] + [len(block["words"]) for block in blocks[:-1]])
    sections = len(blocks[0]["starts"])
    at = np.concatenate([start + block["starts"].astype(np.int64) for start, block in zip(base, blocks)])
    state = np.concatenate([block["states"] for block in blocks]).astype(np.uint64)
    found = np.zeros((len(blocks) * sections, INTERVAL, LANES), np.uint32)
    last = steps - (sections - 1) * INTERVAL  # the last section of a block may be short
    live = np.arange(len(blocks) * sections)
    for step in range(min(steps, INTERVAL)):
        if step == last and sections > 1:
            live = live[live % sections != sections - 1]
            state, at = state[live_rows(sections, len(blocks))], at[live_rows(sections, len(blocks))]
        slot = state & _SLOT_MASK
        place = table.of_slot[slot]
        found[live, step] = table.symbols[place]
        state = table.shares[place] * (state >> _SCALE) + slot - table.before[place]
        low = state < _LOW
        rank = np.cumsum(low, axis=1)
        taken = words[np.minimum(at[:, None] + rank - 1, len(words) - 1)]
        state = np.where(low, (state << _WORD) | taken, state)
        at = at + rank[:, -1]
    flat = found.reshape(len(blocks), sections * INTERVAL * LANES)
    return [flat[i, : block["n"]] for i, block in enumerate(blocks)]


def live_rows(sections: int, blocks: int) -> np.ndarray:
    """Rows of all sections but the last of each block."""
    return np.flatnonzero(np.arange(sections * blocks) % sections != sections - 1)
