"""A hierarchical Pitman-Yor model: Gibbs sampling of Chinese-restaurant seatings, and a model of spellings.

A customer of a restaurant is an occurrence of a dish; each table sends one customer to the parent restaurant. gibbs()
seats restaurants whose parent's probabilities are given: a sweep takes one customer after the other out and seats it
anew, at another of its dish's tables in proportion to that table's customers less d, or at a new one in proportion to
(theta + d T) times the parent's probability. Dishes take their steps side by side, each with the other dishes' tables as
they stood when the sweep began. A dish of more than CROWD customers is cleared and seated afresh in a sweep, its customers
in runs that lengthen by a tenth at the odds of the run's start. Tables are averaged over the sweeps after burn-in.

Spellings: symbols are classes of bytes, and a word ends with a symbol of its own. A restaurant stands for a context of the
last three symbols; those that share the last two share a parent, and so on down to one restaurant without context, whose
base is uniform. A sweep goes from the longest contexts to the shortest, and predictive probabilities are averaged over
the sweeps after burn-in. All arrays of it have SYMBOLS ** 4 cells at most, whatever the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ORDER = 4
END = 37
SYMBOLS = 38
SPLIT = 10  # the byte that ends a word where words are laid end to end; no word holds it


def _classes() -> np.ndarray:
    """Of each byte: 1-26 letters of either case, 27 digits, 28 other printable ASCII, 29 control, 30-33 UTF-8
    continuation bytes by 16, 34-36 lead bytes of two, three and four. 0 is before a word, END its end."""
    out = np.full(256, 29, np.int64)
    for b in range(256):
        c = chr(b)
        if b >= 0xF0:
            out[b] = 36
        elif b >= 0xE0:
            out[b] = 35
        elif b >= 0xC0:
            out[b] = 34
        elif b >= 0x80:
            out[b] = 30 + (b - 0x80) // 16
        elif c.isalpha():
            out[b] = ord(c.lower()) - 96
        elif c.isdigit():
            out[b] = 27
        elif 32 < b < 127:
            out[b] = 28
    out[SPLIT] = END
    return out


CLASSES = _classes()


@dataclass(frozen=True)
class HpyConfig:
    discounts: tuple[float, ...] = (0.3, 0.5, 0.6, 0.7)  # by length of context
    strength: float = 1.0
    word_discount: float = 0.6
    word_strength: float = 10.0
    pair_discount: float = 0.75
    pair_strength: float = 2.0
    hot: int = 400_000  # customers of a context beyond which it is dealt out
    sweeps: int = 6
    burn_in: int = 2
    seed: int = 7


def laid_out(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"\n".join(words) + b"\n", np.uint8) if words else np.zeros(0, np.uint8)


def quads(data: np.ndarray) -> np.ndarray:
    """Of each symbol of words laid end to end, with their ends: the number of (three symbols before it, it)."""
    x = CLASSES[data]
    last, key = np.zeros(len(x), np.int64), x.copy()
    inside = np.ones(len(x), bool)
    for back in range(1, ORDER):
        last[:back], last[back:] = END, x[:-back]
        inside &= last != END
        key += np.where(inside, last, 0) * SYMBOLS**back
    return key


def seated(customers: np.ndarray, mass: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its customers are seated one by one; mass: (theta + d T) times the base's probability."""
    tables = (customers > 0).astype(np.int64)
    at = np.flatnonzero(customers > 1)
    at = at[np.argsort(-customers[at], kind="stable")]
    c, m, t, n = customers[at], mass[at], np.ones(len(at)), 1
    while len(c) and c[0] > n:
        live = int(np.searchsorted(-c, -n, "left"))  # dishes with more than n customers
        step = max(1, n // 10)
        some = np.minimum(c[:live] - n, step)
        old = np.maximum(n - discount * t[:live], 1e-12)
        t[:live] += rng.binomial(some, m[:live] / (m[:live] + old))
        n += step
    tables[at] = t.astype(np.int64)
    return tables


#: Customers of a dish up to which they are seated one by one.
CROWD = 200


class Seats:
    """Customers of dishes at their tables. Those of a dish lie in a row, as do the sizes of its tables."""

    def __init__(self, customers: np.ndarray):
        order = np.argsort(-customers, kind="stable")
        self.order, self.n = order, customers[order]
        self.begin = np.cumsum(self.n) - self.n
        self.seat, self.size = np.zeros(int(self.n.sum()), np.int32), np.zeros(int(self.n.sum()), np.int32)
        self.tables, self.full = np.zeros(len(self.n), np.int64), False

    def sweep(self, others: np.ndarray, own: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
        """Seats each customer anew (the first time, seats them all); a new table's weight is others + own * tables."""
        others, own, n, begin, seat, size, t = others[self.order], own[self.order], self.n, self.begin, self.seat, self.size, self.tables
        for j in range(int(n[0]) if len(n) else 0):
            live = int(np.searchsorted(-n, -j, "left"))
            me = begin[:live] + j
            if self.full:
                at = begin[:live] + seat[me]
                size[at] -= 1
                t[:live] -= size[at] == 0
                company = n[:live] - 1
            else:
                company = np.full(live, j)
            fresh = others[:live] + own[:live] * t[:live]
            old = np.maximum(company - discount * t[:live], 0.0)
            new = rng.random(live) * (fresh + old) < fresh
            new |= t[:live] == 0
            todo = np.flatnonzero(~new)
            while len(todo):
                # the table of a customer at random, taken with probability (size - d) / size
                of = (rng.random(len(todo)) * company[todo]).astype(np.int64)
                of = (j + 1 + of) % n[todo] if self.full else of
                table = seat[begin[todo] + of]
                there = size[begin[todo] + table]
                took = rng.random(len(todo)) * there < there - discount
                k = todo[took]
                seat[begin[k] + j] = table[took]
                size[begin[k] + table[took]] += 1
                todo = todo[~took]
            k = np.flatnonzero(new)
            free = np.full(len(k), j)
            while (taken := size[begin[k] + free] > 0).any():
                free[taken] = (free[taken] + 1) % n[k[taken]]
            seat[begin[k] + j] = free
            size[begin[k] + free] = 1
            t[k] += 1
        self.full = True
        out = np.empty(len(n), np.int64)
        out[self.order] = t
        return out


def gibbs(customers: np.ndarray, group: np.ndarray, scale: np.ndarray, p: np.ndarray, discount: float, strength: float, rng: np.random.Generator, config: HpyConfig) -> np.ndarray:
    """Tables of each dish, summed over the sweeps that are kept. group: the restaurant of each dish. p: the parent's
    probability of it. scale: of each restaurant, how many times the tables of the dishes given it has in all."""
    tables, total = (customers > 0).astype(np.int64), np.zeros(len(customers), np.int64)
    few, crowd = np.flatnonzero((customers > 1) & (customers <= CROWD)), np.flatnonzero(customers > CROWD)
    seats = Seats(customers[few])
    for sweep in range(config.sweeps):
        all_ = (np.bincount(group, tables, len(scale)) * scale)[group]
        if len(crowd):
            tables[crowd] = seated(customers[crowd], (strength + discount * all_[crowd]) * p[crowd], discount, rng)
        others = np.maximum(strength + discount * (all_[few] - tables[few]), 0.0) * p[few]
        tables[few] = seats.sweep(others, discount * p[few], discount, rng)
        if sweep >= config.burn_in:
            total += tables
    return total


class Spelling:
    """log10 probabilities of symbols by quad, and of bytes by their class."""

    def __init__(self, quad_log: np.ndarray, byte_log: np.ndarray):
        self.quad_log, self.byte_log = quad_log, byte_log

    def log_probability(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        data = laid_out(words)
        each = self.quad_log[quads(data)].astype(np.float64) + self.byte_log[data]
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        return np.add.reduceat(each, np.cumsum(sizes) - sizes)


def fit_spelling(keys: np.ndarray, counts: np.ndarray, byte_counts: np.ndarray, config: HpyConfig = HpyConfig()) -> Spelling:
    """keys and counts: of quads. byte_counts: of bytes."""
    rng = np.random.default_rng(config.seed)
    shape = [(SYMBOLS,) * (k + 1) for k in range(ORDER)]
    leaves = np.zeros(SYMBOLS**ORDER, np.int64)
    leaves[keys] = counts
    leaves = leaves.reshape(shape[-1])
    # at first a table a dish
    customers = [leaves] * ORDER
    tables = [(leaves > 0).astype(np.int64)] * ORDER
    for k in range(ORDER - 2, -1, -1):
        customers[k] = tables[k + 1].sum(0)
        tables[k] = (customers[k] > 0).astype(np.int64)

    def predictive() -> list[np.ndarray]:
        parent, out = np.full(1, 1 / SYMBOLS), []
        for k in range(ORDER):
            d, theta = config.discounts[k], config.strength
            n, t = customers[k].sum(-1, keepdims=True), tables[k].sum(-1, keepdims=True)
            parent = (customers[k] - d * tables[k] + (theta + d * t) * parent) / (theta + n)
            out.append(parent)
        return out

    mean = np.zeros(shape[-1])
    for sweep in range(config.sweeps):
        now = predictive()
        for k in range(ORDER - 1, -1, -1):
            base = now[k - 1] if k else np.full(1, 1 / SYMBOLS)
            mass = np.broadcast_to((config.strength + config.discounts[k] * tables[k].sum(-1, keepdims=True)) * base, shape[k])
            flat = customers[k].ravel()
            some = np.flatnonzero(flat)
            t = np.zeros(len(flat), np.int64)
            t[some] = seated(flat[some], mass.reshape(-1)[some] if mass.flags.c_contiguous else mass.ravel()[some], config.discounts[k], rng)
            tables[k] = t.reshape(shape[k])
            if k:
                customers[k - 1] = tables[k].sum(0)
        if sweep >= config.burn_in:
            mean += predictive()[-1]
    mean /= config.sweeps - config.burn_in
    by_class = np.bincount(CLASSES, byte_counts + 1.0, SYMBOLS)
    byte_log = np.log10((byte_counts + 1.0) / by_class[CLASSES])
    byte_log[SPLIT] = 0.0
    return Spelling(np.log10(mean.ravel()).astype(np.float32), byte_log)
