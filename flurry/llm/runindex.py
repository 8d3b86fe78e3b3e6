"""Run-length compressed text index (r-index) over many short byte strings.

The Burrows-Wheeler transform of the strings is kept as runs (character,
first row, earlier rows of the same character) with the text position of
every run's first and last row. Matching statistics of any number of query
strings are streamed from their right ends to their left ends in lock step,
one vectorised step for all of them.
"""

from __future__ import annotations

import numpy as np

PACK = 7  # symbols of nine bits in one sort key
FIRST = np.array([((1 << 9 * m) - 1) << 9 * (PACK - m) for m in range(PACK + 1)], np.int64)  # a key's first m symbols


def _ranks(key: np.ndarray) -> np.ndarray:
    """Place of every key among the distinct keys."""
    order = np.argsort(key)
    key = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(np.concatenate([[False], key[1:] != key[:-1]]))
    return rank


def suffix_array(sym: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of concatenated strings in order (0 ends a string, equal suffixes
    by position), and which of them begin with the same ``width`` symbols as the one before."""
    n = len(sym)
    pos = np.arange(n)
    ends = np.flatnonzero(sym == 0)
    stop = np.repeat(ends, np.diff(ends, prepend=-1))
    rank = _ranks(packed(sym) & FIRST[np.minimum(stop - pos + 1, PACK)])
    depth, longest, near, known = PACK, int((stop - pos).max()) + 1, rank, PACK
    while depth < longest:
        if depth <= width:
            near, known = rank, depth  # width <= 2 * known: two look-ups cover the width
        at = pos + depth
        nxt = np.where(at <= stop, rank[np.minimum(at, n - 1)] + 1, 0)
        rank = _ranks(rank * (n + 2) + nxt)
        depth *= 2
    sa = np.sort(rank * n + pos) % n
    second = near[np.minimum(sa + width - known, n - 1)]
    first = near[sa]
    return sa, (first[1:] == first[:-1]) & (second[1:] == second[:-1])


class RunIndex:
    """Index of strings given as symbols (byte + 1) with a 0 after each."""

    def __init__(self, sym: np.ndarray, sa: np.ndarray):
        self.packed = packed(sym)
        bwt = sym[sa - 1]
        head = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]]))
        self.head, self.char = head, bwt[head].astype(np.int64)
        last = np.append(head[1:], len(sa)) - 1
        self.first_at, self.last_at = sa[head], sa[last]  # sampled run ends
        size = last - head + 1
        order = np.argsort(self.char, kind="stable")
        upto = np.cumsum(size[order]) - size[order]
        self.lf = np.empty(len(head), np.int64)  # row reached from a run's first row
        self.lf[order] = upto
        self.by_char = self.char[order] * (len(head) + 1) + order  # runs of each character, in order
        self.order = order
        self.rows = len(sa)

    def matches(self, query: np.ndarray, packs: np.ndarray, begin: np.ndarray, end: np.ndarray, cap: int):
        """Stream matching statistics: yields (rows of the batch, query position, length, place).

        ``length`` (at most ``cap``) is the longest match of the query from
        that position with the index, ``place`` one text position of it.
        """
        k = len(begin)
        row, length = np.zeros(k, np.int64), np.zeros(k, np.int64)
        place = np.full(k, self.first_at[0])
        at = end - 1
        live = np.flatnonzero(at >= begin)
        while len(live):
            i, c = at[live], query[at[live]]
            run = np.searchsorted(self.head, row[live], "right") - 1
            same = self.char[run] == c
            off = np.flatnonzero(~same)
            if len(off):
                r, ch, w = run[off], c[off], live[off]
                slot = np.searchsorted(self.by_char, ch * (len(self.head) + 1) + r)
                best = np.full(len(off), -1, np.int64)
                to_row, to_run, to_place = (np.zeros(len(off), np.int64) for _ in range(3))
                for s, lower in ((slot - 1, True), (slot, False)):
                    t = np.clip(s, 0, len(self.order) - 1)
                    g = self.order[t]
                    ok = (s >= 0) & (s < len(self.order)) & (self.char[g] == ch)
                    p = self.last_at[g] if lower else self.first_at[g]
                    n = self._common(p, packs, i[off] + 1, np.minimum(length[w], end[w] - i[off] - 1))
                    n = np.where(ok, n, -1)
                    better = n > best
                    best = np.where(better, n, best)
                    to_run = np.where(better, g, to_run)
                    to_place = np.where(better, p, to_place)
                    far = np.append(self.head[1:], self.rows)[g] - 1 if lower else self.head[g]
                    to_row = np.where(better, far, to_row)
                found = best >= 0
                length[w] = best  # -1: the character does not occur, the match is empty
                row[w[found]], place[w[found]] = to_row[found], to_place[found]
                run[off[found]] = to_run[found]
                same[off[found]] = True
            go = live[same]
            row[go] = self.lf[run[same]] + row[go] - self.head[run[same]]
            place[go] -= 1
            length[go] = np.minimum(length[go] + 1, cap)
            length[live[~same]] = 0
            at[live] -= 1
            yield live, i, length[live], place[live]
            live = live[at[live] >= begin[live]]

    def _common(self, p: np.ndarray, query: np.ndarray, q: np.ndarray, limit: np.ndarray) -> np.ndarray:
        return common_prefix(self.packed, p, query, q, limit)


def packed(sym: np.ndarray) -> np.ndarray:
    """The PACK symbols from every place on in one number (0 past the end)."""
    long = np.concatenate([sym, np.zeros(PACK, np.int64)])
    out = np.zeros(len(sym), np.int64)
    for i in range(PACK):
        out = (out << 9) | long[i:i + len(sym)]
    return out


def common_prefix(text: np.ndarray, p: np.ndarray, query: np.ndarray, q: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Length of the common prefix of two packed texts from p and q on, at most limit."""
    n = np.zeros(len(p), np.int64)
    todo = np.flatnonzero(limit > 0)
    while len(todo):
        x = n[todo]
        at, to = p[todo] + x, q[todo] + x
        differ = text[np.minimum(at, len(text) - 1)] ^ query[np.minimum(to, len(query) - 1)]
        differ[at >= len(text)] = 1 << 62
        # the first differing symbol from the highest differing bit
        _, top = np.frexp(differ.astype(np.float64))
        n[todo] += np.where(differ == 0, PACK, (9 * PACK - top) // 9)
        todo = todo[(differ == 0) & (n[todo] < limit[todo])]
    return np.minimum(n, limit)


def covered_windows(texts: list[bytes], group: np.ndarray, owner: np.ndarray, width: int) -> list[np.ndarray]:
    """For each text, the starts of its ``width``-byte strings that also occur in a text of a smaller owner."""
    size = np.array([len(t) for t in texts], np.int64)
    text, start = covered_starts(np.frombuffer(b"".join(texts), np.uint8), size, group, owner, width)
    return np.split(start, np.searchsorted(text, np.arange(1, len(texts))))


def covered_starts(raw: np.ndarray, size: np.ndarray, group: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, start), in order, of the ``width``-byte strings that also occur in a text of a smaller owner.

    Texts (their bytes and sizes) come sorted by (group, owner). All of them are indexed once; the
    texts that have an earlier owner in their group are streamed through the
    index. Where the matching statistic reaches ``width``, its place leads to
    the class of the suffixes that begin with this string, and the string is
    marked if the smallest owner in the class comes before the text's own.
    """
    n = len(size)
    leader = np.repeat(owner[heads := np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))],
                       np.diff(np.append(heads, n)))
    ask = np.flatnonzero((owner > leader) & (size >= width))
    if not len(ask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = np.cumsum(size + 1) - size - 1
    sym = np.zeros(len(raw) + n, np.int64)   # 0 ends a text
    sym[np.arange(len(raw)) + np.repeat(np.arange(n), size)] = raw
    sym += 1
    sym[begin + size] = 0
    sa, alike = suffix_array(sym, width)
    edge = np.flatnonzero(np.concatenate([[True], ~alike]))
    text = np.repeat(np.arange(n), size + 1)
    least = np.empty(len(sym), np.int64)  # by text position: smallest owner of its class
    least[sa] = np.repeat(np.minimum.reduceat(owner[text[sa]], edge), np.diff(np.append(edge, len(sa))))
    index, hit = RunIndex(sym, sa), np.zeros(len(sym), bool)
    for rows, i, length, place in index.matches(sym, index.packed, begin[ask], begin[ask] + size[ask], width):
        long = np.flatnonzero(length >= width)
        hit[i[long[least[place[long]] < owner[ask[rows[long]]]]]] = True
    at = np.flatnonzero(hit)
    return text[at], at - begin[text[at]]
