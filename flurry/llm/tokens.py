"""Byte-level BPE of whole blocks of documents.

The tokenizer's own split pattern is evaluated as array operations over code
points; each distinct piece is then encoded once and remembered. Documents with code points outside the
array tables go through the tokenizer itself.
"""

from __future__ import annotations

import array
import functools
import json
import unicodedata

import numpy as np
import tiktoken
from tokenizers import Tokenizer

from flurry.llm import blocks as B

OTHER, LETTER, NUMBER, BLANK, RARE = range(5)
TABLE = 0x3000
REMEMBER = 700_000  # distinct pieces kept per worker; then the memory starts anew

# white space of the split pattern
BLANKS = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F]


@functools.lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    out = np.full(TABLE + 1, RARE, np.uint8)
    for c in range(TABLE):
        cat = unicodedata.category(chr(c))
        out[c] = RARE if cat in ("Cn", "Cs") else LETTER if cat[0] == "L" else NUMBER if cat[0] == "N" else OTHER
    out[BLANKS] = BLANK
    return out


@functools.lru_cache(maxsize=1)
def _byte_letters() -> list[str]:
    """The printable letter that byte-level BPE writes for each byte: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 0
    for b in range(256):
        out.append(chr(b) if b in plain else chr(256 + extra))
        extra += b not in plain
    return out


_values = np.random.default_rng(7).integers(1, 1 << 63, TABLE + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class PretokenBpe:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.merge = self._merger(json.loads(self.tokenizer.to_str())["model"])
        self._forget()

    @staticmethod
    @functools.lru_cache(maxsize=2)
    def load(path: str) -> PretokenBpe:
        return PretokenBpe(path)

    @staticmethod
    def _merger(model: dict):
        """Encoder of one piece's bytes. Where the merges stand in the order of
        their ids, ranks alone define the encoding."""
        byte = {letter: b for b, letter in enumerate(_byte_letters())}
        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [vocab[a + b] for a, b in pairs]
        if made != sorted(set(made)):
            raise ValueError("the tokenizer's merges are not in the order of their ids")
        tokens = {*byte, *(a + b for a, b in pairs)}
        ranks = {bytes(byte[c] for c in t): vocab[t] for t in tokens}
        return tiktoken.Encoding("pieces", pat_str=".+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.starts, self.flat = array.array("q", [0]), array.array("I")

    def _learn(self, piece: str) -> int:
        self.flat.extend(self.merge(piece.encode()))
        self.starts.append(len(self.flat))
        return len(self.starts) - 2

    @staticmethod
    def _starts(cps: np.ndarray, kind: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Where pieces of the split pattern begin (mask over code points)."""
        n = len(cps)
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        start = np.ones(n, bool)
        start[1:] = (kind[1:] != kind[:-1]) | edge[1:n]
        run = np.flatnonzero(start)
        end = np.append(run[1:], n)
        # white space: the last blank of a run before other text is cut off;
        # if it is a plain space it leads the next piece
        b = np.flatnonzero((kind[run] == BLANK) & ~edge[end])
        last = end[b] - 1
        start[last] = True
        lead = last[cps[last] == 32]
        start[lead + 1] = False
        # contractions: a lone apostrophe that begins a piece takes s t m d / re ve ll
        q = np.flatnonzero((cps[run] == 39) & (end - run == 1))
        q = run[q]
        q = q[start[q] & (q + 1 < n)]
        q = q[(kind[q + 1] == LETTER) & ~edge[q + 1]]
        if len(q):
            a = cps[q + 1]
            two = np.where((q + 2 < n) & ~edge[np.minimum(q + 2, n)], cps[np.minimum(q + 2, n - 1)], 0)
            take = np.where(np.isin(a, [115, 116, 109, 100]), 1,
                            np.where(((a == 114) | (a == 118)) & (two == 101) | (a == 108) & (two == 108), 2, 0))
            q, take = q[take > 0], take[take > 0]
            start[q + 1] = False
            after = q + 1 + take
            ok = after < n
            after = after[ok]
            start[after[kind[after] == LETTER]] = True
            # (a following run of another kind begins a piece of its own anyway)
        return start

    def encode_block(self, raw: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        """Token ids of each document of a block."""
        text = raw.tobytes().decode("utf-8")
        cps = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        off = heads[off]
        small = np.minimum(cps, TABLE)
        kind = _kinds()[small]
        n_docs = len(off) - 1
        rare = np.diff(np.concatenate([[0], np.cumsum(kind == RARE)])[off]) > 0
        if not len(cps):
            return [np.zeros(0, np.uint32)] * n_docs
        first = np.flatnonzero(self._starts(cps, kind, off))
        end = np.append(first[1:], len(cps))
        up, down = B.powers(len(cps) + 1)
        prefix = np.zeros(len(cps) + 1, np.uint64)
        np.cumsum(_values[small] * up[:len(cps)], out=prefix[1:])
        h = B.mix((prefix[end] - prefix[first]) * down[first] + (end - first).astype(np.uint64))
        # the index of each distinct piece in the worker's memory
        _, where, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) > REMEMBER:
            self._forget()
        known = self.known
        keys, x, y = h[where].tolist(), first[where].tolist(), end[where].tolist()
        at = [known.get(k, -1) for k in keys]
        for i, found in enumerate(at):
            if found < 0:
                at[i] = known[keys[i]] = self._learn(text[x[i]:y[i]])
        starts, flat = np.array(self.starts), np.array(self.flat)
        slot = np.asarray(at, np.int64)[inverse]
        size = starts[slot + 1] - starts[slot]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = flat[np.arange(upto[-1]) + np.repeat(starts[slot] - upto[:-1], size)]
        cut = upto[np.searchsorted(first, off)]
        out = [ids[cut[i]:cut[i + 1]] for i in range(n_docs)]
        for i in np.flatnonzero(rare).tolist():
            whole = self.tokenizer.encode(text[off[i]:off[i + 1]], add_special_tokens=False)
            out[i] = np.asarray(whole.ids, np.uint32)
        return out
