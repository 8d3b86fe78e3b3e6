"""Plain Python versions of the operators' contracts, for small tables."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def quality(t):
    w = WORD.findall(t)
    seen = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    cover = {j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover), failed)


def covered_chars(t, n):
    """Characters of words inside n-word windows found twice or more."""
    w = WORD.findall(t)
    seen = collections.Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    cover = {j for i in range(len(w) - n + 1) if seen[tuple(w[i:i + n])] > 1 for j in range(i, i + n)}
    return sum(len(w[j]) for j in cover)


def repetition(t):
    """(dup_line_chars, chars_5, chars_7, chars_10, kept) at the default shares."""
    n_words, chars, symbols, _, _, failed = quality(t)
    held = collections.Counter(x for x in t.split("\n") if WORD.search(x))
    dup = sum(k * sum(map(len, WORD.findall(x))) for x, k in held.items() if k > 1)
    inside = [covered_chars(t, n) for n in (5, 7, 10)]
    ok = dup <= 0.3 * chars and symbols <= 0.1 * n_words and all(c <= s * chars for c, s in zip(inside, (0.25, 0.22, 0.2)))
    return (dup, *inside, not failed and ok)


def chat(turns):
    """(n_turns, turns digest, characters and digest under the loss mask, formatted characters) of (role, text) turns."""
    def escape(s):
        return s.replace("\\", "\\\\").replace("### ", "\\h").replace("</turn>", "\\t")
    learned = "".join(t for r, t in turns if r == "assistant")
    formatted = "".join(f"### {escape(r)}\n{escape(t)}</turn>\n" for r, t in turns)
    return (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned), len(formatted))


def lines(rows):
    def key(x):
        return x.strip(" \t\n\x0b\x0c\r").translate(LOW)
    held = collections.defaultdict(set)
    for d, t in rows:
        for x in t.split("\n"):
            if len(key(x)) >= 10:
                held[key(x)].add(d)
    out = []
    for d, t in rows:
        ls = t.split("\n")
        keep = [x for x in ls if not (len(key(x)) >= 10 and len(held[key(x)]) > 1 and min(held[key(x)]) != d)]
        out.append((d, len(ls), len(ls) - len(keep), sha("\n".join(keep))))
    return sorted(out)


def jaccard(rows):
    sets = {}
    for d, t in rows:
        w = WORD.findall(t.translate(LOW))
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    order = sorted(sets)
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            k = len(sets[a] & sets[b])
            if k and 100 * k >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((d, len(sets[d]), find(d)) for d in sets)


def repeats(rows, width=50):
    out, seen = [], set()
    for d, t in sorted((d, t.encode()) for d, t in rows):
        mask, own = bytearray(len(t)), [t[i:i + width] for i in range(len(t) - width + 1)]
        for i, w in enumerate(own):
            if w in seen:
                mask[i:i + width] = b"\1" * width
        seen.update(own)
        runs = sum(1 for i in range(len(mask)) if mask[i] and (i == 0 or not mask[i - 1]))
        out.append((d, len(t), sum(mask), runs, sha(bytes(c for c, m in zip(t, mask) if not m))))
    return sorted(out)


def luhn(d):
    return sum(n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n) for i, n in enumerate(map(int, reversed(d)))) % 10 == 0


def personal(t):
    o = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    o += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub(r"[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            o.append(("card", m))
    o += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in o)


def secrets(t):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    o = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(t) if len(m[2]) >= 12]
    o += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    o += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    return ",".join(f"{k}:{a}:{z}" for a, _, k, z in sorted(o))
