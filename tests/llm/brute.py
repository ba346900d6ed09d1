"""The same results one text after the other, without Spark, and rows with every oddity at once."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import Row

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = "abcdefghijklmnopqrstuvwxyzäéß"


def odd_rows(seed: int = 3) -> list[Row]:
    """Null ids and texts, empty and very long texts, equal rows, equal ids, copies, near copies, shared passages."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice(LETTERS) for _ in range(rnd.randint(1, 8)))
    line = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    passage = line(60)
    base = "\n".join(line(30) for _ in range(4))
    texts: list[tuple[int | None, str | None]] = [(1, None), (2, ""), (None, base), (None, None), (3, " \t\n\r\n "), (4, "One."), (5, "\n\n\n")]
    for i in range(10, 40):
        texts.append((i, "\n".join([line(rnd.randint(1, 40)), passage if i % 3 == 0 else line(9), line(20)])))
    for i in range(50, 62):
        words = base.split(" ")
        if i % 2:
            words[rnd.randrange(len(words))] = word()
        texts.append((i, " ".join(words)))
    one = line(25)
    for i in range(70, 84):  # lines that differ by one character, or two
        at = rnd.randrange(1, len(one) - 2)
        edit = rnd.choice([one[:at] + "#" + one[at + 1 :], one[:at] + one[at + 1 :], one[:at] + "ü" + one[at:], one[:at] + "xy" + one[at + 1 :]])
        texts.append((i, f"{line(12)}\n{edit}\n{line(3)}"))
    texts += [(90, base.upper()), (91, base.replace(" ", "  ")), (92, base), (92, base), (93, base), (93, line(30)), (-5, passage), (1 << 40, passage)]
    texts += [(100, " ".join(word() for _ in range(40_000)) + " " + passage), (101, "x" * 200_000), (102, "ab" * 60_000), (103, "a b " * 3000)]
    texts += [(104, "é" * 400), (105, "日本語 " * 80), (106, "<|endoftext|> it's  a\n \n test   of\ttokens 123 '' \x1c \x85!!")]
    rnd.shuffle(texts)
    extra = ("block", "bucket", "rest", "d", "r", "p", "lines", "size", "features", "key", "a", "b", "part", "ids", "file", "token")
    rows = [Row(doc_id=i, text=t, lang=rnd.choice(["en", None]), source=f"s{k % 3}", n_chars=len(t or ""), **{c: rnd.choice([k, None]) for c in extra}) for k, (i, t) in enumerate(texts)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` long" for c in ("block", "bucket", "rest", "d", "r", "p", "lines", "size", "features", "key", "a", "b", "part", "ids", "file", "token"))


def sha(x: bytes | str) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def spans(covered) -> list[tuple[int, int]]:
    out, begin = [], None
    for i, c in enumerate([*covered, 0]):
        if c and begin is None:
            begin = i
        elif not c and begin is not None:
            out.append((begin, i))
            begin = None
    return out


def repeated_bytes(rows, length: int = 50) -> list[tuple]:
    """(doc_id, text bytes, spans) per row."""
    least: dict[bytes, int] = {}
    for i, t in rows:
        if i is not None:
            b = (t or "").encode()
            for w in {b[p : p + length] for p in range(len(b) - length + 1)}:
                least[w] = min(i, least.get(w, i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        cover = bytearray(len(b))
        if i is not None:
            for p in range(len(b) - length + 1):
                if least[b[p : p + length]] < i:
                    cover[p : p + length] = b"\1" * length
        out.append((i, b, spans(cover)))
    return out


def without(b: bytes, cut: list[tuple[int, int]]) -> bytes:
    out, at = b"", 0
    for lo, hi in cut:
        out += b[at:lo]
        at = hi
    return out + b[at:]


def whole_characters(b: bytes, cut: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out = []
    for lo, hi in cut:
        while lo < len(b) and b[lo] & 0xC0 == 0x80:
            lo += 1
        while hi < len(b) and b[hi] & 0xC0 == 0x80:
            hi -= 1
        if lo < hi:
            out.append((lo, hi))
    return out


def repeated_words(rows, length: int = 35) -> list[tuple]:
    """(doc_id, words, flags) per row."""
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    count = Counter(tuple(w[k : k + length]) for _, w in texts for k in range(len(w) - length + 1))
    out = []
    for i, w in texts:
        cover = [0] * len(w)
        for k in range(len(w) - length + 1):
            if count[tuple(w[k : k + length])] > 1:
                cover[k : k + length] = [1] * length
        out.append((i, w, cover))
    return out


def lower(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def shingles(t: str | None, n: int) -> set:
    w = WORD.findall(lower(t or ""))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def jaccard_groups(rows, n: int, percent: int) -> list[tuple]:
    """(doc_id, set size, component) per row."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = [(i, s) for i, s in sets if i is not None and s]
    for k, (i, s) in enumerate(known):
        for j, t in known[:k]:
            if 100 * len(s & t) >= percent * len(s | t):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [(i, len(s), None if i is None else find(i)) for i, s in sets]


def within_one(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def kept_lines(rows, min_chars: int = 32) -> list[tuple]:
    """(doc_id, lines, kept places) per row. Short lines with a word go for equality alone."""

    def place(i, t, p):
        return (-(1 << 63) if i is None else i, xxhash.xxh64_intdigest(t.encode(), 42) - (1 << 64) * (xxhash.xxh64_intdigest(t.encode(), 42) >= 1 << 63), p)

    texts = [(i, t or "") for i, t in rows]
    first: dict[str, tuple] = {}
    for i, t in texts:
        for p, x in enumerate(t.split("\n")):
            if len(x) >= min_chars or WORD.search(x):
                first[x] = min(first.get(x, place(i, t, p)), place(i, t, p))
    by_length = defaultdict(list)
    for x in first:
        if len(x) >= min_chars:
            by_length[len(x)].append(x)
    gone = {at for x, at in first.items() if len(x) >= min_chars for n in (-1, 0, 1) for y in by_length[len(x) + n] if first[y] < at and within_one(x, y)}
    stays = set(first.values()) - gone
    return [(i, t.split("\n"), [p for p, x in enumerate(t.split("\n")) if x not in first or place(i, t, p) in stays]) for i, t in texts]


def base_counts(t: str | None, repeat: int = 5) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = t or ""
    w = WORD.findall(t)
    count = Counter(tuple(w[k : k + repeat]) for k in range(len(w) - repeat + 1))
    cover = [0] * len(w)
    for k in range(len(w) - repeat + 1):
        if count[tuple(w[k : k + repeat])] > 1:
            cover[k : k + repeat] = [1] * repeat
    seen, dup = set(), 0
    for x in t.split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, sum(cover)
