"""Conversations repaired and laid into a trie one after the other, without Spark."""

from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict

from brute import sha

WORDY = re.compile(r"[^\x20\x09-\x0D]")
MOVES = {"": 0, "s": 1}


def odd_turns(seed: int = 5) -> list[tuple]:
    """(conv_id, turn, role, text): nulls in any column, equal turns, repeated rows, gaps, odd roles, shared fronts."""
    rnd = random.Random(seed)
    texts = ["Hello.", "Hello", "", "  \t\n", "What?\n", "Fine!  \n", "x" * 50, "Ünïcode…", "a.b", ".", "Tell me.", None, "q" * 200_000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "sys", "u", "assistant", "user", "user", "assistant"]
    rows = []
    for c in [*range(-7, 40), 99, 1 << 40, None]:
        for t in range(rnd.randint(1, 14)):
            turn = None if rnd.random() < 0.05 else t + (rnd.random() < 0.1) * 3 - 2
            good = rnd.random() < 0.5
            rows.append((c, turn, ("user", "assistant")[t % 2] if good else rnd.choice(roles), f"Turn {t}." if good else rnd.choice(texts[:-1])))
        if c is not None and c % 5 and rnd.random() < 0.6:
            base = [r for r in rows if r[0] == c - c % 5]
            rows += [(c, *r[1:]) for r in base[: rnd.randint(0, len(base))]]
    rows += [(50, t, ("user", "assistant")[t % 2], texts[-1] if t == 3 else f"{t % 7} is said.") for t in range(90)]
    rows += [(51, None, None, None)] * 4 + [(52, 3, "user", "Same.")] * 5
    rnd.shuffle(rows)
    return rows


def _ordered(rows, missing: str):
    """By conversation: (turn, role, text), nulls first, ties by role and digest of the text."""
    out = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = (missing if x is None else x for x in (role, text))
        out[c].append((turn, role, text))
    for c in out:
        out[c].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha(f"{len(r[2])}:{r[2]}")))
    return out


def damaged(rows):
    out = {}
    for c, turns in _ordered(rows, " ").items():
        mine = []
        for turn, role, text in turns:
            hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if hit == 0:
                continue
            if hit == 1:
                text = ""
            if hit == 2:
                text = re.sub("[.!?]", "", text)
            if hit == 4:
                role = "user"
            mine.append((turn, role, text))
            if hit == 3:
                mine.append((turn, role, text))
        # equal rows stand together: a repeated row follows its original, whatever else has the turn
        out[c] = mine
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        chars = WORDY.findall(text)
        if not chars:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if chars[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, told):
    """(cost, letters, lines) by a full table over rows and what was put out last, strings and all."""
    best = {"": (0, "", ())}

    def better(table, key, way):
        if key not in table or way[:2] < table[key][:2]:
            table[key] = way

    def inserts(table):
        for _ in range(2):
            for state, (cost, letters, lines) in list(table.items()):
                new = "a" if state == "u" else "u"
                better(table, new, (cost + 3, letters + "I", (*lines, f"{'assistant' if new == 'a' else 'user'}:")))

    for (_, role, text), fault in zip(rows, told, strict=True):
        ways = []
        for state, way in best.items():  # before a row, all numbers of inserted turns
            for _ in range(3):
                ways.append((state, way))
                state = "a" if state == "u" else "u"
                way = (way[0] + 3, way[1] + "I", (*way[2], f"{'assistant' if state == 'a' else 'user'}:"))
        after = {}
        for state, (cost, letters, lines) in ways:
            better(after, state, (cost + 4, letters + "D", lines))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                new = "a" if state == "u" else "u"
                better(after, new, (cost + 3 + more, letters + "R", (*lines, f"{'assistant' if new == 'a' else 'user'}:{text}")))
                first = role[:1]
                if first in "sua" and first and state + first in ("s", "u", "su", "ua", "au"):
                    better(after, first, (cost + more, letters + "K", (*lines, f"{role}:{text}")))
        best = after
    inserts(best)
    return min((best[s] for s in ("", "a") if s in best), key=lambda w: w[:2])


def repaired(rows):
    out = []
    for c, mine in damaged(rows).items():
        told = faults(mine)
        cost, letters, lines = cheapest(mine, told)
        turns = [t for t, _, _ in mine if t is not None]
        firsts = [r[:1] for _, r, _ in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((c, gaps, told.count("blank"), told.count("duplicate"), told.count("truncated"), illegal, cost, letters, sha("\n".join(lines))))
    return out


def trie(rows):
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    turns = {c: [r[1:] for r in mine] for c, mine in _ordered([r for r in rows if r[0] is not None], "").items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = tuple(turns.get(base, [])[:h]) + tuple(own[h:])
    members = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    def subtree(path):
        yield path
        for x in children[path]:
            yield from subtree(x)

    out = []
    for path, convs in members.items():
        inner = list(subtree(path))
        out.append((
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(children[path]), sum(not children[x] for x in inner),
            sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in inner if x), sha(",".join(map(str, sorted(c for c in convs if built[c] == path)))),
        ))
    return out
