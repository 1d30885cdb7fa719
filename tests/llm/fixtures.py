"""Small documents with copies, near copies, shared passages and odd rows, and plain versions of what the operators count."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


def prose(rng: random.Random, n: int, words: list[str]) -> str:
    out = [rng.choice(words) for _ in range(n)]
    return " ".join(w + ("." if i % 9 == 8 else "") + ("\n" if i % 31 == 30 else "") for i, w in enumerate(out))


def corpus(seed: int = 1, n: int = 120) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(["ba", "ne", "ti", "ro", "lu", "sé", "mo", "ka"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    passage = prose(rng, 60, vocabulary)
    texts: list[str | None] = []
    for i in range(n):
        kind = i % 6
        if kind == 0 and texts and i > 20:
            texts.append(texts[rng.randrange(6)])
        elif kind == 1 and i > 20:
            own = (texts[1] or "").split(" ")
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own))
        elif kind == 2:
            texts.append(prose(rng, rng.randint(5, 40), vocabulary) + " " + passage)
        else:
            texts.append(prose(rng, rng.randint(40, 300), vocabulary))
    texts += [None, "", "  \n\t ", "Solo", "two words", "Two WORDS", "one two three four five", prose(rng, 6000, vocabulary)]
    langs = ["en", "fr", None]
    return [(i * 7 % 1009, t, langs[i % 3], "big" if i % 3 else f"s{i % 5}", len(t or "")) for i, t in enumerate(texts)]


def shingles(text: str | None) -> frozenset:
    words = WORDS((text or "").translate(FOLD))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def similar_classes(rows: list[tuple[int, str | None]]) -> dict[int, int]:
    """Smallest id reachable over links of 75 % or more, by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
