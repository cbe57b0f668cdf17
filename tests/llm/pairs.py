"""Near duplicates by comparison of all pairs, and texts to try them on."""

from __future__ import annotations

import random
import re


def words(seed, count, letters="abcdefgh"):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(count)]


def edited(base, rng, count):
    out = list(base)
    for _ in range(count):
        out[rng.randrange(len(out))] = f"w{rng.randrange(40)}"
    return " ".join(out)


def shingles(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def expected(rows, percent):
    """(doc_id, set size, component, kept) that every row must get."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if label[a] != label[b] and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [j for m, (j, _) in enumerate(rows) if label[m] == label[k] and j is not None]
        component = (min(ids) if ids else None) if sets[k] else i
        out.append((i, len(sets[k]), component, i == component))
    return out


def odd_rows():
    """Nulls, empty texts, copies, one id over several texts and several rows without id."""
    rng = random.Random(4)
    rows = [(k, edited(words(k % 6, 220), rng, rng.randint(0, 12))) for k in range(150)]
    rows += [(200 + k, edited(words(77, 60 + k % 9), rng, rng.randint(0, 2))) for k in range(40)]
    base = words(5, 90)
    rows += [(300, None), (301, ""), (302, " \t\n"), (303, "One two"), (304, "one  TWO"), (305, "two one"), (306, "É é"), (307, "é é")]
    rows += [(None, " ".join(words(50, 80))), (None, " ".join(words(51, 80))), (None, None), (400, " ".join(words(51, 80)))]
    rows += [(None, edited(words(50, 80), rng, 1)), (None, " ".join(base)), (500, " ".join(base)), (7, " ".join(words(60, 70)))]
    rows += [(7, edited(words(61, 70), rng, 1)), (410, " ".join(words(60, 70))), (411, " ".join(words(61, 70)))]
    rows += [rows[3], rows[3]] + [(600 + k, rows[9][1]) for k in range(90)]
    return rows
