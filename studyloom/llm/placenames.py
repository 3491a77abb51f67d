"""Comparable forms of typed place names and the exact check of a candidate (part of problem 5)."""

from __future__ import annotations

import re
import unicodedata

# What short forms of descriptive words stand for.
SHORT = {
    "st": "saint", "ste": "saint", "is": "islands", "isl": "islands", "isls": "islands", "island": "islands", "n": "north", "northern": "north",
    "s": "south", "southern": "south", "e": "east", "eastern": "east", "w": "west", "western": "west", "rep": "republic", "repub": "republic",
    "dem": "democratic", "ppl": "peoples", "prov": "province", "reg": "region", "metropolitan": "greater", "metro": "greater", "kgdm": "kingdom", "king": "kingdom",
    "gr": "greater", "gtr": "greater",
}
#: Words without weight in a name.
LIGHT = frozenset({"the", "of", "and", "s"})
# Remarks that people put around a name.
REMARK = re.compile(
    r"\([^()]*\d[^()]*\)|\[[^\[\]]*\]|\((?:and|or|see|incl|mainly|partly|parts|only|pilot|since|until|from|formerly|planned|tbc)\b[^()]*\)"
    r"|^\s*(?:mainly|mostly|partly|parts? of|part of|in|within|incl\.?|including|also|and|e\.g\.|especially|chiefly|from|across|all of|most of|rural|urban|centres? in|sites? in)\s+(?!the above)"
    r"|\s+(?:only|mainly|mostly|etc\.?|and others|sites?|\(mainly\)|\(partly\)|\(parts?\)|\(part of\)|\(only\))\s*$|[?*†‡!]+|\d+\s+sites?\b",
    re.I,
)
NOTHING = re.compile(r"^(?:see .*|all of the above|overseas|unknown|n/?a|none|various|other|several|multiple|tbd|tbc|not (?:known|stated|applicable).*|as above|-+)$")
_WORD = re.compile(r"[^\W_]+")


def plain(text: str) -> str:
    t = unicodedata.normalize("NFKD", text.replace("ß", "ss").replace("ø", "o").replace("Ø", "O").replace("ł", "l"))
    return "".join(c for c in t if not unicodedata.combining(c)).lower()


def letters(text: str) -> str:
    """Codes and acronyms compare by their letters and digits."""
    return "".join(_WORD.findall(plain(text)))


def words_of(text: str) -> list[str]:
    t = plain(text).replace("&", " and ").replace("’", "'").replace("'s", "s")
    out = []
    for w in _WORD.findall(t):
        w = SHORT.get(w, w)
        if w not in LIGHT:
            out.append(w)
    return out


def forms(value: str) -> list[str]:
    """Readings of a typed value, best first: as written, then without remarks; "" words of a value that names nothing."""
    out: list[str] = []
    text = value
    for _ in range(3):
        if NOTHING.match(plain(text).strip()):
            break
        w = " ".join(sorted(words_of(text)))
        if w and w not in out:
            out.append(w)
        shorter = REMARK.sub(" ", text).strip(" .,;:-")
        if shorter == text or not shorter:
            break
        text = shorter
    if "," in value and not NOTHING.match(plain(value).strip()):  # a comma typed into a word
        w = " ".join(sorted(words_of(text.replace(",", ""))))
        if w and w not in out:
            out.append(w)
    return out


def grams(form: str) -> list[str]:
    """Distinct padded letter pairs of every word of a form."""
    return sorted({p[i : i + 2] for w in form.split() for p in [f"^{w}$"] for i in range(len(p) - 1)})


def within(a: str, b: str, limit: int) -> int:
    """Edit distance with neighbour swaps; limit + 1 if greater."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    before: list[int] = []
    last, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, last, row = last, row, [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > limit:
            return limit + 1
    return row[-1]


def allowed(word: str) -> int:
    n = len(word)
    return 0 if n < 4 else 1 if n < 9 else 2


def edits(a: str, b: str) -> int:
    """Edits between two forms whose words pair off one to one, each within its limit; -1 if they do not."""
    x, y = a.split(), b.split()
    if len(x) != len(y):
        if letters(a) == letters(b):
            return 1
        p, q = "".join(x), "".join(y)  # a space typed into or left out of a name
        return 1 if abs(len(x) - len(y)) == 1 and p == q else -1
    total = 0
    left = list(y)
    rest = []
    for w in x:
        if w in left:
            left.remove(w)
        else:
            rest.append(w)
    for w in rest:
        best = min(((within(w, v, 2), v) for v in left), default=(9, ""))
        if best[0] > min(allowed(w), allowed(best[1])) or best[0] > 2:
            return -1
        left.remove(best[1])
        total += best[0]
    return total
