"""Per-document text statistics in one pass over the text (part of problem 10)."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from math import log1p

# Common words by language.
COMMON = {
    "en": "the of and to in a is was were for with that on by at not from as be are or an had this who more their which they have we it has been but all one than those each other only so also both no per when where before after between our its about into out up there",
    "de": "der die das und in den von zu mit ist im für auf nicht eine ein als auch es an werden aus hat dass sie nach bei wurde wurden war waren wir sich dem des noch wie oder einer eines einem einen vor sind haben um zur zum über nur durch alle",
    "nl": "de het een van en in op te dat die niet zijn voor met was werd naar bij ook aan is er om als hebben waren werden wij ze door over uit maar nog dan tot of deze dit hun meer alle na heeft hadden had tussen wie wat",
    "fr": "le la les de des et un une du en dans que qui pour par sur est au avec pas plus ce ont été à ne sont aux nous ils elle il se sa son ses leur leurs ou mais cette ces été étaient était entre chez avant après tous toutes même",
}
LANGS = tuple(COMMON)
_SETS = {k: frozenset(v.split()) for k, v in COMMON.items()}
_ALL = frozenset().union(*_SETS.values())
_WORD = re.compile(r"[^\W\d_]+")
_END = (".", "!", "?", ":", "…", '."', ".”", ".'", '?"', ".)")
_MARK = re.compile(r"\s*(?:[-*•>–—·+]|\(?[0-9]{1,3}[.):]|\(?[a-zA-Z][.)]|[ivx]{1,5}[.)])\s+")
_NUMBERED = re.compile(r"\s*\w{1,5}\.\s")
_WIDE = re.compile(r"\S {3,}\S")
_SENTENCE = re.compile(r"[.!?][\"')”]*(?:\s|$)")
_BLANK = re.compile(r"\n[ \t\f]*\n")
#: Least share of common words by which a text tells its language.
TELLING = 0.2
VOWELS = "aeiouyäöüéèêëàâîïôûùåæáíóúãõ".encode("latin-1")

STATS = (
    "log_words", "mean_word_len", "symbol_ratio", "digit_ratio", "end_punct", "common_share", "log_unit_words",
    "log_sentence_words", "repetition", "cell_share", "mark_share", "single_share", "vowel_share",
)


def units(lines: list[str]) -> list[str]:
    """Lines with hard wraps undone: a line goes on in the next if the next's first word would not have fitted."""
    width = max(map(len, lines), default=0)
    if len(lines) < 3 or width > 140:
        return lines
    out, run = [], [lines[0]]
    for before, line in zip(lines, lines[1:]):
        head = line.split(None, 1)[0] if line.strip() else ""
        if len(before) + 1 + len(head) > width and not _MARK.match(line):
            run.append(line)
        else:
            out.append(" ".join(run))
            run = [line]
    out.append(" ".join(run))
    return out


def cell_share(lines: list[str]) -> float:
    """Share of lines that hold a table's row pattern: one delimiter, about equally often in most lines, short cells."""
    n = len(lines)
    if n < 3:
        return 0.0
    best = 0.0
    whole = "\n".join(lines)
    for mark in ("\t", "|", ";", ",", "&", "  "):
        total = whole.count(mark)
        if total < n or len(whole) > 30 * (total + n):
            continue
        if mark == "  ":  # columns by width: blank cells make the number of gaps vary
            best = max(best, sum(1 for x in lines if _WIDE.search(x.strip())) / n)
            continue
        found = [x.count(mark) for x in lines]
        per = Counter(c for c in found if c >= 2)
        if per:
            m = per.most_common(1)[0][0]
            best = max(best, (per[m - 1] * (m > 2) + per[m] + per[m + 1]) / n)
    return best


def text_stats(text: str | None) -> tuple:
    """(language, then STATS in order); an empty text has language None and zeros."""
    t = text or ""
    lines = [x.rstrip() for x in t.replace("\r\n", "\n").replace("\r", "\n").split("\n") if x.strip()]
    if not lines:
        return (None, *[0.0] * len(STATS))
    low = t.lower()
    words = _WORD.findall(low)
    nw = len(words)
    per = Counter(words)
    share = {k: sum(per[w] for w in s if w in per) for k, s in _SETS.items()}
    lang = max(LANGS, key=lambda k: share[k])
    hit = share[lang]
    n = len(t)
    flat = low.encode("latin-1", "replace")
    ink = max(1, n - (len(flat) - len(flat.translate(None, b" \n\t\r"))))
    alpha = sum(map(len, words))
    digits = len(flat) - len(flat.translate(None, b"0123456789"))
    us = lines
    if hit >= TELLING * nw and len(lines) > 2:
        us = [u for block in _BLANK.split(t.replace("\r\n", "\n").replace("\r", "\n")) for u in units([x.rstrip() for x in block.split("\n") if x.strip()])]
    ends = sum(u.rstrip().endswith(_END) for u in us) / len(us)
    marks = sum(1 for u in us if _MARK.match(u)) / len(us)
    sents = len(_SENTENCE.findall(t)) - sum(1 for u in us if _NUMBERED.match(u))
    tri = len({*zip(words, words[1:], words[2:])}) / max(1, nw - 2) if nw > 4 else 1.0
    packed = len(zlib.compress(flat, 1)) / len(flat)
    vowels = len(flat) - len(flat.translate(None, VOWELS))
    return (
        lang if hit >= TELLING * nw and nw else None,
        log1p(nw), alpha / max(1, nw), max(0, ink - alpha - digits) / ink, digits / ink, ends,
        hit / max(1, nw), log1p(nw / len(us)), log1p(nw / max(1, sents)),
        1.0 - min(tri, packed * 3.0), cell_share(lines), marks, sum(c for w, c in per.items() if len(w) == 1) / max(1, nw), vowels / max(1, alpha),
    )
