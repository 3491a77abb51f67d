"""Lines of a paper: page furniture, blocks of running text, broken words, misread words, reflow (part of problem 6)."""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

from studyloom.llm.lexicon import Lexicon
from studyloom.llm.placenames import within

HYPHENS = "-‐¬­"
_NUM = r"[0-9OolI!]{1,4}|[ivxlIVXL]{1,7}"
_PAGE = re.compile(rf"^\W*(?:p[ao]g[ec]\W*)?(?:{_NUM})(?:\s*(?:of|oi|0f|/)\s*(?:{_NUM}))?\W*$", re.I)
_PAGED = re.compile(rf"^(?:(?:{_NUM})(?:\s{{2,}}|\s*[|–—]\s*)(?P<a>.+)|(?P<b>.+?)(?:\s{{2,}}|\s*[|–—]\s*)(?:{_NUM}))$")
_ROMAN = re.compile(r"^[\s\-–—]*[ivxl]{1,7}[\s\-–—]*$")
_RIGHTS = re.compile(r"©|all rights? r[ec]s[ec]rv[ec]d", re.I)
_ROW = re.compile(r"^(?:\S+(?: \S+){0,3})?(?:(?:^|\s{2,}|\t)[\d.,()%<>=\-–/ ]+)+$")
_HEADING = re.compile(r"^(?:\d{1,2}(?:\.\d{1,2})*\.?\s+)?[A-Z][^.!?]{2,60}$")
_DIGITS = re.compile(r"\d+")
EDGE = ".,;:()[]\"'“”‘’?"
KEPT = 30_000  # tokens whose forms are remembered: the frequent ones, at any size of the corpus


def split_lines(text: str) -> list[str]:
    return [x.rstrip("\r") for x in text.split("\n")]


def _bare(line: str) -> tuple[str, bool]:
    """(line without page number, whether it had one)."""
    s = line.strip()
    # A page number stands behind a bar or dash or a wide gap (white space but single blanks does not print).
    if ("  " in s or "|" in s or "–" in s or "—" in s or not s.isprintable()) and (m := _PAGED.match(s)):
        return (m.group("a") or m.group("b")).strip(), True
    return s, False


def _alike(a: str, b: str) -> bool:
    if a == b:
        return True
    if abs(len(a) - len(b)) > 2 or min(len(a), len(b)) < 6 or (a[:3] != b[:3] and a[-3:] != b[-3:]):
        return False
    return within(a, b, max(2, len(a) // 14)) <= max(2, len(a) // 14)


def _lone(s: str) -> bool:
    return len(s) <= 4 and s.isdecimal()


def page_numbers(lines: list[str]) -> set[int]:
    """Lines of a lone number that go up by one from page to page and stand outside tables."""
    cand = [(i, int(s)) for i, x in enumerate(lines) if _lone(s := x.strip())]
    best: dict[int, tuple[int, int]] = {}  # index into cand: (chain length, previous)
    ends: dict[int, tuple[int, int]] = {}  # number: (length of the longest chain that ends in it, the last such index)
    for k, (_, v) in enumerate(cand):
        longest, at = max((ends[v - gap] for gap in (1, 2, 3) if v - gap in ends), default=(0, -1))
        best[k] = (longest + 1, at)
        ends[v] = max(ends.get(v, (0, -1)), (longest + 1, k))
    if not best:
        return set()
    end = max(best, key=lambda k: best[k][0])
    out = set()
    if best[end][0] >= 2:
        while end >= 0:
            out.add(cand[end][0])
            end = best[end][1]
    return out


def _row(line: str) -> bool:
    s = line.strip()
    # The end tells most lines of text apart.
    return bool(s) and (s[-1] in ".,()%<>=-–/" or s[-1].isdecimal()) and bool(_ROW.match(s)) and any(c.isdigit() for c in s)


def _apart(lines: list[str], i: int) -> bool:
    """True if a line stands between blank lines and the next lines with text on both sides are no rows of a table."""
    for step in (-1, 1):
        j = i + step
        if 0 <= j < len(lines) and lines[j].strip():
            return False
        while 0 <= j < len(lines) and not lines[j].strip():
            j += step
        if not 0 <= j < len(lines) or _row(lines[j]):
            return False
    return True


def furniture(lines: list[str], n_pages: int | None = None) -> set[int]:
    """Indices of running headers, footers and page numbers."""
    out: set[int] = set()
    full = [i for i, x in enumerate(lines) if x.strip()]
    if not full:
        return out
    numbers = page_numbers(lines)
    rights = _RIGHTS.search("\n".join(lines)) is not None
    for i in full:
        s = lines[i].strip()
        if rights and _RIGHTS.search(s):
            out.add(i)
        elif _ROMAN.match(s) or (_PAGE.match(s) and not _lone(s) and not s.endswith(".") and re.search(r"[a-zA-Z\-–—]", s)):
            out.add(i)
        elif i in numbers and not any(_row(lines[j]) and j not in numbers for j in (i - 1, i + 1) if 0 <= j < len(lines)):
            out.add(i)
        elif _lone(s) and i not in numbers and _apart(lines, i):
            out.add(i)
    # The title block and the authors' line tell what headers may say. A header above the title reads like its beginning.
    groups: list[tuple[str, list[int]]] = []
    index: dict[str, int] = {}
    short = [i for i in full if i not in out and len(lines[i].strip()) <= 110]
    bare = {i: _bare(lines[i]) for i in short}
    keys = {i: _DIGITS.sub("#", b.lower()) for i, (b, _) in bare.items()}
    for i in short:
        key = keys[i]
        if key in index:
            groups[index[key]][1].append(i)
        else:
            index[key] = len(groups)
            groups.append((key, [i]))
    many = [(k, m) for k, m in groups if len(m) >= 2]
    many.sort(key=lambda g: -len(g[1]))
    paged = Counter(keys[i] for i in short if bare[i][1] and not _row(lines[i]))
    title_at, title, authors_at, authors = _head(lines, out, paged)
    keep = set(title_at) | set(authors_at)
    least = max(2, round(0.3 * n_pages)) if n_pages else 3
    tops: list[str] = []
    for k, m in many:
        letters_ = sum(c.isalpha() for c in k)
        if letters_ < 5 or k.endswith((".", ",", ";")) and not k.endswith("al."):
            continue
        like_title = title and (title.startswith(k) or _alike(title[: len(k)], k)) and len(k) > 12
        like_authors = authors and (_alike(authors, k) or _alike(authors + " et al.", k))
        own = [i for i in m if i not in keep]
        alone = sum(1 for i in own if i == 0 or not lines[i - 1].strip() or i + 1 == len(lines) or not lines[i + 1].strip() or i - 1 in out or i + 1 in out)
        numbered = paged[k] >= 2
        if like_title or like_authors or numbered or (len(own) >= max(3, least) and alone >= 0.9 * len(own) and not _row(lines[own[0]]) and "#" not in k[:3]):
            tops.append(k)
            out.update(own)
    # Single occurrences: misread headers, and headers of short papers. What is alike differs in length by two at most.
    sized: dict[int, list[str]] = {}
    for t in tops:
        for size in range(len(t) - 2, len(t) + 3):
            sized.setdefault(size, []).append(t)
    for i in short:
        if i in out or i in keep:
            continue
        k = keys[i]
        if len(k) < 6:
            continue
        like_title = title and len(k) > 16 and (title.startswith(k) or _alike(title[: len(k)], k))
        like_authors = authors and (_alike(authors, k) or _alike(authors + " et al.", k))
        if like_title or like_authors or any(_alike(t, k) for t in sized.get(len(k), ())):
            out.add(i)
    return out - set(authors_at) - set(title_at)


def _indent(line: str) -> bool:
    return line[:2] == "  "


def _indents_tell(lines: list[str]) -> bool:
    """True if paragraphs are told by the indent of their first line."""
    full = [x for x in lines if x.strip()]
    return 0 < sum(map(_indent, full)) < 0.35 * len(full)


def _head(lines: list[str], taken: set[int], paged: Counter) -> tuple[list[int], str, list[int], str]:
    """(title lines, title in lower case, authors' line, authors in lower case)."""
    blocks: list[list[int]] = []
    run: list[int] = []
    indents = _indents_tell(lines)
    for i, x in enumerate(lines[:60]):
        if run and indents and _indent(x):
            blocks.append(run)
            run = []
            if len(blocks) >= 4:
                break
        if not x.strip():
            if run:
                blocks.append(run)
            run = []
            if len(blocks) >= 4:
                break
        elif i not in taken and not _bare(x)[1]:
            run.append(i)
    if run and len(blocks) < 4:
        blocks.append(run)
    if not blocks:
        return [], "", [], ""
    k = 0
    if len(blocks) > 2 and re.search(r"et al\.?\s*$", " ".join(lines[i] for i in blocks[0])):
        k = 1
    elif len(blocks) > 2 and len(blocks[0]) == 1 and len(lines[blocks[0][0]].split()) <= 4 and " and " in lines[blocks[0][0]]:
        k = 1
    title_at = blocks[k]
    texts = [lines[i].strip() for i in title_at]
    if len(title_at) > 1 and (_alike(texts[0].lower(), texts[1].lower()) or texts[1].lower().startswith(texts[0].lower()[:25])):
        title_at, texts = title_at[1:], texts[1:]
    title = re.sub(r"\d+", "#", " ".join(texts).lower())
    authors_at, authors = [], ""
    if k + 1 < len(blocks):
        line = lines[blocks[k + 1][0]].strip()
        if len(line.split()) <= 14 and not line.endswith("."):
            authors_at = [blocks[k + 1][0]]
            authors = line.split(",")[0].strip().lower()
    return title_at, title, authors_at, authors


def blocks_of(lines: list[str], gone: set[int]) -> list[list[int]]:
    """Paragraphs as runs of lines; a paragraph goes on behind furniture (and the blank lines around it)."""
    out: list[list[int]] = []
    run: list[int] = []
    blank_since, crossed = False, False
    indents = _indents_tell([x for i, x in enumerate(lines) if i not in gone])
    for i, x in enumerate(lines):
        if i in gone:
            crossed = True
            continue
        if not x.strip():
            blank_since = True
            continue
        if run:
            last = lines[run[-1]].rstrip()
            goes_on = crossed and (last[-1:] in HYPHENS or (last[-1:] not in ".!?:" and not _row(last) and (x.lstrip()[:1].islower() or not _HEADING.match(x.strip()) or len(last) > 30)))
            opens = indents and _indent(x) and last[-1:] not in HYPHENS
            if opens or ((blank_since or crossed) and not goes_on):
                out.append(run)
                run = []
        run.append(i)
        blank_since = crossed = False
    if run:
        out.append(run)
    return out


def running(lines: list[str], block: list[int]) -> bool:
    """True if a block is running text: no heading, no rows of a table."""
    texts = [lines[i].strip() for i in block]
    if sum(map(_row, texts)) * 2 >= len(texts):
        return False
    whole = " ".join(texts)
    if len(texts) <= 2 and whole[-1:] not in ".!?" and len(whole.split()) <= 12:
        return False
    return len(whole.split()) >= 5


def _core(token: str) -> str:
    return token.strip(EDGE)


_WORDISH = re.compile(r"^[^\W\d_]+(?:['’\-][^\W\d_]+)*$")
_NUMERIC = re.compile(r"^[\d.,:/%+\-–—<>=×]+$")
_IDENTIFIER = re.compile(r"[/:@_=]|\d{3}|www\.")
_DIGITS_READ = re.compile(r"^(?=.*\d)(?=.*[OolISB!])[\dOolISB!.,]{2,}$")


def join_kind(a: str, b: str, lex: Lexicon) -> tuple[bool, str]:
    """(whether the word cut at a line end is one word, how it must read)."""
    a, b = a.strip(EDGE), _core(b)
    joined, hyphened = (a + b).lower(), f"{a}-{b}".lower()
    if not a or not b or a[-1:].isdigit() or b[:1].isdigit():
        return False, f"{a}-{b}"
    j, h = lex.words.get(joined, 0), lex.words.get(hyphened, 0)
    if j or h:
        return (j >= h), a + b if j >= h else f"{a}-{b}"
    fuzzy_j, fuzzy_h = lex.candidates(joined), lex.candidates(hyphened)
    if fuzzy_j or fuzzy_h:
        best_j = min((k for _, k in fuzzy_j), default=9)
        best_h = min((k for _, k in fuzzy_h), default=9)
        return (best_j <= best_h), a + b if best_j <= best_h else f"{a}-{b}"
    left = a.lower().rsplit("-", 1)[-1]
    if b[:1].isupper() or (len(left) > 3 and len(b) > 3 and left in lex.words and b.lower() in lex.words):
        return False, f"{a}-{b}"
    return True, a + b


def misread(token: str, lex: Lexicon, before: str, after: str, opens: bool) -> str | None:
    """The word that a token must be if it was misread, else None."""
    raw = token.strip(EDGE)
    low = raw.lower()
    if len(raw) < 2 or low in lex.words or _NUMERIC.match(raw):
        return None
    letters_ = sum(c.isalpha() for c in raw)
    if _WORDISH.match(raw):
        if "-" in raw and all(p in lex.words or p[:1].isupper() for p in low.split("-")):
            return None
        if raw[:1].isupper() and not opens:
            return None
        if len(raw) < 3:
            return None
        return lex.repair(low, before, after)
    if _IDENTIFIER.search(raw):
        return None
    if _DIGITS_READ.match(raw):
        return raw.translate(str.maketrans("OolI!SB", "0011158")) if letters_ + raw.count("!") <= 2 and len(raw) > 2 else None
    if letters_ < 2:
        return None
    if (got := lex.repair(low, before, after)) is not None:
        return got
    inner = raw[1:-1] if len(raw) > 2 else ""
    if re.search(r"[^\W\d_][0-9!|@][^\W\d_]", raw) or (re.search(r"[0-9!|@]", inner) and letters_ >= 4 and raw[:1].isalpha()):
        return raw.translate(str.maketrans("0156!|@894", "olsbilasga"))
    if "-" in raw:
        parts = raw.split("-")
        fixed = [misread(p, lex, before, after, opens) for p in parts]
        if any(fixed) and all(f or p.lower() in lex.words or p.isdigit() for f, p in zip(fixed, parts)):
            return "-".join(f or p for f, p in zip(fixed, parts))
    return None


def analyse(text: str, lex: Lexicon, gone: set[int]) -> tuple[list[tuple[int, str]], str]:
    """((line number from 1, damage) in order, repaired text as paragraphs divided by blank lines). gone: lines of furniture."""
    lines = split_lines(text)
    found: set[tuple[int, str]] = {(i + 1, "furniture") for i in gone}
    paragraphs: list[str] = []
    fine = lex.fine
    for block in blocks_of(lines, gone):
        if not running(lines, block):
            paragraphs.append("\n".join(lines[i].strip() for i in block))
            continue
        words: list[str] = []
        opens, before, carry = True, "", None
        for k, i in enumerate(block):
            toks = lines[i].split()
            if carry is not None and toks:
                at, head = carry
                one, reads = join_kind(head, toks[0], lex)
                tail = toks[0][len(toks[0].rstrip(EDGE)) :]
                if one:
                    found.add((at + 1, "broken_word"))
                fixed = misread(reads, lex, before, _core(toks[1]).lower() if len(toks) > 1 else "", opens)
                if fixed is not None:
                    a = head.strip(EDGE).lower()
                    same = 0
                    while same < min(len(a), len(fixed)) and a[same] == fixed[same].lower():
                        same += 1
                    found.add(((at if same < len(a) else i) + 1, "misread"))
                shown = _cased(fixed, reads) if fixed else reads
                words.append(head[: len(head) - len(head.lstrip(EDGE))] + shown + tail)
                before, opens = shown.lower(), tail[-1:] in (".", "!", "?") and bool(tail)
                toks = toks[1:]
                carry = None
            if toks and k + 1 < len(block) and len(toks[-1]) > 1 and toks[-1][-1] in HYPHENS and toks[-1][-2].isalnum():
                carry = (i, toks[-1][:-1])
                toks = toks[:-1]
            if toks and all(map(fine.__contains__, toks)):
                words += toks
                before, opens = fine[toks[-1]], toks[-1][-1] in ".!?" and len(toks[-1]) > 1
                continue
            for t, tok in enumerate(toks):
                if (low := fine.get(tok)) is not None:
                    words.append(tok)
                    before, opens = low, tok[-1] in ".!?" and len(tok) > 1
                    continue
                after = _core(toks[t + 1]).lower() if t + 1 < len(toks) else ""
                fixed = misread(tok, lex, before, after, opens)
                if fixed is not None:
                    found.add((i + 1, "misread"))
                    body = tok.strip(EDGE)
                    tok = tok.replace(body, _cased(fixed, body), 1)
                words.append(tok)
                before, opens = _core(tok).lower(), tok[-1:] in ".!?" and len(tok) > 1
                if fixed is None and (before in lex.words or _NUMERIC.match(before)):
                    fine[tok] = before
        if carry is not None:
            words.append(carry[1] + "-")
        paragraphs.append(" ".join(words))
    return sorted(found), "\n\n".join(paragraphs)


def _cased(fixed: str, read: str) -> str:
    return fixed[:1].upper() + fixed[1:] if read[:1].isupper() else fixed


@lru_cache(maxsize=KEPT)
def _word_of(token: str) -> tuple[str, bool]:
    """(plain word of a token or "", whether a sentence goes on behind it)."""
    w = _core(token).lower()
    return (w, token[-1:] not in ".!?;:") if _WORDISH.match(w) else ("", False)


def lexical_words(text: str) -> tuple[set[str], set[tuple[str, str]]]:
    """(distinct words, distinct bigrams) of the insides of lines: words cut at line ends are left out."""
    tokens: set[str] = set()
    near: set[tuple[str, str]] = set()
    cut = False
    for line in text.lower().split("\n"):
        toks = line.split()
        if not toks:
            continue
        first = cut
        cut = toks[-1][-1] in HYPHENS
        if first or cut:
            toks = toks[first : len(toks) - cut]
        tokens.update(toks)
        near.update(zip(toks, toks[1:]))
    told = {t: _word_of(t) for t in tokens}
    pairs = {(x[0], y[0]) for a, b in near if (x := told[a])[1] and x[0] and (y := told[b])[0]}
    return {w for w, _ in told.values() if w}, pairs


def _repairable(raw: str, opens: bool) -> bool:
    """True if misread() may look for candidates of a token that is not in the vocabulary."""
    if sum(map(str.isalpha, raw)) < 2:
        return False
    if _WORDISH.match(raw):
        return len(raw) > 2 and (opens or not raw[:1].isupper())
    return not _IDENTIFIER.search(raw)


@lru_cache(maxsize=KEPT)
def _asks(token: str) -> tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...]]:
    """What a token asks for: (its forms, those to look up where it opens a sentence, those to look up elsewhere)."""
    parts = dict.fromkeys([token, *(x.strip(EDGE) for x in token.split("-"))] if "-" in token else [token])
    forms = dict.fromkeys(p.lower() for p in parts if p)
    opening, inside = ([p.lower() for p in parts if _repairable(p, o)] for o in (True, False))
    return tuple(forms), tuple(opening), tuple(inside)


class Calm:
    """Tokens that ask for no candidates, with their forms and whether they end a sentence: those that never do, and those that do only
    where they open a sentence."""

    def __init__(self) -> None:
        self.never: dict[str, tuple[tuple[str, ...], bool]] = {}
        self.inside: dict[str, tuple[tuple[str, ...], bool]] = {}


def asked(text: str, gone: set[int], known: set[str] | frozenset[str] = frozenset(), calm: Calm | None = None) -> tuple[set[str], set[str], set[tuple[str, str]]]:
    """(every form that an analysis of the text may look up, those of which it may want candidates, every pair of neighbours whose
    context it may look at, as it may want candidates of one of them). Forms that are ``known`` to be in the vocabulary are left out.
    calm: kept from text to text while ``known`` stays; the forms of tokens that it holds were given with an earlier text."""
    lines = split_lines(text)
    calm = calm or Calm()
    never, within_line = calm.never, calm.inside
    forms: set[str] = set()
    look: set[str] = set()
    pairs: set[tuple[str, str]] = set()
    for block in blocks_of(lines, gone):
        if not running(lines, block):
            continue
        before: tuple[str, ...] = ()
        # opens: a sentence begins here; unsure: candidates of the token before may be wanted.
        carry, opens, unsure = "", True, False
        for k, i in enumerate(block):
            line: list[tuple[tuple[str, ...], tuple[str, ...], tuple[str, ...], str]] = []
            x = lines[i]
            toks = x.split()
            if carry and toks:
                a, b = carry.strip(EDGE), _core(toks[0])
                forms.update((b.lower(), a.lower().rsplit("-", 1)[-1]))
                look.update(((a + b).lower(), f"{a}-{b}".lower()))
                both = [_asks(a + b), _asks(f"{a}-{b}")]
                line.append((*(tuple(dict.fromkeys(x for one in both for x in one[j])) for j in range(3)), toks[0]))
                toks, carry = toks[1:], ""
            if toks and k + 1 < len(block) and len(toks[-1]) > 1 and toks[-1][-1] in HYPHENS and toks[-1][-2].isalnum():
                carry = toks.pop()[:-1]
            if toks and not line:
                # Most lines are calm as a whole; one in which no sentence begins may also hold what is looked up only there.
                held = never if opens or ". " in x or "? " in x or "! " in x or not x.isprintable() else within_line
                if all(map(held.__contains__, toks)):
                    if unsure:
                        pairs.update((x, y) for x in before for y in held[toks[0]][0])
                    (before, opens), unsure = held[toks[-1]], False
                    continue
            for one in (*line, *toks):
                if (kept := (never if opens else within_line).get(one)) is not None:
                    own, opens = kept
                    if unsure:
                        pairs.update((x, y) for x in before for y in own)
                        unsure = False
                    before = own
                    continue
                own, opening, inside, token = (*_asks(one.strip(EDGE)), one) if isinstance(one, str) else one
                if one is token and own and own[0] in known:  # parts are read only of what is no word as a whole
                    own, opening, inside = own[:1], (), ()
                look.update(opening if opens else inside)
                forms.update(own)
                # A word cut at a line end is looked up however it is written.
                wants = not all(map(known.__contains__, own if one is not token else opening if opens else inside))
                if unsure or wants:
                    pairs.update((x, y) for x in before for y in own)
                before, unsure = own, wants
                opens = token[-1] in ".!?" and len(token) > 1
                if one is token and all(map(known.__contains__, inside)):
                    within_line[one] = own, opens
                    if all(map(known.__contains__, opening)):
                        never[one] = own, opens
    return {f for f in forms | look if _worded(f) and f not in known}, look - known, pairs


@lru_cache(maxsize=KEPT)
def _worded(form: str) -> bool:
    return sum(map(str.isalpha, form)) > 1


def gone_lines(text: str, n_pages: int | None = None) -> set[int]:
    return furniture(split_lines(text), n_pages)
