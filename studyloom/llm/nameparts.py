"""Comparable parts of names of people and organisations (part of problem 2)."""

from __future__ import annotations

import re
from math import log

from studyloom.llm.placenames import plain, within

# Familiar forms of given names.
FAMILIAR = {
    "liz": "elizabeth", "lizzie": "elizabeth", "beth": "elizabeth", "betty": "elizabeth", "eliza": "elizabeth", "peggy": "margaret", "maggie": "margaret",
    "meg": "margaret", "bob": "robert", "rob": "robert", "bobby": "robert", "bill": "william", "will": "william", "billy": "william", "wim": "willem",
    "ted": "theodore", "teddy": "theodore", "theo": "theodore", "kate": "katherine", "kathy": "katherine", "katie": "katherine", "larry": "laurence",
    "laurie": "laurence", "jo": "johanna", "hanna": "johanna", "hanneke": "johanna", "vicky": "victoria", "vicki": "victoria", "tori": "victoria",
    "zach": "zacharias", "zack": "zacharias", "sasha": "alexander", "alex": "alexander", "sander": "alexander", "lex": "alexander", "dom": "dominique",
    "gerda": "gerarda", "klaas": "nicolaas", "nico": "nicolaas", "niek": "nicolaas", "heinz": "heinrich", "heiner": "heinrich", "uschi": "ursula",
    "ulla": "ursula", "bella": "isabella", "izzy": "isabella", "isa": "isabella", "tavi": "octavia", "penny": "penelope", "cisca": "francisca",
    "fran": "francisca", "siska": "francisca", "jim": "james", "jimmy": "james", "jack": "john", "johnny": "john", "dick": "richard", "rick": "richard",
    "rich": "richard", "tom": "thomas", "tommy": "thomas", "mike": "michael", "mick": "michael", "dave": "david", "steve": "stephen", "tony": "anthony",
    "chuck": "charles", "charlie": "charles", "ed": "edward", "eddie": "edward", "ned": "edward", "harry": "henry", "hank": "henry", "sue": "susan",
    "susie": "susan", "debbie": "deborah", "deb": "deborah", "pat": "patricia", "patty": "patricia", "trish": "patricia", "jen": "jennifer", "jenny": "jennifer",
    "sam": "samuel", "ben": "benjamin", "dan": "daniel", "danny": "daniel", "joe": "joseph", "andy": "andrew", "drew": "andrew", "greg": "gregory", "nick": "nicholas",
    "chris": "christopher", "kit": "christopher", "tina": "christina", "mandy": "amanda", "cathy": "catherine", "ronnie": "ronald", "ron": "ronald", "fred": "frederick",
    "fritz": "friedrich", "hans": "johannes", "jan": "johannes", "piet": "pieter", "kees": "cornelis", "greta": "margareta", "gretchen": "margareta",
}
TITLES = frozenset("dr prof professor mr mrs ms miss mx phd md msc bsc ir drs ing jr sr mag dipl habil em sir dame".split())
PARTICLES = frozenset("van von der den de la le les di da del della ter ten te zu zum zur af het dos das du".split())
# What whole words in names of organisations stand for, in several languages; "" for words that tell no body apart.
# Abbreviations and initials are not listed: the data and the likelihood of an abbreviation tell what they stand for.
CONCEPT = {
    "university": "university", "universitat": "university", "universiteit": "university", "universite": "university", "universitair": "university", "universitaet": "university",
    "universitats": "university", "medical": "medical", "medisch": "medical", "medizin": "medical", "medizinisches": "medical", "cancer": "cancer", "oncology": "cancer", "krebs": "cancer",
    "kanker": "cancer", "krebszentrum": "cancer", "kankercentrum": "cancer", "public": "public", "health": "health", "gesundheit": "health", "gezondheid": "health", "technology": "technology",
    "technological": "technology", "technical": "technology", "technologie": "technology", "statistics": "statistics", "statistical": "statistics", "statistiek": "statistics",
    "statistik": "statistics", "heart": "heart", "hart": "heart", "hartstichting": "heart", "herz": "heart", "herzstiftung": "heart", "cardiac": "heart", "birth": "birth", "births": "birth",
    "geboorte": "birth", "geburten": "birth", "biobank": "biobank", "cohort": "cohort", "kohort": "cohort", "cooperative": "cohort", "ministry": "ministry", "ministerie": "ministry",
    "ministerium": "ministry", "children": "children", "childrens": "children", "child": "children", "kinder": "children", "kinderziekenhuis": "children", "kinderklinik": "children",
    "paediatric": "children", "pediatric": "children", "centre": "", "center": "", "centrum": "", "zentrum": "", "institute": "", "institut": "", "instituut": "", "office": "",
    "registry": "", "register": "", "foundation": "", "stichting": "", "stiftung": "", "hospital": "", "ziekenhuis": "", "krankenhaus": "", "comprehensive": "", "national": "",
    # units of a body
    "department": "", "section": "", "division": "", "unit": "", "services": "", "service": "", "laboratory": "", "labs": "", "research": "", "support": "", "data": "",
    "epidemiology": "", "biostatistics": "", "paediatrics": "", "pediatrics": "", "school": "", "faculty": "", "group": "",
}
#: Words of grammar and of legal form.
LIGHT = frozenset("the of for and de van voor fur fuer der die het s at".split())
LEGAL = frozenset("ltd limited inc gmbh bv co".split())
VOWELS = frozenset("aeiouy")
_WORD = re.compile(r"[^\W\d_]+")
_COMPOUND = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)+")

# The channel: chances that a writer shortens a word or misspells it; that a shortened word is cut off behind a letter, or
# cut off and closed with its last letter, else loses letters of its inside, a vowel oftener than a consonant.
SHORTENED, MISSPELT, CUT_OFF, CLOSED = 0.2, 0.02, 0.5, 0.15
KEEP = {True: 0.2, False: 0.6}  # vowel, consonant
INITIALS = 0.02  # that a body is written by its initials
LETTER = 2.0  # nats that a letter of a proper word carries
SECOND = 0.01  # that a name has another proper word besides a longer one
UNSEEN = 0.5  # occurrences that a listed word is credited with


def shortening(full: str, short: str) -> float:
    """Log chance that ``full``, once it is shortened, becomes ``short``: cut off, closed with its last letter, or with letters dropped behind the first one."""
    n, m = len(full), len(short)
    if not 1 < m < n or full[0] != short[0]:
        return float("-inf")
    chance = CUT_OFF / (n - 2) if full.startswith(short) and n > 2 else 0.0
    # ways[j]: chance that the letters read so far left the first j of short.
    ways = [0.0] * (m + 1)
    ways[1] = 1.0
    for ch in full[1:]:
        keep = KEEP[ch in VOWELS]
        for j in range(m, 0, -1):
            ways[j] = ways[j] * (1 - keep) + (ways[j - 1] * keep if j > 1 and short[j - 1] == ch else 0.0)
    if m > 2 and full[-1] == short[-1] and full.startswith(short[:-1]):
        chance += CLOSED / (n - 2)
    chance += (1 - CUT_OFF - CLOSED) * ways[m]
    return log(chance) if chance > 0 else float("-inf")


def split_words(writing: str) -> list[str]:
    """Words of an organisation's name; a compound that is a listed word without its hyphens is one word."""
    t = plain(writing).replace("’", "'").replace("'s", "s")
    t = _COMPOUND.sub(lambda m: m.group().replace("-", "") if m.group().replace("-", "") in CONCEPT else m.group(), t)
    return _WORD.findall(t)


def told_kinds(words: list[str]) -> str:
    """What kind of body the concepts tell, as one text."""
    kinds = {k for w in words for k in w.split()}
    if "ministry" in kinds:
        kinds -= {"public"}
    if "biobank" in kinds and len(kinds) > 1:
        kinds -= {"health"}
    return " ".join(sorted(kinds))


def evidence_of(writing: str) -> list[tuple[str, str]]:
    """What a writing tells of the channel: (listed word, "") for each, and (initials, kinds) of each run of listed words, with and
    without the words of grammar."""
    out: list[tuple[str, str]] = []
    run: list[str] = []
    for w in [*split_words(writing), ""]:
        if w in CONCEPT:
            out.append((w, ""))
        if w in CONCEPT or (run and w in LIGHT):
            run.append(w)
            continue
        while run and run[-1] in LIGHT:
            run.pop()
        full = [x for x in run if x in CONCEPT]
        if 2 <= len(full) and len(run) <= 5 and (kinds := told_kinds([CONCEPT[x] for x in full])):
            out += [(letters, kinds) for letters in {"".join(x[0] for x in run), "".join(x[0] for x in full)} if 2 <= len(letters) <= 4]
        run = []
    return out


class Channel:
    """Posterior of what a word of an organisation's name stands for."""

    def __init__(self, words: dict[str, float], initials: dict[str, tuple[str, float]], writings: float):
        """words: writings that hold each listed word; initials: kinds of body with their number, for each text of initials."""
        self.words, self.initials, self.total = words, initials, max(writings, 1.0)
        self.known: dict[str, tuple[str | None, float]] = {}

    def stands_for(self, word: str) -> tuple[str | None, float]:
        """(concepts or None, log posterior odds against a proper word) of a word that is not listed."""
        if word not in self.known:
            best: tuple[str | None, float] = (None, float("-inf"))
            for full, concept in CONCEPT.items():
                said = log(SHORTENED) + shortening(full, word)
                if len(word) >= 5 and abs(len(full) - len(word)) < 2 and within(word, full, 1) == 1:
                    said = max(said, log(MISSPELT) - log(30 * len(full)))
                score = log((self.words.get(full, 0.0) + UNSEEN) / self.total) + said
                if score > best[1]:
                    best = (concept, score)
            if word in self.initials:
                kinds, n = self.initials[word]
                score = log(n / self.total) + log(INITIALS) - log(2)
                if score > best[1]:
                    best = (kinds, score)
            self.known[word] = (best[0], best[1] + LETTER * len(word))
        return self.known[word]

    def body_parts(self, writing: str) -> tuple[str, str]:
        """(core, kinds) of an organisation: the proper words run together, and what kind of body it is."""
        core, told = [], []
        words = [w for w in split_words(writing) if w not in LIGHT and w not in LEGAL]
        unknown = [w for w in words if w not in CONCEPT]
        longest = max(unknown, key=len, default="")
        for w in words:
            if w in CONCEPT:
                told.append(CONCEPT[w])
                continue
            concept, odds = self.stands_for(w)
            if concept is not None and odds > (0.0 if w == longest else log(SECOND)):
                told.append(concept)
            else:
                core.append(w)
        return "".join(core), told_kinds(told)


def person_tokens(first: str | None, last: str | None) -> tuple[list[str], list[list[str]]]:
    """(given, family) tokens of a typed person; a family name is a list of the parts of a double name.

    A name written into one field is taken apart: "Family, Given" or "Given Family". Whether the fields are swapped is
    decided later, by how often each token stands in either field.
    """
    f, s = (plain(x or "").replace("’", "'") for x in (first, last))
    if not f.strip() and s.count(",") == 1:
        s, f = s.split(",")
    elif not s.strip() and f.count(",") == 1:
        s, f = f.split(",")

    def toks(text: str) -> list[str]:
        out = [w.strip("-'") for w in re.findall(r"[^\W\d_]+(?:[-'][^\W\d_]+)*", text)]
        return [w for w in out if w and w not in TITLES and w not in PARTICLES]

    given, family = toks(f), toks(s)
    if not given and len(family) > 1:
        given, family = family[:-1], family[-1:]
    elif not family and len(given) > 1:
        given, family = given[:-1], given[-1:]
    return given, [[p for p in w.split("-") if p] for w in family]
