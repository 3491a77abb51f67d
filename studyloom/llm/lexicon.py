"""Vocabulary trie, its walks by edits and by confusions, and misreading model (part of problem 6)."""

from __future__ import annotations

# What a recogniser makes of what stands on the page (as printed: as read).
CONFUSIONS = {
    "e": ("c", "o"), "c": ("e", "o"), "t": ("f", "l", "i"), "f": ("t",), "h": ("b", "li", "n"), "b": ("h", "6", "lo"), "u": ("ii", "v", "n"), "d": ("cl", "ol"),
    "o": ("0", "c", "e"), "l": ("1", "i", "!", "|", "t"), "i": ("!", "1", "l", "j", "|", ";"), "s": ("5", "8"), "m": ("rn", "nn", "in"), "n": ("ri", "u", "h", "m", "ii"), "w": ("vv",),
    "g": ("9", "q"), "a": ("o", "u", "@", "4"), "r": ("v", "t", "n"), "z": ("2",), "q": ("9", "g"), "k": ("lc",), "y": ("v", "g"), "v": ("y", "r", "u"), "p": ("n",), "rn": ("m",), "cl": ("d",),
    "vv": ("w",), "ri": ("n",), "ii": ("u", "n"), "li": ("h",), "nn": ("m",), "fi": ("h",), "tt": ("ft",), "ll": ("11",), "in": ("m",),
}


#: What may be printed where something is read, with the length of what is read.
PRINTED: dict[str, list[tuple[str, int]]] = {}
for _printed, _reads in CONFUSIONS.items():
    for _read in _reads:
        PRINTED.setdefault(_read, []).append((_printed, len(_read)))
_WIDEST = max(map(len, PRINTED))


class Trie:
    """Vocabulary trie; a node is [children, word or None]."""

    def __init__(self, words):
        self.root: list = [{}, None]
        for w in words:
            node = self.root
            for ch in w:
                node = node[0].setdefault(ch, [{}, None])
            node[1] = w

    def search(self, word: str, limit: int) -> list[tuple[str, int]]:
        """All (vocabulary word, edits) within limit: the trie is walked together with the Levenshtein automaton of word. A state of
        the automaton is one set of positions for each number of edits, kept as bits; a branch ends where all are empty."""
        n = len(word)
        full, end = (1 << (n + 1)) - 1, 1 << n
        at: dict[str, int] = {}
        for i, ch in enumerate(word):
            at[ch] = at.get(ch, 0) | 1 << i
        found: list[tuple[str, int]] = []
        stack = [(self.root, [(1 << (e + 1)) - 1 & full for e in range(limit + 1)])]
        while stack:
            (children, whole), state = stack.pop()
            if whole is not None:
                for e, bits in enumerate(state):
                    if bits & end:
                        found.append((whole, e))
                        break
            for ch, child in children.items():
                same = at.get(ch, 0)
                before = state[0]
                new = (before & same) << 1
                nxt = [new]
                for bits in state[1:]:
                    # A letter read, a letter of the word missing, another letter, a letter of the word too many.
                    new = ((bits & same) << 1 | before | before << 1 | new << 1) & full
                    nxt.append(new)
                    before = bits
                if new:
                    stack.append((child, nxt))
        return found


    def explained(self, read: str, limit: int = 3) -> dict[str, int]:
        """Every word that at most so many confusions turn into read, with the least number of them (see ``misreadings``): the trie is
        walked along what may be printed at each place of read, so the words that no confusion leads to are never met."""
        n = len(read)
        ways = [[w for size in range(1, _WIDEST + 1) if j + size <= n for w in PRINTED.get(read[j : j + size], ())] for j in range(n)]
        found: dict[str, int] = {}
        stack = [(self.root, 0, 0)]
        while stack:
            (children, whole), j, k = stack.pop()
            if j == n:
                if whole is not None and k < found.get(whole, limit + 1):
                    found[whole] = k
                continue
            if (child := children.get(read[j])) is not None:
                stack.append((child, j + 1, k))
            if k < limit:
                for printed, size in ways[j]:
                    node = children.get(printed[0])
                    if node is not None and len(printed) > 1:
                        node = node[0].get(printed[1])
                    if node is not None:
                        stack.append((node, j + size, k + 1))
        return found


def edits_between(a: str, b: str, limit: int) -> int:
    """Edit distance; limit + 1 if greater."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b):
            row.append(min(last[j + 1] + 1, row[j] + 1, last[j] + (x != y)))
    return min(row[-1], limit + 1)


LONG = 10


def edits_for(read: str) -> int:
    """Edits within which candidates of a read word are looked for."""
    return 1 if len(read) < 4 else 2 if len(read) < LONG else 3


def likely(word: str, confusions: int) -> bool:
    """True if a word may be printed where so many confusions made it what was read."""
    return len(word) > 1 and confusions <= (1 if len(word) < 5 else 2 if len(word) < 9 else 3)


def misreadings(printed: str, read: str, limit: int = 3) -> int:
    """Least number of confusions that turn printed into read; limit + 1 if it cannot be told so."""
    n, m = len(printed), len(read)
    inf = limit + 1
    best = [[inf] * (m + 1) for _ in range(n + 1)]
    best[0][0] = 0
    for i in range(n + 1):
        for j in range(m + 1):
            b = best[i][j]
            if b > limit:
                continue
            if i < n and j < m and printed[i] == read[j] and b < best[i + 1][j + 1]:
                best[i + 1][j + 1] = b
            for a in (1, 2):
                if i + a <= n:
                    for c in CONFUSIONS.get(printed[i : i + a], ()):
                        if read.startswith(c, j) and b + 1 < best[i + a][j + len(c)]:
                            best[i + a][j + len(c)] = b + 1
    return best[n][m]


class Lexicon:
    """Words with the number of papers that have them, and the bigrams that serve as context."""

    def __init__(self, words: dict[str, int], pairs: dict[tuple[str, str], int] | None = None, known: dict[str, list[tuple[str, int]]] | None = None):
        """known: the candidates of all read words that have any (then ``words`` need not hold the whole vocabulary); else they are
        looked up in the trie of ``words``."""
        self.words, self.pairs = words, pairs or {}
        self.trie = Trie(words) if known is None else None
        self.known = {} if known is None else known
        #: Papers that have a candidate, where it is not among ``words``.
        self.counts: dict[str, int] = {}
        #: Tokens known to be sound as they stand, with their plain form.
        self.fine: dict[str, str] = {}

    def candidates(self, read: str) -> list[tuple[str, int]]:
        """Vocabulary words that can have been misread as ``read``, with the number of confusions."""
        if self.trie is None:
            return self.known.get(read, [])
        if read not in self.known:
            found = [(w, misreadings(w, read)) for w, _ in self.trie.search(read, edits_for(read))]
            self.known[read] = [(w, k) for w, k in found if likely(w, k)]
        return self.known[read]

    def repair(self, read: str, before: str = "", after: str = "") -> str | None:
        """Best candidate by confusions, context and frequency."""
        found = self.candidates(read)
        if not found:
            return None

        def score(c: tuple[str, int]) -> tuple:
            w, k = c
            context = (self.pairs.get((before, w), 0) > 0) + (self.pairs.get((w, after), 0) > 0)
            return (context - 1.5 * k, self.words.get(w) or self.counts.get(w, 0), w)

        return max(found, key=score)[0]
