"""Noise in text from scanned pages (problem 6).

Method: a vocabulary is counted over all papers (words in at least two of them, at any size of the corpus; words that are far
more frequent misreadings of others are taken out); for every word that is looked up anywhere the vocabulary trie is walked once
along what confusions say may be printed, which yields every candidate that they explain, and those within the edits are kept; they
are ranked with their neighbours' bigrams and frequency; then page furniture is removed and the text is reflowed, words cut at line
ends being joined.

Neither the vocabulary nor its trie is held as a whole anywhere: it is cut into blocks by length of word, and the looked-up
words meet the blocks of the lengths that their edits allow. Papers are handled in groups of ``GROUP``; a group is given the part
of the vocabulary, the candidates and the bigrams that its own texts ask for. What a text asks for is gathered once the vocabulary is
known: sound words and their pairs ask for nothing. Between the passes texts are kept packed.

Defined results: null and blank texts give no damage and an empty text; repeated papers each give their rows; a paper is
read whole; an empty table gives empty results. Only paper_id, paper_text and n_pages are read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from studyloom.llm.lexicon import LONG, Lexicon, Trie, edits_between, edits_for, likely
from studyloom.llm.pages import Calm, analyse, asked, gone_lines, lexical_words
from studyloom.operators.skew import by_sort
from studyloom.session import cut, parallelism

#: A vocabulary word, and a bigram that serves as context, stands in at least so many papers.
LEAST = 2
#: A word that a word so many times as frequent explains as a misreading is no vocabulary.
FAR_MORE = 8
GROUP = 32  # papers of a group
BLOCK = 50_000  # vocabulary words of a trie
READS = 500  # read words that meet a block at once, as far as tasks allow
HELD = 100_000  # bigrams that a task counts before it hands them on


def _packed(text: str | None) -> bytes | None:
    return zlib.compress(text.encode("utf-8", "surrogatepass"), 1) if isinstance(text, str) else None


def _text(packed: bytes | None) -> str | None:
    return zlib.decompress(packed).decode("utf-8", "surrogatepass") if isinstance(packed, (bytes, bytearray)) else None


def _gone(text: str | None, pages: float | None) -> list[int]:
    return sorted(gone_lines(text, int(pages) if pages == pages and pages is not None else None)) if isinstance(text, str) and text else []


def prepared(papers: DataFrame) -> DataFrame:
    """(grp, paper_id, packed, gone): papers spread in groups, their packed text, and the lines of it that are page furniture."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            gone = [_gone(t, n) for t, n in zip(b["paper_text"], b["n_pages"])]
            packed = [_packed(t) for t in b["paper_text"]]
            yield pd.DataFrame({"grp": b["grp"], "paper_id": b["paper_id"], "packed": pd.Series(packed, dtype=object, index=b.index), "gone": pd.Series(gone, dtype=object, index=b.index)})

    groups = max(1, -(-papers.count() // GROUP))
    # Rows are numbered as they lie in the files, so groups are even even if one paper is repeated without end.
    grouped = papers.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).alias("grp"), "paper_id", "paper_text", "n_pages")
    spread = grouped.repartition(max(1, min(groups, parallelism(papers.sparkSession) * 2)), "grp")
    return cut(spread.mapInPandas(run, "grp long, paper_id long, packed binary, gone array<int>"))


def _by_group(df: DataFrame):
    return df.repartition(parallelism(df.sparkSession) * 2, "grp").groupBy("grp")


def told(groups: DataFrame) -> DataFrame:
    """(grp, a, b, n): words (b is "") of each group, and bigrams (grp is null) of all the groups of a task, with the papers that have
    them inside of lines."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frame = lambda grp, count: pd.DataFrame({"grp": grp, "a": [x for x, _ in count], "b": [y for _, y in count], "n": list(count.values())}, dtype=object)
        near: Counter = Counter()
        for b in batches:
            for g, part in b.groupby("grp"):
                count: Counter = Counter()
                for t in map(_text, part["packed"]):
                    if t:
                        words, pairs = lexical_words(t)
                        count.update(words)
                        near.update(pairs)
                yield frame(g, {(w, ""): n for w, n in count.items()})
                if len(near) > HELD:
                    yield frame(None, near)
                    near.clear()
        yield frame(None, near)

    return cut(groups.mapInPandas(run, "grp long, a string, b string, n long"))


def wanted(groups: DataFrame, known: DataFrame) -> DataFrame:
    """(grp, a, b, look): forms (b is "") that an analysis of a group may look up besides its words in the vocabulary (known: grp, a), and
    pairs of neighbours, of one of which it may want candidates; look tells that it may want candidates."""

    def run(part: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        sound = set(rows["a"])
        calm = Calm()
        ask: set[tuple[str, str]] = set()
        looks: set[str] = set()
        for packed, gone in zip(part["packed"], part["gone"]):
            if t := _text(packed):
                forms, look, near = asked(t, {int(i) for i in gone}, sound, calm)
                looks |= look
                ask.update((f, "") for f in forms)
                ask |= near
        g = part["grp"].iloc[0] if len(part) else None
        return pd.DataFrame([(g, x, y, not y and x in looks) for x, y in ask], columns=["grp", "a", "b", "look"], dtype=object)

    return cut(_by_group(groups).cogroup(_by_group(known)).applyInPandas(run, "grp long, a string, b string, look boolean"))


def retrieved(reads: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(read, word, n, edits, confusions) of all vocabulary words (word, n) that can have been misread as each read word (read)."""
    reads = cut(reads)
    salts = max(1, min(parallelism(reads.sparkSession) * 2, -(-reads.count() // READS)))
    upto = lambda c: F.explode(F.sequence(F.lit(0), c - 1))
    # A small vocabulary is one block for all lengths.
    parted = vocabulary.count() > BLOCK
    by_len = lambda c: F.length(c) if parted else F.lit(0)
    reach = F.when(F.length("read") < LONG, 2).otherwise(3)
    lens = F.explode(F.sequence(F.length("read") - reach, F.length("read") + reach)) if parted else F.lit(0)
    chunks = vocabulary.groupBy(by_len("word").alias("len")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("chunks"))
    left = reads.select("read", lens.alias("len")).join(chunks, "len").select("read", "len", upto(F.col("chunks")).alias("chunk")).withColumn("salt", F.pmod(F.xxhash64("read"), F.lit(salts)).cast("int"))
    right = vocabulary.withColumn("len", by_len("word")).join(chunks, "len").withColumn("chunk", F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int")).withColumn("salt", upto(F.lit(salts)))

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        counts = dict(zip(b["word"], b["n"]))
        trie = Trie(counts)
        rows = [
            (r, w, counts[w], e, k) for r in a["read"] for w, k in trie.explained(r).items()
            if w != r and (e := edits_between(w, r, upto := max(2, edits_for(r)))) <= upto
        ] if counts else []
        return pd.DataFrame(rows, columns=["read", "word", "n", "edits", "confusions"], dtype=object)

    by = ["len", "chunk", "salt"]
    # A stated number of partitions: the rows are few, but each is long work.
    spread = lambda df: df.repartition(parallelism(reads.sparkSession) * 2, *by).groupBy(*by)
    return spread(left).cogroup(spread(right.select(*by, "word", "n"))).applyInPandas(meet, "read string, word string, n long, edits int, confusions int")


@F.pandas_udf(BooleanType())
def _possible(read: pd.Series, word: pd.Series, edits: pd.Series, confusions: pd.Series) -> pd.Series:
    return pd.Series([e <= edits_for(r) and likely(w, k) for r, w, e, k in zip(read, word, edits, confusions)], dtype="bool")


def lexicons(groups: DataFrame) -> DataFrame:
    """(grp, kind, a, b, n): for each group the vocabulary words it asks for ("word", a, n), the candidates of the unknown words
    ("candidate", a read, b word, n confusions; "count", b word, n) and the bigrams that may be their context ("pair", a, b)."""
    rows = told(groups)
    counted = cut(rows.groupBy("a", "b").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST))
    vocabulary = counted.filter("b = ''").select(F.col("a").alias("word"), "n")
    # Only a word that is far more frequent than the rarest can explain another one: a small trie tells what is unsound, and so
    # does that of the sound words what may have been printed.
    frequent = vocabulary.filter(F.col("n") >= FAR_MORE * LEAST)
    explained = retrieved(vocabulary.select(F.col("word").alias("read")), frequent)
    own = vocabulary.select(F.col("word").alias("read"), F.col("n").alias("own"))
    unsound = explained.join(by_sort(own), "read").filter((F.length("read") > 2) & (F.col("edits") <= 2) & (F.col("confusions") <= 2) & (F.col("n") >= FAR_MORE * F.col("own")))
    sound = cut(vocabulary.join(unsound.select(F.col("read").alias("word")).distinct(), "word", "left_anti"))
    known = cut(rows.filter("b = ''").select("grp", "a").distinct().join(by_sort(sound), F.col("a") == F.col("word")).select("grp", "a", "n"))
    asks = wanted(groups, known.select("grp", "a"))
    reads = asks.filter("look").select(F.col("a").alias("read")).distinct().join(sound.select(F.col("word").alias("read")), "read", "left_anti")
    found = cut(retrieved(reads, sound).filter(_possible("read", "word", "edits", "confusions")).select("read", "word", "n", "confusions"))
    forms = asks.filter("b = ''").select("grp", "a")
    others = forms.join(by_sort(sound), F.col("a") == F.col("word")).select("grp", "a", "n")
    words = known.unionByName(others).select("grp", F.lit("word").alias("kind"), "a", F.lit("").alias("b"), "n")
    options = forms.join(by_sort(found), F.col("a") == F.col("read")).select("grp", "a", "word", "n", "confusions")
    candidates = options.select("grp", F.lit("candidate").alias("kind"), "a", F.col("word").alias("b"), F.col("confusions").cast("long").alias("n"))
    counts = options.select("grp", F.lit("count").alias("kind"), F.lit("").alias("a"), F.col("word").alias("b"), "n").distinct()
    # Either neighbour may stand as it is or be read as one of its candidates.
    ask = asks.filter("b <> ''").select("grp", "a", "b")
    may = lambda side: found.select(F.col("read").alias(side), F.col("word").alias(f"{side}_may"))
    both = ask.join(by_sort(may("a")), "a", "left").join(by_sort(may("b")), "b", "left").filter("a_may IS NOT NULL OR b_may IS NOT NULL")
    forms_of = lambda side: F.array_compact(F.array(F.col(side), F.col(f"{side}_may")))
    ways = both.select("grp", F.explode(forms_of("a")).alias("a"), "b", "b_may").select("grp", "a", F.explode(forms_of("b")).alias("b")).distinct()
    context = ways.join(by_sort(counted.filter("b <> ''").select("a", "b")), ["a", "b"]).select("grp", F.lit("pair").alias("kind"), "a", "b", F.lit(1).cast("long").alias("n"))
    return words.unionByName(candidates).unionByName(counts).unionByName(context)


def lexicon_of(rows: pd.DataFrame) -> Lexicon:
    """Lexicon of a group from its rows."""
    part = {k: v for k, v in rows.groupby("kind")}
    of = lambda k: part[k][["a", "b", "n"]].itertuples(index=False) if k in part else ()
    known: dict[str, list[tuple[str, int]]] = {}
    for read, word, k in of("candidate"):
        known.setdefault(read, []).append((word, int(k)))
    lex = Lexicon({a: int(n) for a, _, n in of("word")}, {(a, b): 1 for a, b, _ in of("pair")}, known)
    lex.counts = {b: int(n) for _, b, n in of("count")}
    return lex


def _analysed(papers: DataFrame, schema: str, shape) -> DataFrame:
    groups = prepared(papers)
    parts = cut(lexicons(groups))

    def run(part: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        lex = lexicon_of(rows)
        out = []
        for i, t, gone in zip(part["paper_id"], map(_text, part["packed"]), part["gone"]):
            found, text = analyse(t, lex, {int(g) for g in gone}) if isinstance(t, str) else ([], "")
            out += shape(i, found, text)
        return pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")], dtype=object)

    return _by_group(groups).cogroup(_by_group(parts)).applyInPandas(run, schema)


def damage(papers: DataFrame) -> DataFrame:
    """(paper_id, line_no, damage)."""
    return _analysed(papers, "paper_id long, line_no long, damage string", lambda i, found, _: [(i, k, d) for k, d in found])


def repaired(papers: DataFrame) -> DataFrame:
    """(paper_id, text, n_furniture, n_broken, n_misread): continuous paragraphs, divided by blank lines."""

    def shape(i, found, text) -> list[tuple]:
        n = Counter(d for _, d in found)
        return [(i, text, n["furniture"], n["broken_word"], n["misread"])]

    return _analysed(papers, "paper_id long, text string, n_furniture long, n_broken long, n_misread long", shape)
