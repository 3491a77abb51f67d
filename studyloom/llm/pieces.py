"""Splitting oversized items at natural boundaries (problem 4).

Method: byte-range processing for giant files. A file is cut into byte ranges; workers detect the boundaries of a range with
a halo of the text behind it; the small tables of the ranges are stitched (blank runs that cross range edges are summed,
lengths are prefix-summed to offsets); pieces are chosen from boundaries alone and emitted by offset, so no worker ever holds
a whole file and no text is shuffled. Where the next piece begins depends on where the one before ended, so every range
tells, for each place at which a piece may enter it, where the piece chain leaves it and how many pieces begin in it; a scan
over these few numbers gives each range its entry. The pieces of a text are therefore the same at any range size. A table
cell is in memory already: its ranges are stitched and folded where the row is read.

A piece has at most ``limit`` characters with its overlap. It ends at the last paragraph start that fits, else the last
sentence start, else the last word start, else at the limit. It begins with about ``overlap`` characters of the piece
before, from a word start on. ``core_start`` tells where its own text begins: the texts from there on join to the item.

Defined results: null and empty items, and rows without id, give no piece and no paragraph; blank items give pieces but no
paragraph; repeated rows, and different texts under one id, each give their own pieces and paragraphs; an empty table or
file gives empty results. Only the id and text columns are read. Files are UTF-8; bytes that are none are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from studyloom.session import cut, parallelism

LIMIT, OVERLAP = 4000, 200
RANGE = 65_536
FILE_RANGE = 16 * RANGE

_INK = re.compile(r"[^ \t\r\f\n]")
_GAP = re.compile(r"[ \t\r\f]*\n[ \t\r\f]*\n[ \t\r\f\n]*")
_SENTENCE = re.compile(r"[.!?…][\"'”’)\]]*\s+(?=\S)")
_SPACE = re.compile(r"\s+(?=\S)")
_LOOK = re.compile(r"[\"'”’)\]]*\s*(\S?)")


class Bounds(NamedTuple):
    """Boundary table of a range, offsets from its start; first is None in a blank range."""

    n: int
    nl_lead: int
    first: int | None
    nl_trail: int
    last: int | None
    nl_all: int
    gap_ends: list[int]
    gap_starts: list[int]
    sentences: list[int]
    words: list[int]


def boundaries(core: str, halo: str) -> Bounds:
    """The halo must reach to the first character behind closing marks and white space (or the end)."""
    n = len(core)
    m = _INK.search(core)
    text = core + halo
    sentences = [s.end() for s in _SENTENCE.finditer(text) if s.start() < n]
    words = [w.end() for w in _SPACE.finditer(text) if w.start() < n]
    if m is None:
        return Bounds(n, 0, None, 0, None, core.count("\n"), [], [], sentences, words)
    first, last = m.start(), len(core.rstrip(" \t\r\f\n"))
    gaps = [(g.start(), g.end()) for g in _GAP.finditer(core, first, last)]
    return Bounds(n, core.count("\n", 0, first), first, core.count("\n", last), last, core.count("\n"), [a for a, _ in gaps], [b for _, b in gaps], sentences, words)


def halo_of(text: str, at: int) -> str:
    """Text behind ``at`` as far as a boundary that begins before it may end."""
    return _LOOK.match(text, at).group()


class Marks(NamedTuple):
    length: int
    starts: list[int]
    ends: list[int]
    sentences: list[int]
    words: list[int]


def stitch(tables: Iterator[Bounds]) -> Marks:
    """Paragraphs, sentence starts and word starts of an item from the tables of its ranges in order."""
    starts, ends, sentences, words = [], [], [], []
    base, newlines, ink_end = 0, 0, None
    for t in tables:
        if t.first is None:
            newlines += t.nl_all
        else:
            if ink_end is None or newlines + t.nl_lead >= 2:
                if ink_end is not None:
                    ends.append(ink_end)
                starts.append(base + t.first)
            ends += [base + x for x in t.gap_ends]
            starts += [base + x for x in t.gap_starts]
            ink_end, newlines = base + t.last, t.nl_trail
        sentences += [base + x for x in t.sentences]
        words += [base + x for x in t.words]
        base += t.n
    if ink_end is not None:
        ends.append(ink_end)
    return Marks(base, starts, ends, sorted(set(sentences)), sorted(set(words)))


def cell_marks(text: str, size: int = RANGE) -> Marks:
    return stitch(boundaries(text[at : at + size], halo_of(text, at + size)) for at in range(0, len(text), size))


def piece_at(at: int, end: int, marks: tuple[list, list, list], limit: int, overlap: int, first: int = 0) -> tuple[int, int]:
    """(start, stop) of the piece whose own text begins at ``at``; marks: paragraph, sentence and word starts; end: of the item."""
    start = at
    if at != first and overlap:
        words, want = marks[2], at - overlap
        k = bisect_right(words, want)
        near = [w for w in words[max(0, k - 1) : k + 1] if abs(w - want) <= overlap // 4 and w < at]
        start = min(near, key=lambda w: abs(w - want)) if near else max(want, first)
    last = start + limit
    if end <= last:
        return start, end
    for m in marks:
        k = bisect_right(m, last)
        if k and m[k - 1] > at:
            return start, m[k - 1]
    return start, last


def cell_pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP, size: int = RANGE) -> list[tuple[int, int, int]]:
    """(start, core_start, end) of the pieces of a text."""
    m = cell_marks(text, size)
    at, out = 0, []
    while at < m.length:
        start, stop = piece_at(at, m.length, (m.starts, m.sentences, m.words), limit, overlap)
        out.append((start, at, stop))
        at = stop
    return out


def _check(limit: int, overlap: int) -> None:
    if not 0 <= 2 * overlap < limit:
        raise ValueError("twice the overlap must be less than the limit")


def split_cells(items: DataFrame, item: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP, size: int = RANGE) -> DataFrame:
    """(item, piece_no, start, core_start, end, piece) of the texts in a column."""
    _check(limit, overlap)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, t in zip(b["item"], b["t"]):
                found = cell_pieces(t, limit, overlap, size)
                yield pd.DataFrame({
                    "item": pd.Series([i] * len(found), dtype=object), "piece_no": range(1, len(found) + 1), "start": [x[0] for x in found], "core_start": [x[1] for x in found],
                    "end": [x[2] for x in found], "piece": pd.Series([t[a:z] for a, _, z in found], dtype=object),
                })

    rows = items.select(F.col(item).alias("item"), F.col(text).alias("t")).filter((F.length("t") > 0) & F.col("item").isNotNull())
    return rows.mapInPandas(run, f"item {dict(items.dtypes)[item]}, piece_no long, start long, core_start long, end long, piece string")


def long_paragraphs(items: DataFrame, item: str, text: str, limit: int = LIMIT, size: int = RANGE) -> DataFrame:
    """(item, para_no) of the paragraphs that cannot be kept in one piece: by the offsets of the stitched tables."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, t in zip(b["item"], b["t"]):
                m = cell_marks(t, size)
                rows += [(i, k) for k, (a, z) in enumerate(zip(m.starts, m.ends), 1) if z - a > limit]
            yield pd.DataFrame(rows, columns=["item", "para_no"], dtype=object)

    rows = items.select(F.col(item).alias("item"), F.col(text).alias("t")).filter((F.length("t") > limit) & F.col("item").isNotNull())
    return rows.mapInPandas(run, f"item {dict(items.dtypes)[item]}, para_no long")


# Files.


def _open(uri: str):
    """(open file, size) in any store that Arrow knows by its address; a path without scheme is local or a mounted share."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
    return store.open_input_file(path)


def _chars(f, start: int, end: int, size: int) -> str:
    """Characters that begin in bytes [start, end) of a file of the given size."""
    start, end = max(0, start), min(end, size)
    if start >= end:
        return ""
    data = f.read_at(min(end + 4, size) - start, start)
    skip, stop = 0, end - start
    while start and skip < min(4, len(data)) and data[skip] & 0xC0 == 0x80:
        skip += 1
    while stop < len(data) and data[stop] & 0xC0 == 0x80:
        stop += 1
    return data[skip:stop].decode("utf-8", "replace")


def _ahead(f, at: int, size: int, least: int) -> str:
    """At least so many characters from byte ``at`` on, and on to the first one behind closing marks and white space."""
    text, step = "", 4 * least + 64
    while at < size:
        text += _chars(f, at, at + step, size)
        at += step
        if len(text) >= least and _LOOK.match(text).group(1):
            break
        step *= 2
    return text


def file_ranges(spark: SparkSession, uris: list[str], size: int = FILE_RANGE) -> DataFrame:
    """(item, rng, bytes) of the byte ranges of files that every worker can open by address."""

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(u, _open(u).size()) for u in b["item"]], columns=["item", "bytes"], dtype=object)

    files = spark.createDataFrame([(u,) for u in sorted(set(uris))], "item string").mapInPandas(sizes, "item string, bytes long").filter("bytes > 0")
    plan = files.select("item", "bytes", F.explode(F.expr(f"sequence(0L, (bytes - 1) div {size})")).alias("rng"))
    return plan.repartition(parallelism(spark) * 2, "item", "rng")


def _scanned(ranges: DataFrame, size: int) -> DataFrame:
    """(item, rng, bytes, base, opens, later): where each range begins, in characters, and whether its first ink, and that of the next range with ink, opens a paragraph."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for u, r, total in zip(b["item"], b["rng"], b["bytes"]):
                with _open(u) as f:
                    t = boundaries(_chars(f, r * size, (r + 1) * size, total), "")
                rows.append((u, r, total, t.n, t.nl_lead, t.first is not None, t.nl_trail, t.nl_all))
            yield pd.DataFrame(rows, columns=["item", "rng", "bytes", "n", "nl_lead", "ink", "nl_trail", "nl_all"], dtype=object)

    s = cut(ranges.mapInPandas(run, "item string, rng long, bytes long, n long, nl_lead long, ink boolean, nl_trail long, nl_all long"))
    # Windows see a few numbers of each range.
    before = Window.partitionBy("item").orderBy("rng").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("blank_nl", F.coalesce(F.sum(F.when(~F.col("ink"), F.col("nl_all")).otherwise(0)).over(before), F.lit(0)))
    s = s.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    s = s.withColumn("prev", F.last(F.when(F.col("ink"), F.struct("nl_trail", "blank_nl")), ignorenulls=True).over(before))
    gap = F.col("prev.nl_trail") + F.col("blank_nl") - F.col("prev.blank_nl") + F.col("nl_lead")
    s = s.withColumn("opens", F.col("ink") & (F.col("prev").isNull() | (gap >= 2)))
    after = Window.partitionBy("item").orderBy("rng").rowsBetween(1, Window.unboundedFollowing)
    later = F.coalesce(F.first(F.when(F.col("ink"), F.col("opens")), ignorenulls=True).over(after), F.lit(False))
    return s.select("item", "rng", "bytes", "base", "opens", later.alias("later"))


class _Range:
    """A range with as much text before and behind it as its pieces reach; offsets count from the range's first character."""

    def __init__(self, uri: str, rng: int, total: int, opens: bool, next_opens: bool, size: int, limit: int, overlap: int):
        self.limit, self.overlap, self.rng = limit, overlap, rng
        with _open(uri) as f:
            before = _chars(f, rng * size - 8 * limit, rng * size, total)
            core = _chars(f, rng * size, (rng + 1) * size, total)
            ahead = _ahead(f, (rng + 1) * size, total, 2 * limit + 2 * overlap)
        self.n, self.back, self.text = len(core), len(before), before + core + ahead
        own = boundaries(core + ahead, "")
        m = _INK.search(core)
        starts = own.gap_starts if own.first is None or not opens or m is None else [m.start(), *own.gap_starts]
        whole = boundaries(self.text, "")
        shift = lambda xs: [x - self.back for x in xs]
        later = [x for x in shift(whole.gap_starts) if x >= self.n]
        if next_opens and whole.first is not None and whole.first - self.back >= self.n:
            later.append(whole.first - self.back)  # all before it is blank
        self.marks = (sorted({*[x for x in starts if x < self.n], *later}), shift(whole.sentences), shift(whole.words))
        self.end = len(core) + len(ahead) if self._last(uri, rng, total, size, ahead) else 2**62

    @staticmethod
    def _last(uri: str, rng: int, total: int, size: int, ahead: str) -> bool:
        return len(ahead.encode("utf-8", "replace")) >= total - (rng + 1) * size

    def chain(self, at: int) -> list[tuple[int, int, int]]:
        out = []
        first = 0 if self.rng == 0 else -(2**62)
        while at < self.n and at < self.end:
            start, stop = piece_at(at, self.end, self.marks, self.limit, self.overlap, first)
            out.append((start, at, stop))
            at = stop
        return out

    def entries(self) -> list[int]:
        """Every place below the limit at which a piece may enter: marks, or any place if a stretch has none for a piece."""
        if self.rng == 0:
            return [0]
        reach = self.limit - self.overlap - self.overlap // 4 - 1
        seen = [-self.back - 1, *[w for w in self.marks[2] if w < 2 * self.limit], 2 * self.limit]
        if any(b - a > reach for a, b in zip(seen, seen[1:])):
            return list(range(self.limit + 1))
        return sorted({x for m in self.marks for x in m[bisect_left(m, 0) : bisect_right(m, self.limit)]} | {0})

    def exits(self) -> tuple[list[int], list[int], list[int]]:
        """Runs of entries with one result: (first entry of the run, exit into the next range, pieces that begin here)."""
        known: dict[int, tuple[int, int]] = {}
        first = 0 if self.rng == 0 else -(2**62)

        def leave(at: int) -> tuple[int, int]:
            path = []
            while at < self.n and at < self.end and at not in known:
                path.append(at)
                at = piece_at(at, self.end, self.marks, self.limit, self.overlap, first)[1]
            to, count = known.get(at, (at, 0))
            for p in reversed(path):
                count += 1
                known[p] = (to, count)
            return to, count

        runs: tuple[list[int], list[int], list[int]] = ([], [], [])
        for e in self.entries():
            to, count = leave(e)
            if not runs[0] or (to - self.n, count) != (runs[1][-1], runs[2][-1]):
                for xs, x in zip(runs, (e, to - self.n, count)):
                    xs.append(x)
        return runs


def split_files(spark: SparkSession, uris: list[str], limit: int = LIMIT, overlap: int = OVERLAP, size: int = FILE_RANGE) -> DataFrame:
    """(item, piece_no, start, core_start, end, piece) of files by address; offsets count characters."""
    _check(limit, overlap)
    plan = cut(_scanned(file_ranges(spark, uris, size), size))
    spread = lambda df: df.repartition(parallelism(spark) * 2, "item", "rng")

    def leave(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(*r, *_Range(r.item, r.rng, r.bytes, r.opens, r.later, size, limit, overlap).exits()) for r in b.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=[*b.columns, "entry", "exit", "count"], dtype=object)

    kinds = "item string, rng long, bytes long, base long, opens boolean, later boolean"
    exits = spread(plan).mapInPandas(leave, f"{kinds}, entry array<long>, exit array<long>, count array<long>")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        item, at, number = None, 0, 0
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                if r.item != item:
                    item, at, number = r.item, 0, 0
                k = bisect_right(list(r.entry), at) - 1
                rows.append((r.item, r.rng, r.bytes, r.base, r.opens, r.later, at, number))
                at, number = int(r.exit[k]), number + int(r.count[k])
            yield pd.DataFrame(rows, columns=["item", "rng", "bytes", "base", "opens", "later", "at", "number"], dtype=object)

    ordered = exits.repartition("item").sortWithinPartitions("item", "rng")
    entered = cut(ordered.mapInPandas(scan, f"{kinds}, at long, number long"))

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                x = _Range(r.item, r.rng, r.bytes, r.opens, r.later, size, limit, overlap)
                found = x.chain(r.at)
                yield pd.DataFrame({
                    "item": pd.Series([r.item] * len(found), dtype=object), "piece_no": [r.number + k for k in range(1, len(found) + 1)], "start": [r.base + p[0] for p in found],
                    "core_start": [r.base + p[1] for p in found], "end": [r.base + p[2] for p in found],
                    "piece": pd.Series([x.text[x.back + a : x.back + z] for a, _, z in found], dtype=object),
                })

    return spread(entered).mapInPandas(emit, "item string, piece_no long, start long, core_start long, end long, piece string")
