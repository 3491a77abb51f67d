"""Evaluation texts leaking into training text (problem 8).

Method: a CGK random-walk embedding maps the edit distance of two word windows to the Hamming distance of their
embeddings; bit-sampling LSH over the embeddings, repeated with fresh walks and samples, finds candidate windows at the
target recall; every candidate is verified by its exact edit distance in words. Windows slide over each document word by
word. Windows equal word for word have equal embeddings under every walk, so runs without edits are found with recall 1;
with edits, ``repetitions`` follows from the target recall (``repetitions_for``; measured against brute force in the tests).

An edit is one word put in, left out or changed: a window of an item is compared with the text from a word of the document
on, and what stands behind the passage costs nothing. A window with e edits shares at least window - e words with an item,
so windows with more words foreign to all items are passed over before they are embedded: that loses nothing. The items are
the stated query set; their windows and LSH keys are written once as a table in the shared folder, in blocks; every task
reads one block at a time, so neither the driver nor a broadcast holds the index, and a document is read once for all blocks.

Words are runs of letters and digits without case and accents; a word cut by a hyphen (hyphen-minus, U+2010 or soft
hyphen) at a line end is whole. As a compound may end a line at its own hyphen, texts with such hyphens are read both
ways; both readings count places by the words of the joined one. An item window that stands in more than ``max_items`` items
does not count.

Defined results: null, blank and shorter texts than a window give no row; repeated documents each give their rows; whole
texts are read, very long ones in slices that no word and no window is lost at; empty tables give empty results.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from math import ceil, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studyloom.session import checkpoint_dir

BLOCK_WINDOWS = 1_000_000
SLICE = 2_000_000
PROBE, VERIFY = 20_000, 50_000  # windows probed and candidate pairs verified at once
STRETCH = 3  # steps of the walk for each word of a window

_WORD = re.compile(r"[^\W_]+")
_CUT = re.compile("[-‐­][ \t\f]*\r?\n\\s*")
_MARKS = re.compile("[̀-ͯ]+")
_SAFE = re.compile(r"[^\W_] (?=[^\W_])")


def _words(text: str) -> list[str]:
    """Comparable words of a text without cut words."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.replace("­", ""))
        text = _MARKS.sub("", "".join(c for c in text if not unicodedata.combining(c)) if any(map(unicodedata.combining, text)) else text)
        return _WORD.findall(text.casefold())
    return _WORD.findall(text.lower())


def readings(text: str) -> list[tuple[list[str], np.ndarray]]:
    """(words, place of each word from 0) with cut words joined and, if any word is cut, also with their parts apart. The two parts
    of a word have its place."""
    if "\n" not in text or not _CUT.search(text):
        ws = _words(text)
        return [(ws, np.arange(len(ws)))]
    whole, apart, place = [], [], []
    fuse = False
    for part in _CUT.split(text):
        ws = _words(part)
        if not ws:
            fuse = False
            continue
        if fuse and _WORD.match(part.lstrip("­")[:1]):
            whole[-1] += ws[0]
        else:
            whole.append(ws[0])
        apart.append(ws[0])
        place.append(len(whole) - 1)
        for w in ws[1:]:
            whole.append(w)
            apart.append(w)
            place.append(len(whole) - 1)
        fuse = bool(_WORD.match(part.rstrip("­")[-1:]))
    return [(whole, np.arange(len(whole))), (apart, np.array(place))]


def words_of(text: str) -> list[str]:
    """Words with cut words joined."""
    return readings(text)[0][0]


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """The text in slices cut at a space between two letters or digits; a stretch without one stays whole."""
    at = 0
    while at < len(text):
        m = _SAFE.search(text, at + size)
        end = m.end() if m else len(text)
        yield text[at:end]
        at = end


def word_id(word: str) -> int:
    return int.from_bytes(blake2b(word.encode("utf-8", "replace"), digest_size=8).digest(), "little") >> 1 or 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(ids: np.ndarray, starts: np.ndarray, window: int, rep: int, sample: int) -> np.ndarray:
    """LSH keys of the windows at starts: hash of ``sample`` symbols of the CGK embedding of walk ``rep``."""
    rng = np.random.default_rng(1000 + rep)
    steps = STRETCH * window
    chosen = set(rng.choice(steps, size=min(sample, steps), replace=False).tolist())
    seeds = rng.integers(1, 2**63, size=steps, dtype=np.uint64)
    at = np.zeros(len(starts), np.int64)
    sig = np.full(len(starts), 1469598103934665603, np.uint64)
    for j in range(steps):
        inside = at < window
        symbol = np.where(inside, ids[starts + np.minimum(at, window - 1)], -1).astype(np.uint64)
        if j in chosen:
            sig = _mix(sig * np.uint64(1099511628211) + symbol)
        at += inside & ((_mix(symbol ^ seeds[j]) & np.uint64(1)) > 0)
    return sig


def repetitions_for(recall: float, window: int, max_edits: int, sample: int) -> int:
    """Repetitions that reach the recall: a walk passes an edit with a chance of about one half without falling apart."""
    if max_edits == 0:
        return 1
    far = min(0.9, max_edits * 4.5 / (STRETCH * window))  # usual share of differing symbols of the embedding
    hit = 0.5 * (1 - far) ** sample
    return max(1, ceil(log(1 - recall) / log(1 - hit)))


def edit_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least edits that turn row i of b (an item's window) into a beginning of row i of a (the document from a word on)."""
    n, m = len(b), a.shape[1]
    row = np.tile(np.arange(m + 1, dtype=np.int16), (n, 1))
    for i in range(b.shape[1]):
        prev = row[:, 0].copy()
        row[:, 0] = i + 1
        for j in range(m):
            best = np.minimum(np.minimum(row[:, j + 1], row[:, j]) + 1, prev + (b[:, i] != a[:, j]))
            prev = row[:, j + 1].copy()
            row[:, j + 1] = best
    return row.min(axis=1)


class Index:
    """Windows of a block of items by LSH key, one sorted table for each repetition."""

    def __init__(self, items: np.ndarray, positions: np.ndarray, words: list[list[str]], keys: np.ndarray, window: int, sample: int):
        """keys: one row a window, one column a repetition."""
        self.window, self.sample = window, sample
        self.vocab = {w: word_id(w) for ws in words for w in ws}
        if len(set(self.vocab.values())) < len(self.vocab):
            raise ValueError("two words have one id")
        self.grams = np.array([[self.vocab[w] for w in ws] for ws in words], np.int64).reshape(len(words), window)
        self.item, self.pos = items, positions
        self.tables = []
        for sig in keys.T:
            order = np.argsort(sig, kind="stable")
            self.tables.append((sig[order], order))

    def search(self, ids: np.ndarray, starts: np.ndarray, max_edits: int) -> np.ndarray:
        """Rows (start, item window, edits) of all verified candidates; ids end in window + max_edits words of no text."""
        pairs = []
        for rep, (keys, order) in enumerate(self.tables):
            sig = signatures(ids, starts, self.window, rep, self.sample).view(np.int64)
            lo, hi = np.searchsorted(keys, sig, "left"), np.searchsorted(keys, sig, "right")
            hit = np.nonzero(hi > lo)[0]
            n = hi[hit] - lo[hit]
            gram = order[np.repeat(lo[hit], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))]
            pairs.append(np.repeat(starts[hit], n) * len(self.grams) + gram)
        once = np.unique(np.concatenate(pairs))
        s, g = once // len(self.grams), once % len(self.grams)
        out = [np.zeros((0, 3), np.int64)]
        for k in range(0, len(once), VERIFY):
            a = ids[s[k : k + VERIFY, None] + np.arange(self.window + max_edits)]
            e = edit_distances(a, self.grams[g[k : k + VERIFY]])
            ok = e <= max_edits
            out.append(np.column_stack([s[k : k + VERIFY][ok], g[k : k + VERIFY][ok], e[ok]]))
        return np.concatenate(out)


def item_windows(items: DataFrame, window: int, max_items: int) -> DataFrame:
    """(item_id, pos, words) of the item windows that stand in at most max_items items."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, t in zip(b["item_id"], b["text"]):
                ws = words_of(t) if isinstance(t, str) else []
                rows += [(i, p + 1, ws[p : p + window]) for p in range(len(ws) - window + 1)]
            yield pd.DataFrame(rows, columns=["item_id", "pos", "words"], dtype=object)

    grams = items.select("item_id", "text").mapInPandas(run, "item_id long, pos long, words array<string>")
    common = grams.select("words", "item_id").distinct().groupBy("words").count().filter(F.col("count") > max_items)
    return grams.join(common.select("words"), "words", "left_anti")


def write_index(items: DataFrame, window: int, max_items: int, sample: int, repetitions: int, block_windows: int = BLOCK_WINDOWS) -> tuple[str, int]:
    """(folder, blocks): the items' windows with their LSH keys, one folder a block, in the shared folder."""
    spark = items.sparkSession

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids = np.array([word_id(w) for ws in b["words"] for w in ws], np.int64)
            starts = np.arange(len(b)) * window
            keys = [signatures(ids, starts, window, r, sample).view(np.int64) for r in range(repetitions)] if len(b) else []
            yield pd.DataFrame({"item_id": b["item_id"], "pos": b["pos"], "words": b["words"], "keys": pd.Series([list(k) for k in zip(*keys)], dtype=object)})

    grams = item_windows(items, window, max_items)
    folder = f"{checkpoint_dir(spark)}/leaks-{uuid.uuid4().hex}"
    table = grams.mapInPandas(keyed, "item_id long, pos long, words array<string>, keys array<long>")
    table.write.parquet(f"{folder}/all")
    n = spark.read.parquet(f"{folder}/all").count()
    blocks = max(1, -(-n // block_windows))
    if blocks == 1:
        return f"{folder}/all", 1
    of = F.pmod(F.xxhash64("item_id", "pos"), F.lit(blocks))
    spark.read.parquet(f"{folder}/all").withColumn("block", of).repartition("block").write.partitionBy("block").parquet(f"{folder}/blocks")
    return f"{folder}/blocks", blocks


@lru_cache(maxsize=1)
def load_block(folder: str, block: int, blocks: int, window: int, sample: int) -> Index | None:
    """One block of the index in this worker; None if it is empty."""
    import pyarrow.dataset as ds
    from pyarrow import fs

    uri = folder if blocks == 1 else f"{folder}/block={block}"
    store, path = fs.FileSystem.from_uri(uri) if ":" in uri.split("/")[0] else (fs.LocalFileSystem(), uri)
    if store.get_file_info(path).type != fs.FileType.Directory:
        return None
    t = ds.dataset(path, filesystem=store, format="parquet").to_table(columns=["item_id", "pos", "words", "keys"])
    if not len(t):
        return None
    keys = t["keys"].combine_chunks().flatten().to_numpy().reshape(len(t), -1)
    return Index(t["item_id"].to_numpy(), t["pos"].to_numpy(), t["words"].to_pylist(), keys, window, sample)


def _read(docs: pd.DataFrame, window: int) -> Iterator[tuple[object, np.ndarray, list[str]]]:
    """(doc_id, places, words) of every reading of every document."""
    for d, t in zip(docs["doc_id"].tolist(), docs["text"]):
        if not isinstance(t, str) or len(t) < window:
            continue
        found: list[list] = []
        ahead = 0
        for part in slices(t):
            both = readings(part)
            found.append([both[0], both[-1]])
            for k in (0, 1):
                found[-1][k] = (found[-1][k][0], found[-1][k][1] + ahead)
            ahead += len(both[0][0])
        ways = (0, 1) if "\n" in t and _CUT.search(t) else (0,)
        for k in ways:
            words = [w for part in found for w in part[k][0]]
            if len(words) >= window:
                yield d, np.concatenate([part[k][1] for part in found]), words


def leaks(
    docs: DataFrame, items: DataFrame, window: int = 12, max_edits: int = 0, max_items: int = 3, recall: float = 0.95,
    sample: int = 0, repetitions: int = 0, block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """(doc_id, item_id, doc_pos, item_pos, edits): places of documents within max_edits of a window of an item."""
    sample = sample or (2 * window if max_edits == 0 else max(4, window // max_edits))
    repetitions = repetitions or max(2, repetitions_for(recall, window, max_edits, sample))
    folder, blocks = write_index(items, window, max_items, sample, repetitions, block_windows)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            read = list(_read(b, window))
            for block in range(blocks if read else 0):
                ix = load_block(folder, block, blocks, window, sample)
                if ix is None:
                    continue
                get, parts = ix.vocab.get, []
                none = np.zeros(window + max_edits, np.int64)  # of no text, between the texts
                for _, _, words in read:
                    parts += [np.array([get(w, 0) for w in words], np.int64), none]
                ids = np.concatenate(parts)
                lens = np.array([len(words) for _, _, words in read])
                first = np.cumsum(lens + len(none)) - lens - len(none)
                place = np.concatenate([x for _, p, _ in read for x in (p, none)])
                owner = np.array([d for d, _, _ in read])
                starts = np.arange(len(ids) - window + 1)
                known = np.concatenate([[0], np.cumsum(ids > 0)])
                # A passage that lacks words may be shorter than a window and end the text.
                starts = starts[known[window:] - known[:-window] >= window - max_edits]
                for k in range(0, len(starts), PROBE):
                    s, g, e = ix.search(ids, starts[k : k + PROBE], max_edits).T
                    w = np.searchsorted(first, s, "right") - 1
                    yield pd.DataFrame({
                        "doc_id": owner[w], "item_id": ix.item[g], "doc_pos": place[s] + 1, "item_pos": ix.pos[g], "edits": e.astype("int32"),
                    })

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, item_id long, doc_pos long, item_pos long, edits int")


def leaked_pairs(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """(doc_id, item_id, n_windows, first_pos, last_pos, least_edits): every document with the items that leaked into it."""
    return leaks(docs, items, **how).groupBy("doc_id", "item_id").agg(
        F.countDistinct("doc_pos").alias("n_windows"), F.min("doc_pos").alias("first_pos"), F.max("doc_pos").alias("last_pos"),
        F.min("edits").alias("least_edits"),
    )


def leaked_items(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """(item_id, n_docs, n_windows) of every item: how many documents carry a passage of it; 0 if it did not leak."""
    found = leaked_pairs(docs, items, **how).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_windows").alias("n_windows"))
    return items.select("item_id").distinct().join(found, "item_id", "left").fillna(0, ["n_docs", "n_windows"])
