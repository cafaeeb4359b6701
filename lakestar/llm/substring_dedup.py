"""Substring dedup: relative Lempel-Ziv parsing of every document against all documents before it.

Words are runs of bytes other than space and 0x09-0x0D, unchanged. The reference of a document is every document with a smaller id, each one
a block. A document is factored greedily from left to right: where WINDOW words stand that also stand in a block, a factor starts, and it
is extended as long as the next window stands in the same block; else the word is a literal and the parse moves on by one. At
a factor's end the windows over the boundary are looked up too, so a run that goes on in another block is not missed. A factor has
WINDOW words at least, and each word in a factor is a duplicate. The index has no places, so a factor's windows all stand in its block, but not always side by side.

The index is distributed, as the reference is the corpus itself:

1. Each window has an anchor, the smallest hash of its ten 4-word runs, so equal windows have equal anchors, and a document has far fewer
   distinct anchors than windows. Only windows with an anchor that stands in two documents can be duplicates.
2. Those windows are hashed and indexed: hash -> smallest id of a document that has it (a partial minimum before the shuffle, so a passage that
   a third of all documents share moves as a row for each task).
3. Each document gets the blocks of its windows and is parsed by itself, in one pass.

Defined results: a null text has no words and its kept text is empty; documents under WINDOW words keep all; rows with the same id don't count as before one
another; rows without an id are before and behind none, so they keep all their words and take none of others; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, written
from .shingles import runs, word_hashes_of

WINDOW = 13
SEED_WORDS = 4


def windows_of(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of several texts' words, one text after the other: hash and anchor of each window, and the number of the text it is in."""
    windows, seeds = runs(words, WINDOW), runs(words, SEED_WORDS)
    anchors = seeds[:len(windows)]
    for j in range(1, WINDOW - SEED_WORDS + 1):
        anchors = np.minimum(anchors, seeds[j:len(windows) + j])
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    whole = text[:len(windows)] == text[WINDOW - 1:]  # not over the end of a text
    return windows[whole], anchors[whole], text[:len(windows)][whole]


def parse(windows: np.ndarray, known: np.ndarray, blocks: np.ndarray) -> list[tuple[int, int, int]]:
    """Factors (first word, words, block) of a document with these ``windows``; ``known`` window hashes stand in ``blocks``."""
    if not len(known) or not len(windows):
        return []
    order = np.argsort(known)
    known, blocks = known[order], blocks[order]
    at = np.minimum(np.searchsorted(known, windows), len(known) - 1)
    hit = np.flatnonzero(known[at] == windows)
    if not len(hit):
        return []
    block = blocks[at[hit]]
    cut = np.flatnonzero((np.diff(hit) != 1) | (np.diff(block) != 0)) + 1
    first, last = np.concatenate(([0], cut)), np.concatenate((cut, [len(hit)])) - 1
    return [(int(hit[i]), int(hit[j] - hit[i]) + WINDOW, int(block[i])) for i, j in zip(first, last)]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for first, words, ends in word_hashes_of(x.as_py() for x in batch.column(1)):
            _, anchors, text = windows_of(words, ends)
            new = np.ones(len(anchors), dtype=bool)  # windows side by side mostly have the same
            new[1:] = (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(anchors[new].view(np.int64)), pa.array(ids[first + text[new]])], names=["anchor", "id"])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, text, anchors -> window, id for the windows with one of these anchors. That an anchor is shared holds for all
    texts that have it, so the anchors of texts that are hashed together can be looked up together."""
    for batch in batches:
        ids, offsets = batch.column(0).to_numpy(), batch.column(2).offsets.to_numpy()
        shared = batch.column(2).values.to_numpy(zero_copy_only=False).view(np.uint64)
        for first, words, ends in word_hashes_of(x.as_py() for x in batch.column(1)):
            windows, anchors, text = windows_of(words, ends)
            known = np.isin(anchors, shared[offsets[first]:offsets[first + len(ends)]])
            yield pa.RecordBatch.from_arrays([pa.array(windows[known].view(np.int64)), pa.array(ids[first + text[known]])], names=["window", "id"])


def _factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, text, hits -> id, n_words, n_removed, factors, kept_text."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("block", pa.int64())]))
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            counts, removed, factors, kept = [], [], [], []
            texts = [x.as_py() for x in batch.column(1)]
            windows = [w for _, words, ends in word_hashes_of(texts) for w in _split(words, ends)]
            for text, own, hits in zip(texts, windows, batch.column(2)):
                words = (text or "").encode("utf-8").split()
                found = []
                if hits.is_valid and len(hits.values):
                    pairs = hits.values
                    found = parse(own, pairs.field(0).to_numpy(zero_copy_only=False).view(np.uint64), pairs.field(1).to_numpy(zero_copy_only=False))
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                for start, n, _ in found:
                    gone[start] += 1
                    gone[start + n] -= 1
                keep = np.cumsum(gone[:-1]) == 0 if found else None
                counts.append(len(words))
                removed.append(int((~keep).sum()) if found else 0)
                factors.append([{"start": a, "words": n, "block": b} for a, n, b in found])
                kept.append(b" ".join([words[i] for i in np.flatnonzero(keep)] if found else words).decode("utf-8"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(factors, kind),
                                              pa.array(kept, pa.string())], names=["id", "n_words", "n_removed", "factors", "kept_text"])


def _split(words: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """The windows of each text."""
    windows, _, text = windows_of(words, ends)
    return np.split(windows, np.searchsorted(text, np.arange(1, len(ends))))


def factor_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_removed, factors (array of start, words, block) and kept_text (the other words, joined by a space): a row for each row."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    named = texts.where("id is not null")
    anchors = named.mapInArrow(_anchors, "anchor bigint, id bigint")
    shared = anchors.groupBy("anchor").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    shared = written(shared.where("low < high").select("anchor"), "substring-anchors")
    of_doc = written(anchors.join(shared, "anchor", "left_semi").groupBy("id").agg(F.collect_set("anchor").alias("anchors")), "substring-suspects")
    suspects = named.join(of_doc, "id").select("id", "text", "anchors")
    windows = written(suspects.mapInArrow(_candidates, "window bigint, id bigint"), "substring-windows")
    index = windows.groupBy("window").agg(F.min("id").alias("block"), F.max("id").alias("high"))
    index = written(index.where("block < high").select("window", "block"), "substring-index")
    hits = windows.join(index, "window").where("block < id").groupBy("id").agg(F.collect_set(F.struct("window", "block")).alias("hits"))
    hits = written(hits, "substring-hits")
    return texts.join(hits, "id", "left").select("id", "text", "hits").mapInArrow(
        _factor, "id bigint, n_words bigint, n_removed bigint, factors array<struct<start: bigint, words: bigint, block: bigint>>, kept_text string")
