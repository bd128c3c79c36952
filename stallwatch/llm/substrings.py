"""Removal of repeated passages: FM-indexes over shards of the text, searched by streamed segments.

A window of ``window`` words is filed under its smallest hash of 8 consecutive words (its anchor), so equal
windows meet under one anchor wherever they stand. Consecutive windows with one anchor form a segment.
Anchors that occur once cannot hold a repeated window and go no further. The different segments under
the other anchors are sharded by anchor; each shard builds a compressed FM-index of its segments and
streams them through it, which gives the covered word spans. Spans go back to the documents by the
segments' keys. Equal segments are counted before they move and indexed once.

The segments of an anchor that has too many for one index are cut again, level by level: a window is filed under its
smallest hashes in two orders, then in three, at last under the hash of all its words. Equal windows meet at every level, and
each goes through the index of its shard.

Words are told apart by 64-bit hashes, segments by the hashes of their words and of their anchor: 128 bits in all, so
that equal keys mean equal words also among 1e13 segments.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwatch.llm.fmindex import FMIndex
from stallwatch.llm.scratch import Scratch
from stallwatch.llm.words import SPACED, U64, Words, _powers, chunks, mix, rolling

GRAM = 8
#: Words in one FM-index; a single anchor's segments may exceed it.
INDEX_WORDS = 400_000
#: Different segments under an anchor from which on they are cut at the next level; bounds the index of one anchor.
ANCHOR_SEGMENTS = 50_000
#: Levels of anchors: hashes in one, two and three orders, and of whole windows.
LEVELS = 4


def _leftmost_least(grams: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest of each ``span`` consecutive hashes and its leftmost place, so that a repeat inside one window run counts twice."""
    least, place, width = grams, np.arange(len(grams)), 1
    while width < span:
        step = min(width, span - width)
        later = least[step:] < least[:-step]
        least, place = np.where(later, least[step:], least[:-step]), np.where(later, place[step:], place[:-step])
        width += step
    return least, place


def segment(text: pa.Array, window: int, level: int = 0) -> tuple[Words, np.ndarray, dict[str, np.ndarray]]:
    """Words, their hashes, and the segments of a chunk of documents: document, first word, windows, anchor, key.

    Segments of a level lie inside those of the level before it.
    """
    words = Words(text, SPACED)
    h, left = words.hashes(), words.left()
    none = np.zeros(0, np.int64)
    if len(h) < window:
        return words, h, {"doc": none, "at": none, "windows": none, "anchor": none.view(U64), "key": none.view(U64)}
    grams = rolling(h, GRAM)
    n = len(h) - window + 1
    valid = left[:n] >= window
    new = np.ones(n, bool)
    if level == LEVELS - 1:
        anchor = rolling(h, window)
    else:
        new[1:] = ~valid[:-1] | (left[1:n] != left[: n - 1] - 1)
        anchor = np.zeros(n, U64)
        for order in range(level + 1):
            least, place = _leftmost_least(mix(grams + U64(order)) if order else grams, window - GRAM + 1)
            new[1:] |= place[1:] != place[:-1]
            anchor = mix(least + anchor * U64(3))
    new &= valid
    at = np.flatnonzero(new)
    breaks = np.append(np.flatnonzero(new | ~valid), n)
    end = breaks[np.searchsorted(breaks, at, side="right")] if len(at) else at
    windows = end - at
    up, down = _powers(len(h) + 1)
    total = np.concatenate([[U64(0)], np.cumsum(h * up[: len(h)])])
    stop = at + windows + window - 1
    key = mix((total[stop] - total[at]) * down[at] + windows.astype(U64))
    return words, h, {"doc": words.document()[at] if len(at) else at, "at": at, "windows": windows, "anchor": anchor[at], "key": key}


def _occurrences(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            words, _, s = segment(batch.column(2), window)
            doc = pa.array(s["doc"])
            first = s["at"] - words.first[s["doc"]]
            columns = [pa.array(s["anchor"].view(np.int64)), pa.array(s["key"].view(np.int64)), batch.column(0).take(doc), batch.column(1).take(doc), pa.array(first, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "segment", "row_key", "id", "first"])

    return run


def _wanted_segments(batches: Iterator[pa.RecordBatch], window: int, level: int = 0) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[tuple[int, int, int, int, int, int]]]]:
    """Each chunk, its word hashes, and (first word, windows, anchor, key, n, document) of the wanted segments of each document, in order."""
    for batch in chunks(batches, "text"):
        _, h, s = segment(batch.column(2), window, level)
        wanted: list[dict] = [{(x["anchor"], x["segment"]): x["n"] for x in row} for row in batch.column(3).to_pylist()]
        rows = []
        for doc, at, windows, anchor, key in zip(s["doc"].tolist(), s["at"].tolist(), s["windows"].tolist(), s["anchor"].view(np.int64).tolist(), s["key"].view(np.int64).tolist()):
            n = wanted[doc].pop((anchor, key), None)
            if n:
                rows.append((at, windows, anchor, key, n, doc))
        yield batch, h, rows


def _contents(window: int, level: int = 0):
    """Words of the wanted segments of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, h, found in _wanted_segments(batches, window, level):
            rows = [(anchor, key, n, h[at : at + windows + window - 1].tobytes()) for at, windows, anchor, key, n, _ in found]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 4, types)], names=["anchor", "segment", "n", "words"])

    return run


def _finer(window: int, level: int):
    """The wanted segments of each document cut at ``level``: anchor at the level above, anchor and key, row, the segment, place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, found in _wanted_segments(batches, window):
            at, windows, anchor, key, n, doc = (np.array(c, np.int64) for c in (list(zip(*found)) or [[]] * 6))
            above, fine = (segment(batch.column(2), window, k)[2] for k in (level - 1, level))
            whole = np.searchsorted(at, fine["at"], side="right") - 1
            inside = np.flatnonzero(whole >= 0)
            inside = inside[fine["at"][inside] < (at + windows)[whole[inside]]]
            whole, place = whole[inside], fine["at"][inside]
            over = above["anchor"][np.searchsorted(above["at"], place, side="right") - 1]
            hashes = [pa.array(c.view(np.int64)) for c in (over, fine["anchor"][inside], fine["key"][inside])]
            columns = [*hashes, batch.column(0).take(pa.array(doc[whole])), pa.array(anchor[whole]), pa.array(key[whole]), pa.array(place - at[whole], pa.int32()), pa.array(n[whole])]
            yield pa.RecordBatch.from_arrays(columns, names=["above", "part", "part_key", "row_key", "anchor", "segment", "moved", "n"])

    return run


def _shard(window: int):
    """Covered spans of the segments of a shard. Rows come sorted by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def search() -> pa.RecordBatch:
            place: dict[bytes, int] = {}
            counts: list[int] = []
            for _, _, n, content in held:
                i = place.setdefault(content, len(place))
                if i == len(counts):
                    counts.append(0)
                counts[i] += n
            segments = [np.frombuffer(c, dtype=U64) for c in place]
            index = FMIndex(segments + [s for s, n in zip(segments, counts) if n > 1])
            spans = index.repeated(segments, window)
            out = [(anchor, key, [x for span in spans[place[content]] for x in span]) for anchor, key, _, content in held]
            out = [x for x in out if x[2]]
            columns = list(zip(*out)) or [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.list_(pa.int32())))], names=["anchor", "segment", "spans"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= INDEX_WORDS and row[0] != held[-1][0]:
                    yield search()
                    held, size = [], 0
                held.append(row)
                size += len(row[3]) // 8
        if held:
            yield search()

    return run


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, gone, kept = [], [], []
        for own, text, found in zip(*(batch.column(i).to_pylist() for i in range(3))):
            words = (text or "").encode().split()  # of bytes: ASCII white space only
            keep = np.ones(len(words), bool)
            for x in found or ():
                if x["id"] != own:
                    continue
                for s, e in zip(x["spans"][::2], x["spans"][1::2]):
                    keep[x["first"] + s : x["first"] + e] = False
            counts.append(len(words))
            gone.append(len(words) - int(keep.sum()))
            kept.append(b" ".join(compress(words, keep) if gone[-1] else words))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["id", "n_words", "n_removed", "kept_text"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """One row per row of ``docs``: id_col, n_words, n_removed, kept_text (kept words joined by a space).

    A word goes if it lies in a window of ``window`` words whose sequence starts at another place too, in any
    document, the same included. All occurrences go, the first as well. Null, empty and white texts have no
    words and an empty kept_text. Repeated rows are places of their own, so they lose all their windows.
    Null ids are rows like others. Extra columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    docs = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_key"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    occurrences = scratch.table(docs.select("row_key", "id", "text").mapInArrow(_occurrences(window), "anchor long, segment long, row_key long, id long, first int"), "occurrences")
    # Counted map-side and written, so that the join reads two shuffles and Spark can split an anchor with very many places.
    often = scratch.table(occurrences.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "often")
    places = scratch.table(occurrences.join(often, "anchor"), "places")
    scratch.drop("occurrences", "often")

    different = scratch.table(places.groupBy("anchor", "segment").agg(F.count("*").alias("n"), F.min("row_key").alias("row_key")), "different")
    hot = scratch.table(different.groupBy("anchor").agg(F.count("*").alias("m")).where(F.col("m") > ANCHOR_SEGMENTS).select("anchor"), "hot")

    def texts(segments: DataFrame) -> DataFrame:
        wanted = segments.groupBy("row_key").agg(F.collect_list(F.struct("anchor", "segment", F.least("n", F.lit(2)).alias("n"))).alias("wanted"))  # within one document
        # All of row_key, id and text, dealt out by row_key: the join at the end then reads the same shuffled copy of the texts.
        return docs.join(wanted, "row_key").select("row_key", "id", "text", "wanted")

    def searched(segments: DataFrame, level: int) -> DataFrame:
        contents = texts(segments).mapInArrow(_contents(window, level), "anchor long, segment long, n long, words binary")
        return contents.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_shard(window), "anchor long, segment long, spans array<int>")

    whole, level, tables = different, 1, ["different", "hot"]
    covered = searched(different.join(hot, "anchor", "left_anti"), 0)
    while level < LEVELS and not hot.isEmpty():
        if level == 1:
            whole = different.join(hot, "anchor", "left_semi")
        cut = texts(whole).mapInArrow(_finer(window, level), "above long, part long, part_key long, row_key long, anchor long, segment long, moved int, n long")
        cut = scratch.table(cut.join(hot.withColumnRenamed("anchor", "above"), "above", "left_semi").drop("above"), f"cut_{level}")
        parts = scratch.table(cut.groupBy("part", "part_key").agg(F.sum("n").alias("n"), F.min("row_key").alias("row_key")).select(F.col("part").alias("anchor"), F.col("part_key").alias("segment"), "n", "row_key"), f"parts_{level}")
        sizes = scratch.table(parts.groupBy("anchor").agg(F.count("*").alias("m"), F.sum("n").alias("n")).where("n > 1").drop("n"), f"sizes_{level}")
        last = level == LEVELS - 1  # an anchor has one window
        fits = F.lit(True) if last else F.col("m") <= ANCHOR_SEGMENTS
        spans = searched(parts.join(sizes.where(fits).select("anchor"), "anchor", "left_semi"), level).toDF("part", "part_key", "found")
        moved = cut.join(spans, ["part", "part_key"]).select("anchor", "segment", F.transform("found", lambda x: (x + F.col("moved")).cast("int")).alias("spans"))
        covered = covered.unionByName(moved.groupBy("anchor", "segment").agg(F.flatten(F.collect_list("spans")).alias("spans")))  # within one segment
        hot = scratch.table(sizes.where(~fits).select("anchor"), f"hot_{level}")
        again = cut.join(hot.withColumnRenamed("anchor", "part"), "part", "left_semi").select("anchor", "segment").distinct()
        whole = different.join(again, ["anchor", "segment"], "left_semi")
        tables += [f"{x}_{level}" for x in ("cut", "parts", "sizes", "hot")]
        level += 1
    covered = scratch.table(covered, "covered")
    scratch.drop(*tables)
    found = places.join(covered, ["anchor", "segment"]).select("row_key", "id", "first", "spans")
    # One list per text hash; ids are told apart inside it, so that both joins deal the texts out by row_key alone.
    found = found.distinct().groupBy("row_key").agg(F.collect_list(F.struct("id", "first", "spans")).alias("found"))
    both = docs.join(found, "row_key", "left").select("id", "text", "found")
    out = both.mapInArrow(_removed, "id long, n_words long, n_removed long, kept_text string")
    return out.withColumnRenamed("id", id_col)
