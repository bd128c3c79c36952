"""Benchmark decontamination with suffix arrays over the training text.

Every chunk of documents is a shard with a suffix array over its words, each suffix in the order of as many words as
a window has. Every suffix of the test items is looked up in it by binary search, on both sides; matches that follow one another on
one diagonal are joined into longest verbatim matches with their locations.

The array is sparse: it holds the places whose suffix begins with the same four words as some test suffix (or
with all words of a shorter item). A window that occurs at a place begins there with its own first four words, so a
place that is left out holds no occurrence, and none is lost; only the sorting of such places is saved.

The test items are the query set. Spark sorts them into blocks of bounded size, files in the shared folder; a task holds one
block and one stretch of documents at a time, and the documents pass once, without a shuffle. Nothing of the test
text goes through the driver but the names of the blocks.
"""

from __future__ import annotations

import io
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallwatch.llm.frames import free_name
from stallwatch.llm.scratch import Scratch, open_file, write_file
from stallwatch.llm.words import ALNUM, U64, Words, chunks, rolling

HEAD = 4
#: Text of a shard, shards of a stretch that meets one block of test items after another, test suffixes looked up at once.
SHARD_BYTES, STRETCH, AT_ONCE = 1 << 22, 8, 1 << 16
MATCH = "array<struct<item_id: string, item_word: int, doc_word: int, n_words: int>>"
FOUND = f"n_words long, n_hit long, items array<string>, matches {MATCH}"
FOUND_NAMES = ("n_words", "n_hit", "items", "matches")


class TestSuffixes:
    """The windows of a block of test items, ready to be looked up: some 50 bytes a word."""

    __test__ = False
    ARRAYS = ("words", "at", "length", "item", "place")

    def __init__(self, ids: list[str], texts: list[str | None], window: int):
        words = Words(pa.array(texts, pa.string()), ALNUM)
        h, left = words.hashes(fold_case=True), words.left()
        counts = np.repeat(words.counts, words.counts)
        at = np.flatnonzero((left >= window) | (counts == left) & (counts < window))
        item = words.document()[at]
        self.ids, self.window = ids, window
        self.words = np.concatenate([h, np.zeros(window, U64)])
        self.at, self.item, self.place = at.astype(np.int32), item.astype(np.int32), (at - words.first[item]).astype(np.int32)
        self.length = np.minimum(left[at], window).astype(np.int32)
        self.heads = {}
        for q in sorted({min(HEAD, int(n)) for n in np.unique(self.length)}):
            heads = np.unique(rolling(self.words, q)[self.at[np.minimum(self.length, HEAD) == q]])
            table = np.zeros(1 << 16, bool)
            table[(heads & U64(0xFFFF)).astype(np.int64)] = True
            self.heads[q] = (heads, table)

    def bounds(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest suffix that begin with test suffixes lo to hi, as byte strings."""
        low = self.words[self.at[lo:hi, None] + np.arange(self.window)]
        high = low.copy()
        short = np.arange(self.window) >= self.length[lo:hi, None]
        low[short], high[short] = 0, U64(0xFFFFFFFFFFFFFFFF)
        return _sortable(low), _sortable(high)

    def dump(self) -> bytes:
        heads = {f"heads{q}": h for q, (h, _) in self.heads.items()}
        out = io.BytesIO()
        np.savez(out, ids=np.frombuffer(json.dumps(self.ids).encode(), np.uint8), window=self.window, **heads, **{k: getattr(self, k) for k in self.ARRAYS})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> "TestSuffixes":
        new, arrays = cls.__new__(cls), np.load(io.BytesIO(data))
        new.ids, new.window = json.loads(arrays["ids"].tobytes()), int(arrays["window"])
        for k in cls.ARRAYS:
            setattr(new, k, arrays[k])
        new.heads = {}
        for name in arrays.files:
            if name.startswith("heads"):
                table = np.zeros(1 << 16, bool)
                table[(arrays[name] & U64(0xFFFF)).astype(np.int64)] = True
                new.heads[int(name.removeprefix("heads"))] = (arrays[name], table)
        return new


def _sortable(rows: np.ndarray) -> np.ndarray:
    """Rows of words as byte strings in the same order."""
    return np.ascontiguousarray(rows.astype(">u8")).view(f"S{8 * rows.shape[1]}").reshape(-1)


def suffix_array(h: np.ndarray, left: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
    """Places that begin like a test suffix, in the order of their suffixes, and those suffixes' first words."""
    begins = np.zeros(len(h), bool)
    for q, (heads, table) in tests.heads.items():
        grams = rolling(h, q)
        maybe = np.flatnonzero(table[(grams & U64(0xFFFF)).astype(np.int64)] & (left[: len(grams)] >= q))
        at = np.minimum(np.searchsorted(heads, grams[maybe]), len(heads) - 1)
        begins[maybe[heads[at] == grams[maybe]]] = True
    places = np.flatnonzero(begins)
    padded = np.concatenate([h, np.zeros(tests.window, U64)])
    rows = padded[places[:, None] + np.arange(tests.window)] if len(places) else np.zeros((0, tests.window), U64)
    rows[np.arange(tests.window) >= left[places][:, None]] = 0
    keys = _sortable(rows)
    order = np.argsort(keys, kind="stable")
    return places[order], keys[order]


class Shard:
    """The words of a chunk of documents, and what the blocks of test items have found in them so far."""

    def __init__(self, text: pa.Array):
        words = Words(text, ALNUM)
        self.first, self.counts, self.left = words.first, words.counts, words.left()
        self.h = words.hashes(fold_case=True)
        self.hit = np.zeros(len(self.h), bool)
        self.found: list[list[tuple]] = [[] for _ in range(len(text))]

    def look_up(self, tests: TestSuffixes) -> None:
        """Adds the matches (item id, item word, doc word, words) and hit words of a block of test items."""
        if not len(self.h) or not len(tests.length):
            return
        places, keys = suffix_array(self.h, self.left, tests)
        whose, where = [], []
        for lo in range(0, len(tests.length) if len(places) else 0, AT_ONCE):
            low, high = tests.bounds(lo, lo + AT_ONCE)
            first, last = np.searchsorted(keys, low, "left"), np.searchsorted(keys, high, "right")
            n = last - first
            whose.append(lo + np.repeat(np.arange(len(n)), n))
            where.append(places[np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)])
        if not whose:
            return
        which, at = np.concatenate(whose), np.concatenate(where)
        item, place, length = (x[which].astype(np.int64) for x in (tests.item, tests.place, tests.length))
        change = np.zeros(len(self.hit) + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + length, -1)
        self.hit |= np.cumsum(change)[:-1] > 0
        doc = np.searchsorted(self.first, at, side="right") - 1
        diagonal = at - place
        order = np.lexsort((at, diagonal, item))
        item, place, at, diagonal, doc, length = (x[order] for x in (item, place, at, diagonal, doc, length))
        new = np.ones(len(at), bool)
        new[1:] = (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (at[1:] != at[:-1] + 1)
        heads = np.flatnonzero(new)
        runs = np.diff(np.append(heads, len(at)))
        for i, run in zip(heads, runs):
            self.found[doc[i]].append((tests.ids[item[i]], int(place[i]), int(at[i] - self.first[doc[i]]), int(length[i] + run - 1)))

    def n_hit(self) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(self.hit)])
        return total[self.first[1:]] - total[self.first[:-1]]


def test_blocks(benchmark: DataFrame, item_id_col: str, item_text_col: str, window: int, block_chars: int, scratch: Scratch) -> list[str]:
    """Files of the test suffixes, each of about ``block_chars`` characters of items, made by tasks."""
    items = benchmark.select(F.coalesce(F.col(item_id_col).cast("string"), F.lit("null")).alias("item_id"), F.col(item_text_col).alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = int(chars // block_chars) + 1
    folder = scratch.path("blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, ids, texts, size = [], [], [], 0

        def close() -> None:
            nonlocal ids, texts, size
            context = TaskContext.get()
            name = f"{folder}/{context.partitionId()}-{context.taskAttemptId()}-{len(made)}.npz"
            write_file(name, TestSuffixes(ids, texts, window).dump())
            made.append(name)
            ids, texts, size = [], [], 0

        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(item)
                texts.append(text)
                size += len(text or "")
                if size >= block_chars:
                    close()
        if ids:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], names=["block"])

    rows = items.repartition(n, F.xxhash64("item_id", "text")).mapInArrow(run, "block string")
    return sorted(r[0] for r in scratch.table(rows, "names").collect())


test_blocks.__test__ = False


def _scanned(docs: DataFrame, benchmark: DataFrame, names: list[str], added: str, result: Callable[[Shard], list[pa.Array]], text_col: str, item_id_col: str, item_text_col: str, window: int, block_chars: int) -> DataFrame:
    """``names`` of ``docs`` and the columns ``added``, which ``result`` makes of each shard after all blocks."""
    scratch = Scratch(docs.sparkSession, "decontamination")
    blocks = test_blocks(benchmark, item_id_col, item_text_col, window, block_chars, scratch)
    text = text_col if text_col in names else free_name("text", names)
    carried = docs.select(*names) if text_col in names else docs.select(*names, F.col(text_col).alias(text))
    schema = T.StructType([docs.schema[c] for c in names] + list(T.StructType.fromDDL(added)))
    column = carried.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now: tuple[str, TestSuffixes] | None = None

        def judged() -> Iterator[pa.RecordBatch]:
            nonlocal now
            shards = [Shard(batch.column(column)) for batch in held]
            for name in blocks:
                if now is None or now[0] != name:
                    now = None  # one block at a time
                    with open_file(name) as stream:
                        now = name, TestSuffixes.load(stream.read())
                for shard in shards:
                    shard.look_up(now[1])
            for batch, shard in zip(held, shards):
                yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(names))] + result(shard), names=schema.names)

        for batch in chunks(batches, text, SHARD_BYTES):
            held.append(batch)
            if len(held) >= (STRETCH if len(blocks) > 1 else 1):
                yield from judged()
                held = []
        if held:
            yield from judged()

    return carried.mapInArrow(run, schema)


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = 13, block_chars: int = 8_000_000, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with n_words, n_hit, items (sorted as strings) and matches.

    A word of a document is hit if it lies in a verbatim occurrence of a window of ``window`` words of an
    item, or of a whole item that is shorter. matches are the longest runs of such occurrences: item, word
    of the item, word of the document and length, in order. A null or empty text has no words and no
    matches; so has a null item text. Items without an id match as the item "null". Repeated documents each
    get their row; repeated items count once per id. ``keep`` names the columns to carry along (default all);
    those named like a new column give way. block_chars bounds the test text held by a task; more test text
    means more blocks that a task reads one after another, never less work.
    """
    match_type = pa.list_(pa.struct([("item_id", pa.string()), ("item_word", pa.int32()), ("doc_word", pa.int32()), ("n_words", pa.int32())]))

    def result(shard: Shard) -> list[pa.Array]:
        matches = [sorted(set(m), key=lambda x: (x[2], x[0], x[1], x[3])) for m in shard.found]
        items = pa.array([sorted({x[0] for x in m}) for m in matches], pa.list_(pa.string()))
        as_dicts = pa.array([[dict(zip(("item_id", "item_word", "doc_word", "n_words"), x)) for x in m] for m in matches], match_type)
        return [pa.array(shard.counts, pa.int64()), pa.array(shard.n_hit(), pa.int64()), items, as_dicts]

    names = [c for c in (docs.columns if keep is None else keep) if c not in FOUND_NAMES]
    return _scanned(docs, benchmark, names, FOUND, result, text_col, item_id_col, item_text_col, window, block_chars)


def contaminated() -> "F.Column":
    """The rule: some word is hit, and at least one in twenty."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = 13, block_chars: int = 8_000_000) -> DataFrame:
    """The documents that are not contaminated (see ``contaminated``), with their own columns, whatever their names."""

    def result(shard: Shard) -> list[pa.Array]:
        n = shard.n_hit()
        return [pa.array((n > 0) & (20 * n >= shard.counts))]

    bad = free_name("contaminated", docs.columns)
    return _scanned(docs, benchmark, docs.columns, f"{bad} boolean", result, text_col, item_id_col, item_text_col, window, block_chars).where(~F.col(bad)).select(*docs.columns)
