"""Ranked lexical search of many items at once, by evaluating what they share only once.

An item's score in a document is a sum over its terms. A term that an item holds q times is q elements (term, 1) to
(term, q), all worth the same, so that items which repeat a term share its first elements with those that do not. The
items of a block are cut into shared sets:

1. Elements that stand in exactly the same items are one set, a leaf.
2. The two nodes that stand together in most items become a node of their own in all of these, again and again, until no two
   nodes stand together in more than one item. That is the sharing graph: a node is the sum of two nodes below it.
3. An item is the sum of the nodes left to it.

A chunk of documents gets one accumulator for each leaf, from the terms it holds; each further node adds two
accumulators once, whatever number of items use it; an item adds up its nodes. Scores are whole numbers, so it makes no
difference in which order they are added.

The documents are read twice and never move: once to count in how many of them each term of an item stands, and once
to be scored. Each task keeps the best documents of each item, and Spark ranks those.
"""

from __future__ import annotations

import heapq
import io
import json
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallwatch.llm.scratch import Scratch, open_file, write_file
from stallwatch.llm.words import ALNUM, U64, Words, chunks

#: Bits of the table that keeps terms of no item out of the counts; a fixed size, whatever the items.
SIEVE_BITS = 18
#: Different terms of the items of a block. A single longer item is a block of its own.
BLOCK_TERMS = 20_000
#: Pairs of an item's nodes are looked for among so many neighbours in order of how many items hold them.
NEIGHBOURS = 32
#: Cells (node, document) of accumulators held at once; chunks of documents that meet one block after another.
CELLS, STRETCH = 1 << 22, 8
#: Rows that a task holds back before it sends them on.
HELD_ROWS = 1 << 20


def term_counts(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, occurrences) of a chunk of texts, and each text's number of terms."""
    words = Words(text, ALNUM)
    h, doc = words.hashes(fold_case=True), words.document()
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], h[at], np.diff(np.append(at, len(h))), words.counts


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        item, term, n, _ = term_counts(batch.column(1))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(item)), pa.array(term.view(np.int64)), pa.array(n)], names=["item", "term", "repeats"])


class Sieve:
    """Which terms may stand in an item: a bit for the low bits of each."""

    def __init__(self, slots: list[int]):
        self.table = np.zeros(1 << SIEVE_BITS, bool)
        self.table[slots] = True

    def passes(self, terms: np.ndarray) -> np.ndarray:
        return self.table[(terms & U64((1 << SIEVE_BITS) - 1)).astype(np.int64)]


def _counts(sieve: Sieve):
    """(term, documents that hold it, words): counts of each task, merged as they grow; a null term has the documents with terms and all their words."""

    def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        terms, inverse = np.unique(np.concatenate([t for t, _ in held]), return_inverse=True)
        return terms, np.bincount(inverse, np.concatenate([n for _, n in held]), len(terms)).astype(np.int64)

    def rows(terms: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n), pa.nulls(len(n), pa.int64())], names=["term", "docs", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, docs, all_words = [], 0, 0, 0
        for batch in chunks(batches, "text"):
            _, term, _, counts = term_counts(batch.column(0))
            docs, all_words = docs + int((counts > 0).sum()), all_words + int(counts.sum())
            terms, n = np.unique(term[sieve.passes(term)], return_counts=True)
            held.append((terms, n))
            size += len(terms)
            if size > HELD_ROWS:
                held = [merged(held)]
                size = len(held[0][0])
                if size > HELD_ROWS // 2:
                    yield rows(*held[0])
                    held, size = [], 0
        if held:
            yield rows(*merged(held))
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([docs], pa.int64()), pa.array([all_words], pa.int64())], names=["term", "docs", "words"])

    return run


def share(elements: list[list[int]], count: int) -> tuple[np.ndarray, list[tuple[int, int]], list[list[int]]]:
    """The sharing graph of items given as lists of elements 0 to count - 1.

    Returns the leaf of each element, the pairs of nodes that make up each further node, and the nodes of each item. Each
    item's nodes hold its elements once each.
    """
    holders: dict[int, list[int]] = defaultdict(list)
    for item, own in enumerate(elements):
        for e in own:
            holders[e].append(item)
    leaves: dict[tuple[int, ...], int] = {}
    leaf = np.zeros(count, np.int64)
    for e in sorted(holders):
        leaf[e] = leaves.setdefault(tuple(holders[e]), len(leaves))
    # Items as bits of a number: what stands together is one `and`.
    items_of = [sum(1 << i for i in key) for key in leaves]
    nodes: list[set[int]] = [{int(leaf[e]) for e in own} for own in elements]
    made: list[tuple[int, int]] = []

    def neighbours(own: set[int]) -> list[int]:
        return sorted((x for x in own if items_of[x].bit_count() > 1), key=lambda x: (-items_of[x].bit_count(), x))

    heap, seen = [], set()

    def offer(a: int, b: int) -> None:
        pair = (min(a, b), max(a, b))
        together = (items_of[a] & items_of[b]).bit_count()
        if together > 1 and pair not in seen:
            seen.add(pair)
            heapq.heappush(heap, (-together, *pair))

    for own in nodes:
        row = neighbours(own)
        for i, a in enumerate(row):
            for b in row[i + 1 : i + 1 + NEIGHBOURS]:
                offer(a, b)
    while heap:
        n, a, b = heapq.heappop(heap)
        both = items_of[a] & items_of[b]
        if both.bit_count() < -n:  # others have taken some of its items
            seen.discard((a, b))
            offer(a, b)
            continue
        new = len(items_of)
        made.append((a, b))
        items_of.append(both)
        items_of[a] ^= both
        items_of[b] ^= both
        around = set()
        while both:
            item = (both & -both).bit_length() - 1
            both &= both - 1
            nodes[item] -= {a, b}
            around.update(neighbours(nodes[item])[:NEIGHBOURS])
            nodes[item].add(new)
        for x in around:
            offer(new, x)
    return leaf, made, [sorted(own) for own in nodes]


class Block:
    """The items of a block: their terms with weights, and the sharing graph, ready to be evaluated."""

    ARRAYS = ("terms", "weights", "begin", "leaf", "left", "right", "levels", "nodes", "ends", "rows", "sizes")

    @classmethod
    def of(cls, rows: list[tuple[int, object, list[tuple[int, int, int]]]]) -> "Block":
        """rows: (number, item id, [(term, repeats, weight)]) of each item."""
        new = cls()
        new.rows, new.ids = np.array([r[0] for r in rows], np.int64), [r[1] for r in rows]
        weight_of = {t: w for _, _, own in rows for t, _, w in own}
        most: dict[int, int] = defaultdict(int)
        for _, _, own in rows:
            for t, q, _ in own:
                most[t] = max(most[t], q)
        terms = np.array(list(weight_of), np.int64)
        order = np.argsort(terms.view(U64))
        new.terms = terms.view(U64)[order]
        new.weights = np.array([weight_of[t] for t in terms[order].tolist()], np.int64)
        # The elements of a term are numbered one after another.
        repeats = np.array([most[t] for t in terms[order].tolist()], np.int64)
        new.begin = np.append(0, np.cumsum(repeats))
        first = dict(zip(terms[order].tolist(), new.begin.tolist()))
        new.leaf, made, nodes = share([[e for t, q, _ in own for e in range(first[t], first[t] + q)] for _, _, own in rows], int(new.begin[-1]))
        leaves = int(new.leaf.max()) + 1 if len(new.leaf) else 0
        # Nodes of one level are added up together; a node's level is above those of its parts.
        level = np.zeros(leaves + len(made), np.int64)
        for i, (a, b) in enumerate(made):
            level[leaves + i] = max(level[a], level[b]) + 1
        order = np.argsort(level, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        pairs = np.array(made, np.int64).reshape(-1, 2)[order[leaves:] - leaves]
        new.left, new.right = place[pairs[:, 0]], place[pairs[:, 1]]
        new.levels = np.flatnonzero(np.diff(level[order], prepend=-1)) if len(order) else np.zeros(0, np.int64)
        new.nodes = place[np.concatenate([np.array(x, np.int64) for x in nodes])] if nodes else np.zeros(0, np.int64)
        new.ends = np.cumsum([len(x) for x in nodes])
        new.sizes = np.array([leaves, len(order)])
        return new

    def additions(self) -> int:
        """Accumulators added up for a document, once it has its leaves."""
        return len(self.left) + len(self.nodes)

    def scores(self, docs: int, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Scores (item, document) of a chunk of documents with these terms."""
        at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        known = np.flatnonzero(self.terms[at] == term)
        at, doc, tf = at[known], doc[known], tf[known]
        worth = self.weights[at] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
        leaves, count = self.sizes
        total = np.zeros((count, docs), np.int64)
        repeats = self.begin[at + 1] - self.begin[at]
        element = np.repeat(self.begin[at], repeats) + np.arange(repeats.sum()) - np.repeat(np.cumsum(repeats) - repeats, repeats)
        np.add.at(total.reshape(-1), self.leaf[element] * docs + np.repeat(doc, repeats), np.repeat(worth, repeats))
        for lo, hi in zip(self.levels[1:], np.append(self.levels[2:], count)):
            total[lo:hi] = total[self.left[lo - leaves : hi - leaves]] + total[self.right[lo - leaves : hi - leaves]]
        starts = np.append(0, self.ends[:-1])
        return np.add.reduceat(total[self.nodes], starts, axis=0)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, ids=np.frombuffer(json.dumps(self.ids).encode(), np.uint8), **{k: getattr(self, k) for k in self.ARRAYS})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> "Block":
        new, arrays = cls(), np.load(io.BytesIO(data))
        new.ids = json.loads(arrays["ids"].tobytes())
        for k in cls.ARRAYS:
            setattr(new, k, arrays[k])
        return new


def _write_blocks(root: str):
    """One block file for each task's items, under a name of the attempt's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, name = [], 0, f"{TaskContext.get().partitionId()}-{TaskContext.get().taskAttemptId()}"
        written = 0

        def write() -> pa.RecordBatch:
            path = f"{root}/{name}-{written}.npz"
            write_file(path, Block.of(rows).dump())
            return pa.RecordBatch.from_arrays([pa.array([path])], names=["path"])

        for batch in batches:
            for row, id, terms in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if size and size + len(terms) > BLOCK_TERMS:
                    yield write()
                    rows, size, written = [], 0, written + 1
                rows.append((row, id, [(t["term"], t["repeats"], t["weight"]) for t in terms]))
                size += len(terms)
        if rows:
            yield write()

    return run


def _best(paths: list[str], docs: int, words: int, top: int):
    """(row, item, id, score): the best documents of each item in a task, or in a part of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only: dict[str, Block] = {}
        held: dict[str, tuple] = {}

        def block_of(path: str) -> Block:
            if path not in only:
                if len(paths) > 1:
                    only.clear()  # one block in memory at a time
                with open_file(path) as f:
                    only[path] = Block.load(f.read())
            return only[path]

        def keep(path: str, stretch: list[tuple]) -> None:
            block = block_of(path)
            item, id, missing, score = held.get(path) or (np.zeros(0, np.int64),) * 4
            # What is below an item's present last place cannot count; equal scores still may, by their ids.
            least = np.ones(len(block.rows), np.int64)
            for ids, gone, counts, doc, term, tf, m in stretch:
                step = max(1, CELLS // max(1, int(block.sizes[1])))
                edges = np.arange(0, counts + step, step)
                cut = np.searchsorted(doc, edges)
                for lo, a, b in zip(edges[:-1], cut[:-1], cut[1:]):
                    n = min(step, counts - int(lo))
                    if a == b:
                        continue
                    if len(item) > 2 * top * len(block.rows):
                        item, id, missing, score = _first(item, id, missing, score, top)
                    if len(item):
                        last = np.bincount(item, minlength=len(block.rows)) >= top
                        low = np.full(len(block.rows), np.iinfo(np.int64).max)
                        order = np.lexsort((-score, item))
                        start = np.searchsorted(item[order], np.flatnonzero(last))
                        low[last] = score[order][start + top - 1]
                        least = np.where(last, np.maximum(least, low), least)
                    scores = block.scores(n, doc[a:b] - lo, term[a:b], tf[a:b], m[lo : lo + n])
                    i, d = np.nonzero(scores >= least[:, None])
                    item, score = np.append(item, i), np.append(score, scores[i, d])
                    id, missing = np.append(id, ids[lo + d]), np.append(missing, gone[lo + d])
            held[path] = _first(item, id, missing, score, top)

        def rows() -> Iterator[pa.RecordBatch]:
            for path, (item, id, missing, score) in held.items():
                block = block_of(path)
                names = pa.array([block.ids[i] for i in item], pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(block.rows[item]), names, pa.array(id, mask=missing.astype(bool)), pa.array(score)], names=["row", "item", "id", "score"])
            held.clear()

        def flush(stretch: list[tuple]) -> Iterator[pa.RecordBatch]:
            for path in paths:
                keep(path, stretch)
                if sum(len(x[0]) for x in held.values()) > HELD_ROWS:
                    yield from rows()

        stretch: list[tuple] = []
        for batch in chunks(batches, "text"):
            doc, term, tf, counts = term_counts(batch.column(1))
            missing = batch.column(0).is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            m = 75 + (25 * counts.astype(np.int64) * docs) // words if words else np.zeros(len(counts), np.int64)
            stretch.append((batch.column(0).fill_null(0).to_numpy(), missing, batch.num_rows, doc, term, tf, m))
            if len(stretch) == STRETCH or len(paths) == 1:
                yield from flush(stretch)
                stretch = []
        if stretch:
            yield from flush(stretch)
        yield from rows()

    return run


def _first(item: np.ndarray, id: np.ndarray, missing: np.ndarray, score: np.ndarray, top: int) -> tuple:
    """The best of each item: higher scores first, then smaller ids, missing ones last."""
    order = np.lexsort((id, missing, -score, item))
    item = item[order]
    rank = np.arange(len(item)) - np.searchsorted(item, item)
    keep = order[rank < top]
    return item[rank < top], id[keep], missing[keep], score[keep]


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", top: int = 20) -> DataFrame:
    """The ``top`` documents of each item by score: item_col, rank, id_col, score.

    Terms are runs of ASCII letters and digits and of all other non-ASCII characters, only A-Z lower-cased; the score is an
    integer form of BM25. Only documents with a score above 0 are ranked; equal scores go by id, a missing id last. Null and empty
    texts have no terms: such an item has no rows, such a document is ranked nowhere and counts nowhere. Every row of ``items``
    is an item of its own, also where its id is missing or repeated, which then has each rank several times. A document
    row that is repeated is ranked as often. Extra columns are ignored; an empty table of either kind gives no rows.

    Terms are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    item_type = items.schema[item_col].dataType
    items = scratch.table(items.select(F.monotonically_increasing_id().alias("item"), F.col(item_col).cast("string").alias("item_id"), F.col("text").alias("text")), "items")
    terms = scratch.table(items.select("item", "text").mapInArrow(_item_terms, "item long, term long, repeats long"), "terms")
    slots = [r[0] for r in terms.select(F.col("term").bitwiseAND((1 << SIEVE_BITS) - 1)).distinct().collect()]  # 2**SIEVE_BITS at most
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    counted = texts.select("text").mapInArrow(_counts(Sieve(slots)), "term long, docs long, words long")
    counted = scratch.table(counted.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")), "counted")
    total = counted.where("term is null").first()
    n, words = (total["docs"], total["words"]) if total else (0, 0)

    # floor(1000 * ln((2 N + 2) / (2 df + 1))) in doubles; terms of no document, or of no weight, add nothing.
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n + 2.0) / (F.lit(2.0) * F.col("docs") + 1.0)))
    weighed = terms.join(counted.where("term is not null").select("term", "docs"), "term").withColumn("weight", weight).where("weight > 0")
    own = weighed.groupBy("item").agg(F.collect_list(F.struct("term", "repeats", "weight")).alias("terms"), F.min("term").alias("least"))  # one text's
    own = scratch.table(own.join(items.select("item", "item_id"), "item").select("item", "item_id", "terms", "least"), "own")
    size = own.agg(F.sum(F.size("terms"))).first()[0] or 0
    # Items with the same least term lie together, so that blocks hold items that share much.
    dealt = own.repartitionByRange(max(1, -(-size // BLOCK_TERMS)), "least", "item").sortWithinPartitions("least", "item").select("item", "item_id", "terms")
    written = scratch.table(dealt.mapInArrow(_write_blocks(scratch.path("blocks")), "path string"), "written")
    paths = sorted(r[0] for r in written.collect())  # one a block
    scratch.drop("items", "terms", "counted", "own")

    schema = "row long, item string, id long, score long"
    found = texts.mapInArrow(_best(paths, n, words, top), schema) if paths else spark.createDataFrame([], schema)
    order = [F.desc("score"), F.col("id").isNull(), F.asc("id")]
    # First among the tasks of a part, then among the parts, so that no item's candidates meet in one task.
    found = found.withColumn("part", F.spark_partition_id() % 64)
    for keys in (["row", "part"], ["row"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return found.select(F.col("item").cast(item_type).alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
