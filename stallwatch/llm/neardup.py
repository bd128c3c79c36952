"""Near-duplicate documents: multi-index Hamming join on b-bit MinHash signatures.

A document's set is its distinct 2-word shingles after A-Z are lower-cased. Its signature is 64
MinHash values cut to 16 bits. The distance of two signatures is the number of the 64 places in
which they differ. The places are split into 14 chunks; by the pigeonhole principle two signatures
at distance 27 or less have a chunk with at most one differing place. So each signature is filed
under every chunk with every one of its places left out (64 keys), and any two signatures within
the distance share a key. A pair at Jaccard similarity 0.8 differs in 12.8 places on average with
a deviation of 3.2; it lies beyond 27 with a probability of about 2 in 100,000.

Documents with equal sets are one class, a node of its own whatever the ids, and never paired. The work goes on
in rounds that move each class a bounded number of times:

1. Under each key every class is held against a leader, the first class in one of four orders. Pairs within the
   distance join classes into families.
2. Each class is held against its hub, the leader that it is nearest to, on the full sets, and leaders against all
   leaders that they are near to. A hub with many members is dealt out; its set goes to each part.
3. What that has not joined is judged inside each family on the full sets, by counting common shingles over inverted
   lists. A large family is dealt out in blocks: the family's largest group meets the block of the other rows, and is not
   held against itself. Where the other rows are more than a block, as with texts of one template that are near to one another without
   links, only rows meet that share one of their rarest shingles: linked sets of n shingles have one in common among the
   rarest n - 0.8 n + 1 of each, in any order of rarity. Rows under a shingle that many share meet in pairs of blocks.
4. Keys that hold more than one family give the pairs across families, again in pairs of blocks that leave out those
   inside the key's largest family. They are confirmed on the full sets.

So every pair within the distance is judged unless a chain of links joins it already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwatch.llm.components import connected_components
from stallwatch.llm.frames import free_name
from stallwatch.llm.scratch import Scratch
from stallwatch.llm.words import SPACED, U64, Words, chunks, mix

PLACES, CHUNKS, RADIUS, LEADERS = 64, 14, 27, 4
#: Shingles of a block of a large family or of a part of a hub's members; a task holds two blocks.
BLOCK_SHINGLES = 500_000
#: Signatures of a block of a large key; a task holds two blocks.
BLOCK_ROWS = 512
#: Rows under a key of rare shingles that are paired one by one.
KEY_ROWS = 32
#: Multipliers of the 64 hash functions and of the second set fingerprint.
_ODD = mix(np.arange(101, 101 + PLACES, dtype=U64)) | U64(1)
_ADD = mix(np.arange(501, 501 + PLACES, dtype=U64))
#: chunk number of each place
_CHUNK = np.arange(PLACES) * CHUNKS // PLACES
#: Masks that turn the order of ids into four different orders.
_ORDERS = [int(x) >> 1 for x in mix(np.arange(901, 901 + LEADERS, dtype=U64))]


def shingles(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(document number, shingle hash), sorted and distinct: the sets of a chunk of documents."""
    words = Words(text, SPACED)
    h = words.hashes(fold_case=True)
    doc, left = words.document(), words.left()
    after = np.zeros_like(h)
    after[:-1] = h[1:]
    pair = mix(h * U64(0x9E3779B97F4A7C15) + mix(after))
    single = np.repeat(words.counts, words.counts) == 1
    keep = (left >= 2) | single
    values = np.where(single, mix(h ^ U64(0x5851F42D4C957F2D)), pair)[keep]
    doc = doc[keep]
    order = np.lexsort((values, doc))
    doc, values = doc[order], values[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])
    return doc[new], values[new]


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        doc, values = shingles(batch.column(1))
        n = batch.num_rows
        counts = np.bincount(doc, minlength=n)
        full = np.flatnonzero(counts)
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])[full]
        sums = np.zeros((2, n), dtype=U64)
        signature = np.zeros((n, PLACES), dtype=np.uint16)
        if len(full):
            sums[0, full] = np.add.reduceat(mix(values), starts)
            sums[1, full] = np.add.reduceat(mix(values ^ U64(0xA5A5A5A5A5A5A5A5)), starts)
            for k in range(PLACES):
                least = np.minimum.reduceat(values * _ODD[k] + _ADD[k], starts)
                signature[full, k] = (mix(least) >> U64(48)).astype(np.uint16)
        made = [pa.array(counts, pa.int64()), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), pa.array([r.tobytes() for r in signature], pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), *made], names=["id", "row_a", "row_b", "n_shingles", "set_a", "set_b", "signature"])


def _as_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, PLACES)


def signature_keys(signature: np.ndarray) -> np.ndarray:
    """(rows, 64) keys: key k is the chunk of place k without place k. The low two bits name the order."""
    spread = mix(signature.astype(U64) + (np.arange(PLACES, dtype=U64) << U64(20)))
    total = np.stack([spread[:, _CHUNK == c].sum(axis=1, dtype=U64) for c in range(CHUNKS)], axis=1)
    keys = mix(total[:, _CHUNK] - spread + (np.arange(PLACES, dtype=U64) << U64(40)))
    return (keys & ~U64(3)) | (_CHUNK % LEADERS).astype(U64)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = signature_keys(_as_matrix(batch.column(1)))
            nodes = np.repeat(batch.column(0).to_numpy(), PLACES)
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(nodes)], names=["key", "node"])


def _near(percent: int):
    """Rows (node, leader, distance) whose signatures are within the radius and whose sizes allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                distance = (_as_matrix(batch.column(2)) != _as_matrix(batch.column(3))).sum(axis=1)
                x, y = (batch.column(i).to_numpy() for i in (4, 5))
                near = pa.array((distance <= RADIUS) & (100 * np.minimum(x, y) >= percent * np.maximum(x, y)))
                columns = [batch.column(0), batch.column(1), pa.array(distance, pa.int32())]
                yield pa.RecordBatch.from_arrays([c.filter(near) for c in columns], names=["node", "leader", "distance"])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of each row replaced by its set."""
    for batch in chunks(batches, "text"):
        doc, values = shingles(batch.column(1))
        ends = np.searchsorted(doc, np.arange(batch.num_rows + 1))
        sets = [values[ends[i] : ends[i + 1]].tobytes() for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * |intersection| >= percent * |union|."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x) or 100 * len(x) < percent * len(y):
        return False
    common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _similar(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            keep = [similar(*(np.frombuffer(c[i].as_buffer(), dtype=U64) for c in (left, right)), percent) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], names=["a", "b"])

    return confirm


def _star_links(percent: int):
    """(a, b): members similar to their hub. Rows (hub, part, member, node, shingles) come with the hub's own first in each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = np.zeros(0, U64)
        for batch in batches:
            out = []
            for i, (name, member, node) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 2, 3)))):
                own = np.frombuffer(batch.column(4)[i].as_py(), dtype=U64)
                if not member:
                    hub = own
                elif similar(hub, own, percent):
                    out.append((name, node))
            yield _pairs(out)

    return run


def _pairs_across(percent: int):
    """Within each (key, first, second), the pairs of different families, within the radius, that meet under this key first.

    Rows (key, first, second, family, node, n_shingles, signature) come sorted by the first four.
    """

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        key, family, node, size = (table.column(c).to_numpy() for c in ("key", "family", "node", "n_shingles"))
        signature = _as_matrix(table.column("signature").combine_chunks())
        bounds = _bounds(table)
        out_a, out_b, held = [], [], 0
        for lo, hi in zip(bounds, np.append(bounds[1:], len(key))):
            for i in range(lo, hi - 1):
                after = int(np.searchsorted(family[lo:hi], family[i], side="right")) + lo
                if after >= hi:
                    break
                fits = (100 * np.minimum(size[after:hi], size[i]) >= percent * np.maximum(size[after:hi], size[i])).nonzero()[0] + after
                differ = signature[fits] != signature[i]
                near = np.flatnonzero(differ.sum(axis=1) <= RADIUS)
                if len(near):
                    near = near[_first_key(differ[near], signature[i]) == key[i]]
                    out_a.append(np.full(len(near), node[i]))
                    out_b.append(node[fits][near])
                    held += len(near)
            if held > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_a, out_b)], names=["a", "b"])
                out_a, out_b, held = [], [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_a, out_b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rest.append(batch)
            if sum(b.num_rows for b in rest) < 4 * BLOCK_ROWS:
                continue
            table = pa.Table.from_batches(rest)
            cut = int(_bounds(table)[-1])  # the last group may go on in the next batch
            yield from pairs(table.slice(0, cut))
            rest = table.slice(cut).combine_chunks().to_batches()
        if rest:
            yield from pairs(pa.Table.from_batches(rest))

    return run


def _bounds(table: pa.Table) -> np.ndarray:
    """Where the groups (key, first, second) begin."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for name in ("key", "first", "second"):
        column = table.column(name).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _first_key(differ: np.ndarray, signature: np.ndarray) -> np.ndarray:
    """The first of the keys that a pair shares, from where its signatures differ."""
    errors = np.stack([differ[:, _CHUNK == c].sum(axis=1) for c in range(CHUNKS)], axis=1)
    ok = errors[:, _CHUNK] - differ == 0  # key k is shared if all places of its chunk but k agree
    return signature_keys(signature[None, :])[0].view(np.int64)[ok.argmax(axis=1)]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: id_col, n_shingles, component_id, kept.

    ``percent``: two documents are linked if 100 * |intersection| >= percent * |union| of their sets.
    component_id is the smallest id reachable over links. kept marks the document whose id that is.
    Null and empty texts, and texts of white space, have no shingles, link with nothing and are kept.
    A single word is a shingle of its own. Rows with equal ids are rows of their own, linked by text
    alone; a row without an id takes part, gets its group's component_id, and is kept only if no row of
    its group has an id (component_id is null then). Extra columns are ignored. An empty table gives none.
    """
    signed, members = _judged(docs, id_col, text_col, percent, Scratch(docs.sparkSession, "neardup"))
    out = signed.select("id", "n_shingles", "set_a", "set_b").join(members.select("set_a", "set_b", "n_shingles", F.col("head.id").alias("least")), ["set_a", "set_b", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("least"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, component.isNull()).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """One document of each group, that with the smallest id, with its own columns, whatever their names.

    Documents without words stay. Of rows with equal id and text one stays. A group of rows without ids keeps one
    of them. The texts are dealt out once, by (id, text), and copies of a row meet map-side before that.
    """
    signed, members = _judged(docs, id_col, text_col, percent, Scratch(docs.sparkSession, "neardup"))
    kept = members.select("head.row_a", "head.row_b").unionByName(signed.where("n_shingles = 0").select("row_a", "row_b")).distinct()
    row_a, row_b = (free_name(c, docs.columns) for c in ("row_a", "row_b"))
    own = docs.withColumns(dict(zip((row_a, row_b), _row_key(id_col, text_col)))).dropDuplicates([row_a, row_b])
    return own.join(kept.select(F.col("row_a").alias(row_a), F.col("row_b").alias(row_b)), [row_a, row_b], "left_semi").select(*docs.columns)


def _row_key(id_col: str, text_col: str) -> tuple["F.Column", "F.Column"]:
    """Two 64-bit hashes of a row's id and text."""
    id, text = F.col(id_col).cast("long"), F.col(text_col)
    missing = F.concat(id.isNull().cast("string"), text.isNull().cast("string"))  # hashes pass over nulls
    return F.xxhash64(missing, id, text), F.xxhash64(F.lit("again"), text, id, missing)


def _judged(docs: DataFrame, id_col: str, text_col: str, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(id, row_a, row_b, n_shingles, set_a, set_b) per row, and (set_a, set_b, n_shingles, head) per class.

    head is the first row (id, row_a, row_b) of the class's component: the smallest id, a null id last.
    """
    row_a, row_b = _row_key(id_col, text_col)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), row_a.alias("row_a"), row_b.alias("row_b"))
    signed = scratch.table(docs.mapInArrow(_signatures, "id long, row_a long, row_b long, n_shingles long, set_a long, set_b long, signature binary"), "signed")
    head = F.struct(F.col("id").isNull().alias("no_id"), "id", "row_a", "row_b")
    classes = signed.where("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles").agg(F.min(head).alias("head"), F.first("signature").alias("signature"))
    classes = scratch.table(classes.withColumn("node", F.monotonically_increasing_id()), "classes")  # the written numbers stand
    labels = scratch.table(_components(docs, classes, percent, scratch), "labels")
    scratch.drop("shared", "near", "families", "sets", "stars", "grouped", "sized", "wide", "common", "tokens", "held", "prefixed", "prefix_pairs", "inside", "labelled", "across", "merged")

    members = classes.join(labels, "node", "left").select("set_a", "set_b", "n_shingles", "head", F.coalesce("component", "node").alias("component"))
    first = scratch.table(members.groupBy("component").agg(F.min("head").alias("head")), "heads")
    return signed.drop("signature"), members.drop("head").join(first, "component").drop("component")


def _components(docs: DataFrame, classes: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(node, component) of the nodes that are similar to others, and perhaps of more."""
    signature = classes.select("node", "signature", "n_shingles")
    keys = signature.select("node", "signature").mapInArrow(_keys, "key long, node long")
    order = F.element_at(F.array(*map(F.lit, _ORDERS)), (F.col("key").bitwiseAND(3) + 1).cast("int"))
    leaders = keys.groupBy("key").agg(F.min(F.col("node").bitwiseXOR(order)).alias("m"), F.count("*").alias("n")).where("n > 1")
    leaders = scratch.table(leaders.select("key", F.col("m").bitwiseXOR(order).alias("leader")), "leaders")
    shared = scratch.table(keys.join(leaders, "key"), "shared")  # few keys are shared
    scratch.drop("leaders")
    tried = shared.where("node <> leader").select("node", "leader").distinct()
    first = signature.select("node", F.col("signature").alias("s"), F.col("n_shingles").alias("x"))
    second = signature.select(F.col("node").alias("leader"), F.col("signature").alias("t"), F.col("n_shingles").alias("y"))
    both = tried.join(first, "node").join(second, "leader").select("node", "leader", "s", "t", "x", "y")
    near = scratch.table(both.mapInArrow(_near(percent), "node long, leader long, distance int"), "near")
    families = connected_components(near.select(F.col("node").alias("a"), F.col("leader").alias("b")), scratch, "families").withColumnRenamed("component", "family")
    families = scratch.table(families.join(classes.select("node", "n_shingles"), "node"), "families")

    labelled = shared.select("node").distinct().join(families.select("node", "family"), "node", "left").join(signature, "node")
    labelled = scratch.table(labelled.select("node", F.coalesce("family", "node").alias("family"), "n_shingles", "signature"), "labelled")
    across = scratch.table(_across(shared, labelled, percent), "across")

    # The texts are dealt out once, for all that is judged on full sets.
    wanted = families.select("node").unionByName(across.select(F.col("a").alias("node"))).unionByName(across.select(F.col("b").alias("node"))).distinct()
    sets = scratch.table(_sets_of(docs, classes.select("node", "head.row_a", "head.row_b").join(wanted, "node")), "sets")
    stars = scratch.table(_stars(near, families, sets, percent), "stars")
    labels = connected_components(stars, scratch, "star").withColumnRenamed("component", "label")
    grouped = families.join(labels, "node", "left").select("node", "family", "n_shingles", F.coalesce("label", "node").alias("label"))
    grouped = scratch.table(grouped, "grouped")
    inside = scratch.table(_inside(grouped, sets, percent, scratch), "inside")
    links = inside.unionByName(_confirmed(across, sets, percent))

    # Labels are joined by the links between them; a node without one is its own.
    named = grouped.select("node", "label")
    for end in ("a", "b"):
        links = links.join(named.select(F.col("node").alias(end), F.col("label").alias("to")), end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    merged = connected_components(links, scratch, "merged").select(F.col("node").alias("label"), "component")
    inner = named.join(merged, "label", "left").select("node", F.coalesce("component", "label").alias("component"))
    outer = merged.withColumnRenamed("label", "node").join(named, "node", "left_anti")  # nodes of no family
    return inner.unionByName(outer)


def _stars(near: DataFrame, families: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (hub, member): each class is held against the leader nearest to it, a leader against all leaders near to it."""
    nearest = near.groupBy("node").agg(F.min(F.struct("distance", "leader")).alias("best")).select("node", F.col("best.leader").alias("hub"))
    hubs = nearest.select(F.col("hub").alias("node")).distinct()
    between = near.join(hubs, "node", "left_semi").join(hubs.withColumnRenamed("node", "leader"), "leader", "left_semi").select("node", F.col("leader").alias("hub"))
    held = nearest.unionByName(between).distinct().join(families.select("node", "n_shingles"), "node")
    load = held.groupBy("hub").agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("parts"))
    rows = held.join(load, "hub").select("node", "hub", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), F.lit(True).alias("member"))
    own = load.select(F.col("hub").alias("node"), "hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("member"))
    tasks = rows.unionByName(own).join(sets, "node").select("hub", "part", "member", "node", "shingles")
    return tasks.repartition("hub", "part").sortWithinPartitions("hub", "part", "member").mapInArrow(_star_links(percent), "a long, b long")


def _inside(grouped: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links between the labels of a family."""
    rows = scratch.table(_sized(grouped), "sized")
    wide = scratch.table(rows.where("rest_blocks > 1").select(*grouped.columns), "wide")
    narrow = rows.where("rest_blocks < 2")
    if wide.isEmpty():
        return _block_links(narrow, sets, percent)
    tokens = scratch.table(_prefix_keys(wide, sets, percent, scratch), "tokens")
    pairs, crowded = _by_prefix(tokens, percent, scratch)
    again = _sized(wide.join(crowded, "node", "left_semi"))
    return _block_links(narrow.unionByName(again), sets, percent).unionByName(_confirmed(pairs, sets, percent))


def _sized(grouped: DataFrame) -> DataFrame:
    """Rows of the families of more than one label, with the family's largest label and how many blocks it and the rest make."""
    sizes = grouped.groupBy("family", "label").agg(F.sum("n_shingles").alias("n"))
    sizes = sizes.groupBy("family").agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("total"), F.count("*").alias("labels")).where("labels > 1")
    blocks = lambda n: F.ceil(n / BLOCK_SHINGLES).cast("int")
    single = F.col("total") <= BLOCK_SHINGLES
    sizes = sizes.select("family", F.col("main.label").alias("main"), single.alias("single"), blocks(F.col("total") - F.col("main.n")).alias("rest_blocks"), blocks(F.col("main.n")).alias("main_blocks"))
    return grouped.join(sizes, "family")


def _block_links(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the labels of each family, from pairs of its blocks."""
    placed = _placed(rows, F.col("label") == F.col("main"), "family", "label", "node")
    tasks = placed.join(sets, "node").select("family", "first", "second", "label", "node", "shingles")
    return tasks.repartition("family", "first", "second").sortWithinPartitions("family", "first", "second", "node").mapInArrow(_group_links(percent), "a long, b long")


def _prefix_keys(wide: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(key, node, label, n_shingles, place) of the rarest shingles of each set, as many as two linked sets cannot be without a common one.

    A family is dealt out in parts of BLOCK_SHINGLES. The shingles that recur in one part are its common ones; how often they do
    orders all its sets, rare ones first. The table goes to each part. Any order gives the same links; this one keeps the
    shingles of a template out of the keys.
    """
    parts = wide.groupBy("family").agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("parts"))
    dealt = wide.join(parts, "family").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    sample = dealt.where("part = 0").join(sets, "node").select("family", "shingles")
    common = scratch.table(sample.repartition("family").sortWithinPartitions("family").mapInArrow(_common_shingles, "family long, shingles binary, uses binary"), "common")
    own = common.join(parts, "family").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    own = own.select("family", "part", F.lit(False).alias("member"), F.lit(0).cast("long").alias("node"), F.lit(0).cast("long").alias("label"), "shingles", "uses")
    rows = dealt.join(sets, "node").select("family", "part", F.lit(True).alias("member"), "node", "label", "shingles", F.lit(None).cast("binary").alias("uses"))
    tasks = own.unionByName(rows).repartition("family", "part").sortWithinPartitions("family", "part", "member")
    return tasks.mapInArrow(_rarest(percent), "key long, node long, label long, n_shingles int, place int")


def _common_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles that recur in the sets of each family, and how often. Rows come sorted by family."""
    now, held = None, []

    def done() -> pa.RecordBatch:
        values, uses = np.unique(np.concatenate(held), return_counts=True)
        often = uses > 1
        columns = [pa.array([now], pa.int64()), pa.array([values[often].tobytes()], pa.binary()), pa.array([uses[often].astype(np.int64).tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["family", "shingles", "uses"])

    for batch in batches:
        for family, own in zip(*(c.to_pylist() for c in batch.columns)):
            if family != now and held:
                yield done()
                held = []
            now = family
            held.append(np.frombuffer(own, dtype=U64))
    if held:
        yield done()


def _rarest(percent: int):
    """Keys of each set. Rows (family, part, member, node, label, shingles, uses) come with the family's table first in each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, none = None, np.zeros(0, U64)
        common, uses = none, none.view(np.int64)
        for batch in batches:
            out: list[tuple[np.ndarray, int, int, int]] = []
            for i, (family, part, member, node, label) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(5)))):
                own = np.frombuffer(batch.column(5)[i].as_py(), dtype=U64)
                if not member:
                    table, common, uses = (family, part), own, np.frombuffer(batch.column(6)[i].as_py(), dtype=np.int64)
                    continue
                if table != (family, part):  # a family whose sample is empty has no table
                    table, common, uses = (family, part), none, none.view(np.int64)
                n = np.zeros(len(own), np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
                    n = np.where(common[at] == own, uses[at], 0)
                rare = np.lexsort((own, n))[: len(own) + percent * len(own) // -100 + 1]
                out.append((mix(own[rare] ^ mix(np.array([family], np.int64).view(U64))), node, label, len(own)))
            lengths = [len(x[0]) for x in out]
            key = np.concatenate([x[0] for x in out]) if out else none
            node, label, size = (np.repeat(np.array([x[k] for x in out], np.int64), lengths) for k in (1, 2, 3))
            place = np.concatenate([np.arange(n) for n in lengths]) if out else none.view(np.int64)
            columns = [pa.array(key.view(np.int64)), pa.array(node), pa.array(label), pa.array(size.astype(np.int32)), pa.array(place.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "node", "label", "n_shingles", "place"])

    return run


def _by_prefix(tokens: DataFrame, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of different labels that share a key of at most KEY_ROWS rows, and the nodes under keys of more.

    A pair is left out under a key after which too few shingles are left for the overlap that it needs: under the
    first shingle that the two have in common enough are left.
    """
    held = tokens.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("least"), F.max("label").alias("most")).where("least < most").select("key", "n")
    shared = scratch.table(tokens.join(scratch.table(held, "held"), "key"), "prefixed")
    few = shared.where(F.col("n") <= KEY_ROWS)
    x, y = few.alias("x"), few.alias("y")
    left = F.least(F.col("x.n_shingles") - F.col("x.place"), F.col("y.n_shingles") - F.col("y.place"))
    enough = left * (100 + percent) >= percent * (F.col("x.n_shingles") + F.col("y.n_shingles"))
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.label") != F.col("y.label")) & enough)
    pairs = scratch.table(pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), "prefix_pairs")
    return pairs, shared.where(F.col("n") > KEY_ROWS).select("node").distinct()


def _placed(rows: DataFrame, in_main: "F.Column", *keep: str) -> DataFrame:
    """``rows`` once for each pair of blocks (first, second) of their group that they are needed in.

    Rows outside the group's main part have blocks 0 to rest_blocks - 1, those of the main part the next main_blocks. Each
    block of the former meets every other block; blocks of the main part do not meet one another. A single group has one pair.
    """
    spread = F.xxhash64("node")
    rest, main = F.col("rest_blocks"), F.col("main_blocks")
    own = F.when(F.col("single"), 0).when(in_main, rest + F.pmod(spread, F.greatest(main, F.lit(1)))).otherwise(F.pmod(spread, F.greatest(rest, F.lit(1)))).cast("int")
    last = F.when(F.col("single"), 0).when(in_main, rest - 1).otherwise(rest + main - 1).cast("int")
    rows = rows.select(*keep, "single", own.alias("own"), F.explode(F.sequence(F.lit(0), last)).alias("other")).where("single or own <> other")
    return rows.select(*keep, F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"))


def _across(shared: DataFrame, labelled: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different families within the radius, from keys that hold more than one family."""
    filed = shared.select("key", "node").join(labelled.select("node", "family"), "node")
    counts = filed.groupBy("key", "family").agg(F.count("*").alias("n"))
    sizes = counts.groupBy("key").agg(F.max(F.struct("n", "family")).alias("main"), F.sum("n").alias("total"), F.count("*").alias("families")).where("families > 1")
    blocks = lambda n: F.ceil(n / BLOCK_ROWS).cast("int")
    sizes = sizes.select("key", F.col("main.family").alias("main"), (F.col("total") <= BLOCK_ROWS).alias("single"), blocks(F.col("total") - F.col("main.n")).alias("rest_blocks"), blocks(F.col("main.n")).alias("main_blocks"))
    placed = _placed(filed.join(sizes, "key"), F.col("family") == F.col("main"), "key", "family", "node")
    rows = placed.join(labelled.select("node", "n_shingles", "signature"), "node").select("key", "first", "second", "family", "node", "n_shingles", "signature")
    found = rows.repartition("key", "first", "second").sortWithinPartitions("key", "first", "second", "family").mapInArrow(_pairs_across(percent), "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles): the full sets of the wanted (node, row_a, row_b), one row each."""
    rows = docs.select("row_a", "row_b", "text").join(wanted.select("row_a", "row_b", "node"), ["row_a", "row_b"])
    return rows.dropDuplicates(["row_a", "row_b"]).select("node", "text").mapInArrow(_sets, "node long, shingles binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("shingles_a"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("shingles_b"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "shingles_a", "shingles_b")
    return both.mapInArrow(_similar(percent), "a long, b long")


def _group_links(percent: int):
    """Links that join the rows of each (family, first, second); rows come sorted by these. Rows of one label are joined already."""

    def links(nodes: list[int], labels: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        n = len(nodes)
        sizes = np.array([len(s) for s in sets])
        _, shingle, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(n), sizes)
        posting = owner[np.argsort(shingle, kind="stable")]
        begin = np.cumsum(df) - df
        starts = np.cumsum(sizes) - sizes
        group = np.unique(labels, return_inverse=True)[1]
        centre = np.add.reduceat(df[shingle], starts) / sizes  # rows that share most go first
        largest = lambda: int(np.argmax(group == np.argmax(np.bincount(group, minlength=n))))
        main, out = -1, []
        for step, x in enumerate(np.argsort(-centre, kind="stable")):
            if step == 3:
                main = largest()  # from now on the rows of its group are only met by others
            if step >= 3 and group[x] == group[main]:
                continue
            own = shingle[starts[x] : starts[x] + sizes[x]]
            count = df[own]
            at = np.repeat(begin[own] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            common = np.bincount(posting[at], minlength=n)
            alike = np.flatnonzero(100 * common >= percent * (sizes + sizes[x] - common))
            for g in np.unique(group[alike]):
                if g != group[x]:
                    y = alike[group[alike] == g][0]
                    out.append((nodes[x], nodes[y]))
                    group[group == g] = group[x]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes, labels, sets = None, [], [], []

        def done() -> list[tuple[int, int]]:
            return links(nodes, labels, sets) if len(nodes) > 1 else []

        for batch in batches:
            out: list[tuple[int, int]] = []
            for key, label, node, own in zip(zip(*(batch.column(c).to_pylist() for c in range(3))), *(batch.column(c).to_pylist() for c in (3, 4, 5))):
                if key != now:
                    out += done()
                    now, nodes, labels, sets = key, [], [], []
                nodes.append(node)
                labels.append(label)
                sets.append(np.frombuffer(own, dtype=U64))
            yield _pairs(out)
        yield _pairs(done())

    return run


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], names=["a", "b"])
