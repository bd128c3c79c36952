"""Order MinHash fingerprints of whole texts, in DataFrame functions only.

A text's k-mers are runs of ``K`` consecutive words, one ending at each word; those at the start of the text are
shorter, so a text of n words has n. Each k-mer is numbered by how often it has stood before, which makes a repeated
one several different elements. Elements are hashed, and for each of ``PLACES`` places the ``LENGTH`` elements that are
least in the place's own order are selected, set in the order in which they stand in the text, and the tuple of
their k-mers is hashed. Two texts agree in a place if the same k-mers were selected and stand in the same order; the share
of places in which they do is their likeness, which falls with edit distance, and also when passages change places.

The order of place p compares hashes after an exclusive or with p in their leading bits. One sort of a text's
elements then serves all places: the leading bits of a hash are its bin, the elements of place p are the first of bin
p, and where that holds too few those of the bins next in that order, which ``_filled`` takes over step by step.

All of it works on arrays in the row of the text: sorts of longs that hold a hash and a position, and filters.
Nothing is exploded and no text moves for its own fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallwatch.llm.frames import free_name
from stallwatch.llm.scratch import Scratch

K, LENGTH, PLACE_BITS = 3, 2, 6
PLACES = 1 << PLACE_BITS
#: Low bits of an element: the number of its last word. The others are its hash.
POSITION_BITS = 28
#: Rows of ids that are ordered in one task.
ORDERED_ROWS = 100_000


def _position(x: Column) -> Column:
    return x.bitwiseAND(F.lit((1 << POSITION_BITS) - 1))


def _hash(x: Column) -> Column:
    return F.shiftright(x, POSITION_BITS)


def _element(hashed: Column, position: Column) -> Column:
    return hashed.bitwiseAND(F.lit(-1 << POSITION_BITS)).bitwiseOR(position)


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, 64 - PLACE_BITS)


def _differs(values: Column, x: Column, i: Column, what, back: int = 1) -> Column:
    """Whether what(x) is not what(values[i - back]); true for the first ones."""
    return (i < back) | (what(x) != what(F.get(values, i - back)))


def _numbers(n: Column) -> Column:
    """0 to n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def add_fingerprint(df: DataFrame, text_col: str, name: str = "fingerprint") -> DataFrame:
    """``df`` with the column ``name``: array<int> of PLACES hashes, the Order MinHash of the text.

    Null, empty and white texts have no words; all their places are 0, as those of no other text are meant to be. Equal
    texts have equal fingerprints, and white space between words does not count. Other columns stay as they are.
    """
    taken = list(df.columns)
    column = {}
    for c in ("words", "kmers", "sorted", "first", "again", "runs", "elements", "picked", "heads", "bins"):
        column[c] = free_name(f"__{c}", taken)
        taken.append(column[c])
    c = {k: F.col(v) for k, v in column.items()}

    text = F.btrim(F.coalesce(F.col(text_col), F.lit("")), F.lit(" \t\n\x0b\f\r"))
    rows = df.withColumn(column["words"], F.when(text != "", F.split(text, "[\\x20\\x09-\\x0D]+")).otherwise(F.array().cast("array<string>")))
    # By position: a k-mer ends at each word. What lies before the text is null, which the hash passes over.
    kmer = lambda w, i: F.xxhash64(*[F.get(c["words"], i - k) for k in range(K - 1, 0, -1)], w)
    rows = rows.withColumn(column["kmers"], F.transform(c["words"], lambda w, i: _element(kmer(w, i), i.cast("long"))))
    rows = rows.withColumn(column["sorted"], F.sort_array(c["kmers"]))
    # Equal k-mers now stand side by side, in text order. The first of each is an element as it is.
    rows = rows.withColumn(column["first"], F.filter(c["sorted"], lambda x, i: _differs(c["sorted"], x, i, _hash)))
    later = F.filter(c["sorted"], lambda x, i: ~_differs(c["sorted"], x, i, _hash))
    rows = rows.withColumn(column["again"], F.when(F.size(c["first"]) < F.size(c["sorted"]), later).otherwise(F.array().cast("array<bigint>")))
    # Later ones are hashed with their number: their place in the run of equal k-mers.
    rows = rows.withColumn(column["runs"], F.filter(_numbers(F.size(c["again"])), lambda i: _differs(c["again"], F.get(c["again"], i), i, _hash)))

    def numbered(begin: Column, run: Column) -> Column:
        end = F.coalesce(F.get(c["runs"], run + 1), F.size(c["again"])) - 1
        return F.transform(F.sequence(begin, end), lambda i: _element(F.xxhash64(_hash(F.get(c["again"], i)), i - begin + 1), _position(F.get(c["again"], i))))

    rows = rows.withColumn(column["elements"], F.sort_array(F.concat(c["first"], F.flatten(F.transform(c["runs"], numbered)))))
    rows = rows.withColumn(column["picked"], F.filter(c["elements"], lambda x, i: _differs(c["elements"], x, i, _bin, LENGTH)))
    rows = rows.withColumn(column["heads"], F.filter(_numbers(F.size(c["picked"])), lambda i: _differs(c["picked"], F.get(c["picked"], i), i, _bin)))
    bins = F.map_from_arrays(
        F.transform(c["heads"], lambda i: _bin(F.get(c["picked"], i))),
        F.transform(c["heads"], lambda i, h: F.slice(c["picked"], i + 1, F.coalesce(F.get(c["heads"], h + 1), F.size(c["picked"])) - i)),
    )
    none = F.array().cast("array<bigint>")
    # Through a lambda's argument, as Spark would put the map's own expression into the inner one and build it for each place.
    places = F.transform(F.array(bins), lambda m: F.transform(F.sequence(F.lit(0), F.lit(PLACES - 1)), lambda p: F.coalesce(F.element_at(m, p.cast("long")), none)))
    rows = rows.withColumn(column["bins"], F.get(places, F.lit(0)))
    for bit in range(PLACE_BITS):
        rows = rows.withColumn(column["bins"], _filled(c["bins"], bit))

    def hashed(chosen: Column) -> Column:
        at = F.array_sort(F.transform(chosen, _position))
        tuple_hash = F.xxhash64(*[_hash(F.get(c["kmers"], F.get(at, F.lit(k)).cast("int"))) for k in range(LENGTH)])
        return F.when(F.size(chosen) > 0, F.shiftright(tuple_hash, 32)).otherwise(F.lit(0).cast("long")).cast("int")

    return rows.withColumn(name, F.transform(c["bins"], hashed)).drop(*column.values())


def _filled(bins: Column, bit: int) -> Column:
    """Places short of elements get more from the place that differs in this bit, which is next in their order."""
    other = lambda p: F.get(bins, p.bitwiseXOR(F.lit(1 << bit)))
    return F.transform(bins, lambda own, p: F.when(F.size(own) >= LENGTH, own).otherwise(F.slice(F.concat(own, other(p)), 1, LENGTH)))


def likeness(one: Column, two: Column) -> Column:
    """Share of the places in which two fingerprints agree, 0 to 1."""
    return F.size(F.filter(F.zip_with(one, two, lambda a, b: a == b), lambda same: same)) / F.lit(float(PLACES))


def as_text(fingerprint: Column) -> Column:
    """Eight hex digits a place."""
    digits = F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0"))
    return F.array_join(digits, "")


KEY = ("no_id", "id", "text_hash")


def _before(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(no_id, id, text_hash, b_no_id, b_id, b_text_hash, half): each different row and the one before it in the order of ids.

    half is half the length of the one before. The first row follows the last. Rows are ordered in ranges of ids; what
    stands before the first of a range is the last of the range before, one row a range.
    """
    rows = scratch.table(docs.select(*KEY, F.char_length("text").alias("n")).distinct(), "ids")
    ranges = max(1, -(-rows.count() // ORDERED_ROWS))
    rows = scratch.table(rows.repartitionByRange(ranges, *KEY).withColumn("range", F.spark_partition_id()), "ordered")
    row = F.struct(*KEY, "n")
    ends = rows.groupBy("range").agg(F.max(row).alias("last"))
    by_range = Window.orderBy("range")  # one row a range
    ends = ends.select("range", F.coalesce(F.lag("last").over(by_range), F.max("last").over(Window.partitionBy())).alias("end_before"))
    rows = rows.withColumn("before", F.lag(row).over(Window.partitionBy("range").orderBy(*KEY))).join(ends, "range")
    before = F.coalesce("before", "end_before")
    return scratch.table(rows.select(*KEY, *[before[k].alias(f"b_{k}") for k in KEY], F.floor(before["n"] / 2).cast("int").alias("half")), "before")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last half of the characters replaced by the first as many of the next document, or all
    of it if it is shorter. Documents follow one another by id, those without an id last, those of one id by a hash of their texts;
    after the last comes the first, so a single document follows itself. Repeated rows (equal id and text) follow one another.
    Null texts are empty ones. Extra columns are ignored; an empty table gives no rows.

    Texts move once, with the fingerprint made before; of the next document only what is needed moves on.
    """
    scratch = Scratch(docs.sparkSession, "fingerprints")
    text = F.coalesce(F.col(text_col), F.lit(""))
    id = F.col(id_col).cast("long")
    rows = docs.select(id.isNull().alias("no_id"), F.coalesce(id, F.lit(0)).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    before = _before(rows, scratch)

    # Dealt out once; all three uses below read the same columns of the same exchange.
    single = add_fingerprint(rows, "text").groupBy(*KEY).agg(F.first("text").alias("text"), F.first("fingerprint").alias("fingerprint"), F.count("*").alias("copies"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    followers = single.where("copies > 0").join(before, list(KEY)).select(*[F.col(f"b_{k}").alias(k) for k in KEY], F.expr("left(text, half)").alias("tail"), F.col("fingerprint").alias("next_fingerprint"), F.col("copies").alias("next_copies"))
    whole = [*KEY, "text", "fingerprint", "copies"]
    last = single.select(*whole).join(followers, list(KEY)).where("next_copies > 0 and copies > 0").select(*whole, "tail", "next_fingerprint", F.lit(1).cast("bigint").alias("rows"))
    others = single.select(*whole, F.substring("text", F.lit(1), half).alias("tail"), F.col("fingerprint").alias("next_fingerprint"), (F.col("copies") - 1).alias("rows")).where("rows > 0")
    both = last.select(*others.columns).unionByName(others)

    edited = F.concat(F.substring("text", F.lit(1), n - half), F.col("tail"))
    both = add_fingerprint(both.select("no_id", "id", n.cast("long").alias("n_chars"), edited.alias("edited"), "fingerprint", "next_fingerprint", "rows"), "edited", "edited_fingerprint")
    out = both.select(
        F.when(~F.col("no_id"), F.col("id")).alias(id_col), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), as_text(F.col("fingerprint")).alias("fingerprint"), as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"), "rows",
    )
    # A row that is repeated very often is written out in blocks.
    block = 1 << 16
    out = out.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("rows") - 1) / block))))
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(block).cast("bigint"), F.col("rows") - F.col("block") * block))))
    return out.drop("rows", "block", "copy")
