"""Normalisation by rule tables: ordered chains of built-in column expressions, no Python per row."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwatch.functions import rule_tables as R
from stallwatch.functions.columns import bound, first_match, percent


def _contains(text: Column, words: list[str]) -> Column:
    cond = text.contains(words[0])
    for w in words[1:]:
        cond = cond | text.contains(w)
    return cond


def normalize_category(text: Column, default: str | None = "uncategorized") -> Column:
    return bound(F.lower(F.coalesce(text, F.lit(""))), lambda low: first_match([(_contains(low, words), name) for name, words in R.CATEGORIES.items()], default))


def breadcrumb_category(level2: Column, level3: Column, level4: Column) -> Column:
    """The category of level 3, else 4, else 2."""
    return F.coalesce(*[normalize_category(x, None) for x in (level3, level4, level2)], F.lit("uncategorized"))


def normalize_gender(text: Column, brand: Column | None = None, women_only: tuple[str, ...] = ()) -> Column:
    """The gender that words of the text name, else unisex; brands that sell to women only are women's whatever the text says."""
    read = bound(F.lower(F.coalesce(text, F.lit(""))), lambda low: first_match([(_contains(low, words), name) for name, words in R.GENDERS.items()], "unisex"))
    return read if brand is None else F.when(brand.isin(*women_only), "women").otherwise(read)


def breadcrumb_gender(level1: Column, fallback: Column) -> Column:
    """The gender of the first level, else the fallback."""
    return F.coalesce(_lookup(F.trim(F.lower(level1)), R.BREADCRUMB_GENDERS), fallback)


def rescue_category(category: Column, name: Column, raw: Column) -> Column:
    """A category for products without one, from words in the name or the raw category."""
    found = bound(F.lower(F.concat_ws("\n", name, raw)), lambda both: first_match([(both.contains(w), c) for w, c in R.RESCUES.items()], "uncategorized"))
    return F.when(category == "uncategorized", found).otherwise(category)


#: A mark of a word bound in a pattern, and what stands for it where patterns have none: a backspace.
BOUND, NEVER = r"\b", r"\x08"


def subcategory(category: Column, title: Column, known: Column | None = None, word_bounds: bool = True) -> Column:
    """The subcategory of the first rule of the category that the title meets; one that is known stays.

    word_bounds: without, marks of word bounds in the patterns match nothing, as in databases whose patterns do not have them.
    """
    rules = sorted(enumerate(R.SUBCATEGORIES), key=lambda x: (x[1][3], x[0]))
    found = first_match([((category == c) & title.rlike(f"(?i){p if word_bounds else p.replace(BOUND, NEVER)}"), label) for _, (c, p, label, _) in rules])
    return found if known is None else F.coalesce(known, found)


def fill_subcategories(products: DataFrame) -> DataFrame:
    """``products`` with subcategories by title, in two passes; one that is known stays.

    The first reads every product by the rules as stored, where marks of word bounds match nothing; the second reads what is left
    of the active products with them. So a title that meets a rule of either kind keeps the first pass's answer, and whole-word rules
    alone leave inactive products without one. Categories are taken trimmed and in lower case; null categories and titles meet no rule.
    """
    category = F.lower(F.trim("category_normalized"))
    stored = subcategory(category, F.col("product_name"), F.col("subcategory"), word_bounds=False)
    by_text = F.when(F.col("is_active"), subcategory(category, F.col("product_name")))
    return products.withColumn("subcategory", F.coalesce(stored, by_text))


def subcategory_progress(products: DataFrame) -> DataFrame:
    rows = products.groupBy("category_normalized").agg(F.count("*").alias("total"), F.count("subcategory").alias("filled"))
    return rows.withColumn("filled_pct", percent(F.col("filled"), F.col("total"), 1))


def _lookup(key: Column, table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[key]


def classify_size(raw: Column, category: Column) -> Column:
    """struct(family, system, status, reason); the order of the checks matters."""
    v = F.trim(raw)
    low = F.lower(v)
    number = low.rlike("^[0-9]+$")

    def result(family, system, status, reason):
        return F.struct(*[(x if isinstance(x, Column) else F.lit(x)).cast("string").alias(n) for x, n in ((family, "size_family"), (system, "size_system"), (status, "size_status"), (reason, "reason"))])

    out = result(None, None, "excluded", None)
    chain = F.when(raw.isNull() | (raw == ""), out).when(low == "def", out).when(low.rlike(f"^({R.SIZE_COLORS})$") | F.regexp_replace(low, " ", "_").rlike(f"^({R.SIZE_COLORS})$"), out).when(low.rlike(r"[0-9]+ *(inch|cm|mm)\b|[0-9]+ *[*x] *[0-9]+"), out)
    chain = chain.when(low.rlike("^s1[3-8][0-9]$"), result(F.upper(v), "kids_height_cm", "classified", None)).when(v.rlike("^[A-Z][0-9]{3,4}$"), out)
    chain = chain.when(low.isin(R.ONE_SIZE), result("one-size", "one_size", "classified", None))
    chain = chain.when(low.rlike("^[0-9]{1,2} *y$|^[0-9]{1,2}m[ _-][0-9]{1,2}m$|^[0-9]t$"), result(F.regexp_replace(F.upper(v), " ", ""), "kids_age", "classified", None))
    for pattern, reason in R.SIZE_REVIEWS:
        chain = chain.when(low.rlike(pattern), result(None, None, "review", reason))
    chain = chain.when(low.isin(list(R.LETTERS)), result(_lookup(low, R.LETTERS), "letter", "classified", None))
    chain = chain.when(number & category.isin(R.BOTTOMS) & low.try_cast("int").between(20, 60), result(v, "waist_numeric", "classified", None))
    tops = number & category.isin(R.TOPS_EU)
    chain = chain.when(tops & low.isin(list(R.EU_LETTERS)), result(_lookup(low, R.EU_LETTERS), "eu_numeric", "classified", None)).when(tops, result(None, None, "review", "numeric_outside_eu_ladder_possible_kids"))
    return chain.otherwise(result(None, None, "review", "unrecognized_pattern"))


def apply_sizes(variants: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Variants with their size class, and the review queue by size, category and brand.

    Each different size of a category and brand is classified once, with how often it occurs, and joined back, nulls to nulls.
    """
    keys = ["size", "category_normalized", "brand"]
    classed = variants.groupBy(*keys).agg(F.count("*").alias("sample_count")).withColumn("s", classify_size(F.col("size"), F.col("category_normalized"))).select(*keys, "sample_count", "s.*")
    theirs = classed.drop("sample_count").withColumnsRenamed({k: f"__{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    queue = classed.where("size_status = 'review'").select(F.col("size").alias("size_raw"), "category_normalized", "brand", "reason", "sample_count")
    return variants.join(theirs, same).drop(*[f"__{k}" for k in keys]), queue


def canonical_color(raw: Column) -> Column:
    return bound(F.lower(F.trim(F.coalesce(raw, F.lit("")))), lambda low: first_match([(low.contains(w), c) for w, c in R.COLORS], "other"))


def cell_color(df: DataFrame) -> Column:
    """The colour that boards group by: the family where it is known, else the canonical colour of the raw name."""
    named = canonical_color(F.col("color"))
    return F.coalesce("color_family", named) if "color_family" in df.columns else named


def color_family(raw: Column) -> Column:
    return bound(F.lower(F.trim(raw)), lambda low: first_match([(low.contains(w), family) for w, family in R.COLOR_FAMILIES]))


def seed_colors(variants: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct colours that are not mapped yet, with their class: junk, a family and the name as its shade, or unclassified."""
    raw = F.lower(F.trim("color"))
    rows = variants.select(raw.alias("color_raw")).where("color_raw is not null").distinct().join(known.select("color_raw"), "color_raw", "left_anti")
    junk = (F.length("color_raw") <= 1) | F.col("color_raw").rlike(R.COLOR_JUNK) | F.col("color_raw").rlike(R.COLOR_NUMBERS)
    family = F.when(~junk, color_family(F.col("color_raw")))
    return rows.select("color_raw", family.alias("family"), F.when(family.isNotNull(), F.col("color_raw")).alias("shade"), F.when(junk, "junk").when(family.isNotNull(), "classified").otherwise("unclassified").alias("status"))


def stamp_colors(variants: DataFrame, mapping: DataFrame) -> DataFrame:
    """color_family and color_shade by the classified colours of a map, where the family is missing or another."""
    known = mapping.where("status = 'classified'").select("color_raw", F.col("family").alias("__family"), F.col("shade").alias("__shade"))
    rows = variants.withColumn("color_raw", F.lower(F.trim("color"))).join(known, "color_raw", "left")
    new = F.col("__family").isNotNull() & ~F.col("color_family").eqNullSafe(F.col("__family"))
    rows = rows.withColumn("color_shade", F.when(new, F.col("__shade")).otherwise(F.col("color_shade")))
    return rows.withColumn("color_family", F.when(new, F.col("__family")).otherwise(F.col("color_family"))).drop("__family", "__shade", "color_raw")


def translate_color(raw: Column, language: str) -> Column:
    """English names of Arabic ("ar") or Turkish ("tr") colours; unknown ones pass through in lower case, empty ones are null."""
    key = F.lower(F.trim(raw))
    return F.when(key != "", F.coalesce(_lookup(key, {"ar": R.ARABIC_COLORS, "tr": R.TURKISH_COLORS}[language]), key))


def longest_phrase(text: Column, phrases: dict[str, list[str]] | list[tuple[str, str]]) -> Column:
    """The label of the longest phrase found anywhere: an ordered chain, as one alternation would take the leftmost."""
    return bound(text, lambda t: first_match([(t.contains(p), label) for p, label in by_length(phrases)]))


def by_length(phrases: dict[str, list[str]] | list[tuple[str, str]]) -> list[tuple[str, str]]:
    """(phrase, label), the longest first, else in the given order."""
    pairs = [(p, label) for label, ps in phrases.items() for p in ps] if isinstance(phrases, dict) else phrases
    return sorted(pairs, key=lambda x: -len(x[0]))


def sleeve_length(category: Column, title: Column, raw: Column | None = None, raw_first: Column | None = None) -> Column:
    """Tops only. The title decides, then the raw category; the other way round where ``raw_first`` holds."""
    found = longest_phrase(F.lower(title), R.SLEEVES)
    if raw is not None:
        other = longest_phrase(F.lower(raw), R.SLEEVES)
        first = F.lit(False) if raw_first is None else F.coalesce(raw_first, F.lit(False))
        found = F.when(first, F.coalesce(other, found)).otherwise(F.coalesce(found, other))
    return F.when(category.isin(R.TOPS), found)


def _spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def fit_cut(category: Column, title: Column, raw: Column, raw_first: Column | None = None, pyjamas: Column | None = None) -> Column:
    """Trousers and the like only; punctuation counts as space. ``pyjamas`` marks rows filed there by mistake."""
    by_title, by_raw = longest_phrase(_spaced(title), R.CUTS), longest_phrase(_spaced(raw), R.CUTS)
    first = F.lit(False) if raw_first is None else F.coalesce(raw_first, F.lit(False))
    found = F.when(first, F.coalesce(by_raw, by_title)).otherwise(F.coalesce(by_title, by_raw))
    good = category.isin(R.BOTTOMS)
    return F.when(good if pyjamas is None else good & ~F.coalesce(pyjamas, F.lit(False)), found)


def dress_length(category: Column, title: Column) -> Column:
    return F.when(category == "dresses", longest_phrase(F.lower(title), R.DRESS_LENGTHS))


def dress_silhouette(category: Column, title: Column) -> Column:
    return F.when(category == "dresses", longest_phrase(F.lower(title), R.DRESS_SHAPES))


def jacket_type(category: Column, title: Column) -> Column:
    return F.when(category.isin("jackets", "coats"), longest_phrase(F.lower(title), R.JACKETS))


def underwear_style(category: Column, title: Column) -> tuple[Column, Column]:
    """(style of a top, style of a bottom): one of them, if the title names exactly one kind of garment."""
    low = F.lower(title)
    top, bottom, ours = _contains(low, R.TOP_HINTS), _contains(low, R.BOTTOM_HINTS), category == "underwear"
    return F.when(ours & top & ~bottom, longest_phrase(low, R.TOP_STYLES)), F.when(ours & bottom & ~top, longest_phrase(low, R.BOTTOM_STYLES))


def swimwear_style(category: Column, title: Column) -> Column:
    return F.when(category == "swimwear", longest_phrase(F.lower(title), R.SWIMWEAR))


def bag_type(category: Column, title: Column) -> Column:
    return F.when(category == "bags", longest_phrase(F.lower(title), R.BAGS))


def _alternation(phrases: list[str]) -> str:
    """Longest first, so that at one place the longest phrase is taken."""
    return "|".join(re.escape(p) for p in sorted(phrases, key=lambda x: -len(x)))


def _named_color(text: Column, without: tuple[str, ...] = ()) -> Column:
    """The longest colour that stands in the text as words of its own; of those of one length the first of the table.

    One pass: at each beginning of a word the longest colour there is looked at without being taken, so that colours which overlap
    are all seen; the best of the few found is picked by its rank.
    """
    colors = sorted((c for c in R.TITLE_COLORS if c not in without), key=lambda x: -len(x))
    found = F.regexp_extract_all(text, F.lit(f"(?<![a-z])(?=({_alternation(colors)})(?![a-z]))"), F.lit(1))
    ranks = F.create_map(*[F.lit(x) for i, c in enumerate(colors) for x in (c, i)])
    return F.get(F.array(*map(F.lit, colors)), F.array_min(F.transform(found, lambda c: ranks[c])))


def _color_not_metal(text: Column, title: Column) -> Column:
    """As above, but a metal beside a buckle is the buckle's."""
    found = _named_color(text)
    return F.when(found.isin(R.METALS) & title.contains("buckle"), _named_color(text, tuple(R.METALS))).otherwise(found)


def color_from_title(strategy: Column, title: Column) -> Column:
    """The colour that a title names, by the strategy of its brand; null for other strategies.

    ``tail``: the part after the last dash, if it is a colour; else any colour in the title.
    ``scan``: any colour, once names of materials are taken out; a metal beside a buckle is none.
    ``dash``: whatever follows the last " - ", up to 30 characters (a dictionary resolves it later).
    ``end``: a colour that ends the title; else any, as in scan.
    """
    low = F.lower(title)
    tail = F.trim(F.regexp_extract(low, r"[-\u2013\u2014|]([^-\u2013\u2014|]*)\z", 1))
    cloth = F.regexp_replace(F.regexp_replace(low, R.MATERIALS[0], " "), R.MATERIALS[1], " ")
    dash = F.trim(F.substring_index(low, " - ", -1))
    whole = F.trim(low)
    # What ends the title and begins furthest left is the longest.
    ends = F.nullif(F.regexp_extract(whole, rf"(?:^|[ -])({_alternation(R.TITLE_COLORS)})\z", 1), F.lit(""))
    return (
        F.when(strategy == "tail", F.coalesce(F.when(tail.isin(R.TITLE_COLORS), tail), _named_color(low)))
        .when(strategy == "scan", _color_not_metal(cloth, low))
        .when((strategy == "dash") & low.contains(" - ") & F.length(dash).between(1, 30), dash)
        .when(strategy == "end", F.coalesce(ends, _color_not_metal(low, low)))
    )


def attributes(**columns: Column) -> Column:
    """A map of the attributes that are there."""
    made = F.create_map(*[x for k, v in columns.items() for x in (F.lit(k), v.cast("string"))])
    return F.map_filter(made, lambda k, v: v.isNotNull())


def true_shirts(df: DataFrame) -> DataFrame:
    """Without sweatshirts and hoodies that were filed under shirts."""
    return df.where(~((F.col("category_normalized") == "shirts") & F.coalesce(F.lower("product_name").rlike("sweatshirt|hoodie|hoody"), F.lit(False))))


def drop_excluded(df: DataFrame, excluded: DataFrame, scope: str = "all") -> DataFrame:
    """Without brands excluded for everything, or, with scope stock, for stock too."""
    scopes = ["all", "stock"] if scope == "stock" else ["all"]
    return df.join(excluded.where(F.col("scope").isin(scopes)).select("brand").distinct(), "brand", "left_anti")
