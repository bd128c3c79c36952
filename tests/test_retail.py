"""Rules on hand-made rows: the edges that the shop tables do not have."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from stallwatch.functions.columns import round_to, upper_median
from stallwatch.operators import boards, capture, lake, maintenance, market, order_board, quality, rollups, signals, taxonomy
from stallwatch.sources.day_files import depth, list_days, scan_days
from stallwatch.sources.shop import Shop

DAY = dt.date(2024, 1, 10)


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def events(spark, moves):
    """moves: (product, hours since the 1st, before, after)"""
    rows = [(i, p, "b", "n", "c", "s", "g", "d", float(b), float(a), 100.0, "up" if a > b else "down", round(100.0 - a, 2) if a < 100 else None, at(1) + dt.timedelta(hours=h), (at(1) + dt.timedelta(hours=h)).date()) for i, (p, h, b, a) in enumerate(moves)]
    return spark.createDataFrame(rows, "event_id long, product_id long, brand string, product_name string, category_normalized string, subcategory string, gender string, department string, price_before double, price_after double, first_observed_price double, direction string, discount_pct double, recorded_at timestamp, event_date date")


def test_upper_median_and_rounding(spark):
    row = spark.range(1).select(upper_median(F.array(*map(F.lit, (1.0, 2.0, 3.0, 4.0)))).alias("m"), upper_median(F.array(F.lit(-1.0))).alias("none"), round_to(F.lit(1.005)).alias("r"), round_to(F.lit(-1.25), 1).alias("n")).first()
    assert row.m == 3.0 and row.none is None and row.r == 1.0 and row.n == -1.2


def test_staircase_counts_good_steps_and_strict_runs(spark):
    e = events(spark, [(1, 0, 100, 90), (1, 5, 90, 80), (1, 10, 80, 95), (1, 15, 95, 85), (1, 20, 85, 70)])
    loose = signals.price_staircase(e, "2024-01-10").first()
    assert loose.step_count == 4 and loose.first_price == 90.0 and loose.last_price == 70.0
    assert signals.price_staircase(e, "2024-01-10", strict=True).count() == 0
    assert signals.price_staircase(e, "2024-01-10", strict=True, min_steps=2).first().step_count == 2


def test_escalation_ignores_equal_and_shallower_cuts(spark):
    e = events(spark, [(1, 0, 100, 90), (1, 5, 90, 95), (1, 10, 95, 90), (1, 15, 90, 80)])
    row = signals.discount_depth_escalation(e, "2024-01-10").first()
    assert row.escalation_count == 2 and row.first_depth_pct == 10.0 and row.last_depth_pct == 20.0


def test_flash_sale_bounds_are_open(spark):
    e = events(spark, [(1, 0, 100, 90), (1, 24, 90, 100), (2, 0, 100, 90), (2, 23, 90, 95)])
    assert [r.product_id for r in signals.flash_events(e).collect()] == [2]


def test_stitch_prefers_hot_and_tolerates_missing_columns(spark):
    hot = spark.createDataFrame([(1, 5.0, True)], "id long, price double, witnessed boolean")
    cold = spark.createDataFrame([(1, 9.0), (2, 7.0)], "id long, price double")
    assert sorted((r.id, r.price) for r in lake.stitch(hot, cold, "id").collect()) == [(1, 5.0), (2, 7.0)]


def test_discount_needs_a_base_above_the_price(spark):
    d = lake.discount_against(F.col("b"), F.col("p"))
    rows = spark.createDataFrame([(None, 1.0), (0.0, 1.0), (1.0, 2.0), (4.0, 3.0)], "b double, p double").select(d.alias("d")).collect()
    assert [r.d for r in rows] == [None, None, None, 25.0]


def test_reclassify_only_demotes_in_the_lookback(spark):
    rows = [(1, 1, "restock", True, at(9), DAY), (2, 1, "restock", True, at(9, 5), DAY), (3, 2, "restock", True, dt.datetime(2023, 12, 1), dt.date(2023, 12, 1)), (4, 3, "stockout", True, at(8), DAY), (5, 3, "delisted", None, at(8, 1), DAY), (6, 3, "restock", True, at(8, 2), DAY)]
    stock = spark.createDataFrame(rows, "event_id long, variant_id long, event_type string, witnessed boolean, recorded_at timestamp, event_date date")
    got = {r.event_id: r.reason for r in capture.reclassify_witnessed(stock, "2024-01-11").collect()}
    assert got == {1: "orphan_restock", 2: "orphan_restock", 3: None, 4: None, 5: None, 6: "delist_cycle"}


@pytest.mark.parametrize("raw, category, want", [("42", "jeans", "42"), ("42", "dresses", "L"), ("8-9", "x", None), ("S-M", "x", None), ("N002", "x", None), ("18 INCH", "x", None), ("Beden 40 - Boy 30", "x", None), ("navy", "x", None), ("s150", "x", "S150"), ("4 y", "x", "4Y"), ("Free Size", "x", "one-size"), ("XXL", None, "2XL"), (None, "x", None)])
def test_sizes(spark, raw, category, want):
    frame = spark.createDataFrame([(raw, category)], "size string, category string")
    assert frame.select(taxonomy.classify_size(F.col("size"), F.col("category")).alias("s")).first().s.size_family == want


def test_titles_and_colours(spark):
    texts = {"Off White shirt": "white", "": "other", "12345": "other", "اسود": "black", None: "other"}
    frame = spark.createDataFrame([(k,) for k in texts], "t string")
    assert [r.c for r in frame.select(taxonomy.canonical_color(F.col("t")).alias("c")).collect()] == list(texts.values())
    row = spark.createDataFrame([("Blue Sweatshirt",)], "t string").select(taxonomy.normalize_category(F.col("t")).alias("c"), taxonomy.sleeve_length(F.lit("shirts"), F.lit("Full Sleeve linen")).alias("s"), taxonomy.subcategory(F.lit("shirts"), F.lit("LINEN long sleeve")).alias("u")).first()
    assert (row.c, row.s, row.u) == ("sweatshirts", "long sleeve", "long-sleeve")


def test_flatten_finds_the_size_option(spark):
    schema = "product_id long, variants array<struct<sku: string, option1: string, option2: string, price: double, available: boolean>>"
    frame = spark.createDataFrame([(1, [("a", "Red", "S", 5.0, True), ("b", "Blue", "M", 0.0, True), ("c", "Blue", "L", 6.0, False)]), (2, [("d", "Default Title", None, 3.0, True)])], schema)
    got = {r.external_sku: (r.size, r.color) for r in capture.flatten_variants(frame).collect()}
    assert got == {"a": ("S", "Red"), "c": ("L", "Blue"), "d": (None, None)}


def test_prices_from_items(spark):
    frame = spark.createDataFrame([([(True, 5.0), (False, 1.0)], 9.0, 10.0, 12.0, False), ([], None, 10.0, 8.0, True), ([], None, 10.0, 8.0, False)], "badges array<struct<shown: boolean, price: double>>, d double, f double, o double, g boolean")
    got = frame.select(capture.resolve_price(*map(F.col, ("badges", "d", "f", "o", "g"))).alias("p")).collect()
    assert [r.p for r in got] == [5.0, 8.0, 10.0]
    assert spark.range(1).select(capture.text_price(F.lit("EGP 1,299.50")).alias("t"), capture.minor_unit_price(F.lit("12950")).alias("m")).first()[:] == (1299.5, 129.5)


def test_replace_days_is_idempotent_and_empty_is_no_op(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(1, DAY), (2, dt.date(2024, 1, 11))], "id long, snapshot_date date")
    lake.replace_days(frame, path)
    lake.replace_days(frame.where("id = 1").withColumn("id", F.lit(9).cast("long")), path)
    lake.replace_days(frame.where("id > 100"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 9]
    with pytest.raises(ValueError):
        lake.replace_days(frame.drop("snapshot_date"), path)


def test_archive_removes_only_verified_rows(spark, tmp_path):
    hot = spark.createDataFrame([(1, DAY), (2, dt.date(2024, 1, 30))], "id long, snapshot_date date")
    root, staging = str(tmp_path / "cold"), str(tmp_path / "staging")
    assert maintenance.archive_days(hot, root, staging, "id", "2024-01-31", 14, dry_run=True).count() == 2
    left = maintenance.archive_days(hot, root, staging, "id", "2024-01-31", 14)
    assert [r.id for r in left.collect()] == [2] and [r.id for r in spark.read.parquet(root).collect()] == [1]
    assert lake.merge_days(spark.createDataFrame([(1, DAY), (5, DAY)], "id long, snapshot_date date"), root, "id", staging) == [DAY]
    assert sorted(r.id for r in spark.read.parquet(root).collect()) == [1, 5]


def test_runner_isolates_and_logs(spark, tmp_path):
    snaps = spark.createDataFrame([(1, DAY)], "id long, snapshot_date date")

    def broken():
        raise RuntimeError("boom")

    runs = maintenance.run_signals(spark, [maintenance.Signal("a", lambda: snaps), maintenance.Signal("b", broken), maintenance.Signal("c", lambda: snaps, min_days=9), maintenance.Signal("d", lambda: snaps, requires=["b"]), maintenance.Signal("e", lambda: snaps.where("id > 5"))], snaps, str(tmp_path / "out"), str(tmp_path / "log"))
    got = {r.signal_id: (r.status, r.rows_written) for r in runs.collect()}
    assert got == {"a": ("ok", 1), "b": ("failed", 0), "c": ("skipped", 0), "d": ("skipped", 0), "e": ("ok", 0)}
    assert spark.read.parquet(str(tmp_path / "log")).count() == 5


def test_confidence_interval(spark):
    row = spark.range(1).select(boards.ci95(F.lit(0.0), F.lit(10.0)).alias("a"), boards.ci95(F.lit(0.0), F.lit(10.0), legacy=True).alias("b"), boards.ci95(F.lit(0.5), F.lit(1)).alias("c")).first()
    assert row.a > 0 and row.b == 0.0 and row.c == 0.0


def test_titles_name_colours_by_strategy(spark):
    rows = [
        ("tail", "Polo - Navy Blue", "navy blue"), ("tail", "White polo - Regular fit", "white"), ("tail", None, None), ("scan", "Ice denim belt gold buckle", None), ("scan", "Brown belt, gold buckle", "brown"),
        ("scan", "Creamy top", None), ("dash", "Shirt - بني", "بني"), ("dash", "Shirt", None), ("end", "White shoe with laces Dark Blue", "dark blue"), ("other", "Black shirt", None),
    ]
    got = spark.createDataFrame(rows, "s string, t string, want string").select("want", taxonomy.color_from_title(F.col("s"), F.col("t")).alias("c")).collect()
    assert [r.c for r in got] == [r.want for r in got]


def test_attributes_need_their_category_and_the_longest_phrase_wins(spark):
    cut = taxonomy.fit_cut(F.col("k"), F.col("t"), F.col("r"), F.col("k") == "joggers", F.col("r") == "pyjama")
    top, bottom = taxonomy.underwear_style(F.col("k"), F.col("t"))
    rows = [("jeans", "Extreme Wide--Leg slim", "x"), ("jeans", "plain", "Mom-Fit"), ("joggers", "slim", "cargo"), ("jeans", "slim", "pyjama"), ("shirts", "slim", "slim"), ("underwear", "unpadded bra", ""), ("underwear", "bra and thong", ""), ("underwear", "hipster brief", "")]
    got = spark.createDataFrame(rows, "k string, t string, r string").select(cut.alias("cut"), top.alias("top"), bottom.alias("bottom")).collect()
    assert [r.cut for r in got] == ["wide leg", "mom fit", "cargo"] + [None] * 5
    assert [(r.top, r.bottom) for r in got[5:]] == [("unpadded", None), (None, None), (None, "hipster")]


def test_boards_that_contradict_each_other_are_shown(spark):
    board = spark.createDataFrame([("a", "x", "go"), ("a", "y", "watch"), ("b", "x", "buy")], "category_normalized string, subcategory string, verdict string")
    stocks = spark.createDataFrame([("a", "stop"), ("b", "hold")], "category_normalized string, verdict string")
    assert [r[:] for r in order_board.cross_conflicts(board, stocks).collect()] == [("a", "x", "go")]


def test_a_table_that_stands_still_is_excused_by_a_good_run(spark):
    old, none = spark.createDataFrame([(DAY,)], "d date"), spark.createDataFrame([], "d date")
    runs = spark.createDataFrame([("b", dt.date(2024, 1, 30), "ok"), ("a", dt.date(2024, 1, 30), "failed")], "signal_id string, run_date date, status string")
    got = {r.signal_id: r.status for r in quality.signal_freshness({"a": (old, "d", 3), "b": (old, "d", 3), "c": (none, "d", 3), "e": (old, "d", 22)}, runs, "2024-01-31").collect()}
    assert got == {"a": "FAIL", "b": "OK", "c": "WARN", "e": "OK"}


def test_colours_have_the_families_of_the_map(spark):
    want = {"Burgundy": "burgundy", "khaki": "green", "navy": "blue", "copper": "metallic", "bronze": "metallic", "camo print": "multi", "mocha": "brown", "caramel": "beige", "lemon": "yellow", "ابيض": "white", "Off White": "white", "zzz": None, "40 cm": None, "12.5": None, "..": None}
    frame = spark.createDataFrame([(c,) for c in [*want, "NAVY ", None]], "color string")
    got = {r.color_raw: (r.family, r.shade, r.status) for r in taxonomy.seed_colors(frame, spark.createDataFrame([], "color_raw string")).collect()}
    junk = {"40 cm", "12.5"}
    assert got == {c.lower(): (f, c.lower() if f else None, "junk" if c in junk else "classified" if f else "unclassified") for c, f in want.items()}
    rows = spark.createDataFrame([(1, "NAVY", "red", "old"), (2, "navy", "blue", "deep"), (3, "zzz", "red", "old"), (4, None, None, None)], "id int, color string, color_family string, color_shade string")
    mapping = taxonomy.seed_colors(frame, spark.createDataFrame([], "color_raw string"))
    assert sorted((r.id, r.color_family, r.color_shade) for r in taxonomy.stamp_colors(rows, mapping).collect()) == [(1, "blue", "navy"), (2, "blue", "deep"), (3, "red", "old"), (4, None, None)]
    names = spark.createDataFrame([("ar", " أسود ", "black"), ("ar", "نبيتي", "burgundy"), ("tr", " Lacivert", "navy"), ("tr", "Kahve", "brown"), ("tr", "Ocean", "ocean"), ("ar", "  ", None), ("tr", None, None)], "l string, c string, want string")
    for language in ("ar", "tr"):
        assert all(r.got == r.want for r in names.where(F.col("l") == language).withColumn("got", taxonomy.translate_color(F.col("c"), language)).collect())


def test_phrases_of_one_length_keep_their_order(spark):
    rows = [("relaxed tapered jeans", "tapered"), ("straight boot cut jeans", "bootcut"), ("slim wide leg", "wide leg"), ("loose chino", "baggy"), ("super baggy skinny fit", "baggy")]
    got = spark.createDataFrame(rows, "t string, want string").withColumn("c", taxonomy.fit_cut(F.lit("jeans"), F.col("t"), F.lit(""))).collect()
    assert [r.c for r in got] == [r.want for r in got]
    row = spark.range(1).select(taxonomy.longest_phrase(F.lit("half sleeve or full sleeve"), taxonomy.R.SLEEVES).alias("s"), taxonomy.longest_phrase(F.lit("puffer bomber"), taxonomy.R.JACKETS).alias("j")).first()
    assert (row.s, row.j) == ("half sleeve", "puffer")


def test_runs_count_their_own_rows_and_wait_for_the_day(spark, tmp_path):
    snaps = spark.createDataFrame([(1, DAY), (2, DAY)], "id long, snapshot_date date")
    root, log, other = (str(tmp_path / x) for x in ("out", "log", "other"))
    later = lambda: snaps.where("id > 1").withColumn("snapshot_date", F.date_add("snapshot_date", 1))
    first = maintenance.run_signals(spark, [maintenance.Signal("a", lambda: snaps), maintenance.Signal("z", lambda: snaps, requires=["later"])], snaps, root, log)
    assert {r.signal_id: r.rows_written for r in first.collect()} == {"a": 2, "z": 0}
    second = maintenance.run_signals(spark, [maintenance.Signal("a", later)], snaps, root, log)
    assert second.first().rows_written == 1 and spark.read.parquet(f"{root}/a").count() == 3
    products = [maintenance.Signal("p", lambda: snaps, requires=["a"]), maintenance.Signal("q", lambda: snaps, requires=["z"])]
    assert {r.signal_id: r.status for r in maintenance.run_signals(spark, products, snaps, root, other).collect()} == {"p": "skipped", "q": "skipped"}
    assert {r.signal_id: r.status for r in maintenance.run_signals(spark, products, snaps, root, other, gates=[log, str(tmp_path / "none")]).collect()} == {"p": "ok", "q": "skipped"}


def test_results_leave_only_when_the_archive_is_whole(spark, tmp_path, monkeypatch):
    day = lambda n: DAY - dt.timedelta(days=n)
    rows = spark.createDataFrame([(i, day(i * 10)) for i in range(6)], "id long, snapshot_date date")
    root = str(tmp_path / "archive")
    left = maintenance.archive_results(rows, root, str(DAY), 25)
    assert sorted(r.id for r in left.collect()) == [0, 1, 2] and sorted(r.id for r in spark.read.parquet(root).collect()) == [3, 4, 5]
    # A changed value with the number of rows as it was.
    monkeypatch.setattr(maintenance, "replace_days", lambda df, path, day: lake.replace_days(df.withColumn("id", F.when(F.col("id") == 4, 40).otherwise(F.col("id"))), path, day))
    with pytest.raises(RuntimeError):
        maintenance.archive_results(rows, str(tmp_path / "other"), str(DAY), 25)


def test_repartition_and_recompress_keep_all_rows(spark, tmp_path):
    rows = spark.createDataFrame([(1, DAY), (1, DAY), (2, DAY)], "id long, snapshot_date date")
    assert maintenance.repartition_by_day(rows, str(tmp_path / "days"), ["id"]) == 2
    assert maintenance.recompress(spark, str(tmp_path / "days"), str(tmp_path / "snappy")) == 2
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "snappy")).collect()) == [1, 2]
    assert maintenance.recompress(spark, str(tmp_path / "days"), str(tmp_path / "again"), day="snapshot_date") == 2
    assert [d for d, _ in list_days(spark, str(tmp_path / "again"))] == [DAY]
    rows.limit(0).write.parquet(str(tmp_path / "none"))
    assert maintenance.recompress(spark, str(tmp_path / "none"), str(tmp_path / "empty")) == 0
    assert spark.read.parquet(str(tmp_path / "empty")).dtypes == rows.dtypes


def test_size_shares_are_of_all_stock_outs(spark):
    rows = [(b, "M", "stockout", True, DAY) for b in "abc" for _ in range(10)] + [("a", "XS", "stockout", True, DAY)] * 10
    stock = spark.createDataFrame(rows, "brand string, size string, event_type string, witnessed boolean, event_date date")
    got = [(r.size_family, r.stockouts, r.demand_share_pct) for r in market.size_demand_curve(stock, str(DAY)).collect()]
    assert got == [("M", 30, 75.0)]


def test_cells_are_judged_by_their_own_events(spark):
    rows = spark.createDataFrame([(None,), (4,), (5,), (10,)], "n int")
    got = [(r.t, r.ok) for r in rows.select(boards.cell_tier(F.col("n")).alias("t"), boards.pct_reliable(F.col("n")).alias("ok")).collect()]
    assert got == [("maturing", False), ("maturing", False), ("directional", True), ("confirmed", True)]


def test_gender_of_breadcrumbs_and_of_brands_for_women(spark):
    row = spark.createDataFrame([("b", "men shirt", " WOMAN", None)], "brand string, title string, level1 string, none string").select(
        taxonomy.normalize_gender(F.col("title"), F.col("brand"), ("b",)).alias("a"), taxonomy.normalize_gender(F.col("title"), F.col("brand"), ("c",)).alias("b"),
        taxonomy.breadcrumb_gender(F.col("level1"), F.lit("kids")).alias("c"), taxonomy.breadcrumb_gender(F.col("none"), F.lit("kids")).alias("d"),
    ).first()
    assert tuple(row) == ("women", "men", "women", "kids")


def test_flags_look_back_hours_and_need_a_month(spark):
    e = events(spark, [(1, 0, 100, 50), (1, 5, 50, 100), (2, 90, 100, 50), (2, 95, 50, 100), (3, 91, 100, 1)])
    flagged = e.withColumns({"is_flash_sale": F.lit(False), "is_statistical_deal": F.col("product_id") == 2})
    now = str(at(5))
    assert [r.product_id for r in signals.flag_flash_sales(flagged, now).collect()] == [2]
    assert signals.flag_flash_sales(flagged.withColumn("is_flash_sale", F.lit(True)), now).count() == 0
    day = lambda n: at(5).date() - dt.timedelta(days=n)
    month = spark.createDataFrame([(p, day(n), 100.0) for p in (2, 3) for n in range(31)], "product_id long, snapshot_date date, price double")
    assert [r.product_id for r in capture.statistical_deals(flagged, month, now).collect()] == [3]
    assert capture.statistical_deals(flagged, month.where(F.col("snapshot_date") > F.lit(str(day(30))).cast("date")), now).count() == 0


def test_a_brand_is_frozen_only_if_nothing_moved(spark):
    day = lambda n: DAY - dt.timedelta(days=n)
    shots = spark.createDataFrame([(b, f"{b}{p}", day(n), 10.0, 20.0 if b == "sale" else None) for b in ("still", "sale", "ended") for p in range(3) for n in range(7)], "brand string, product_id string, snapshot_date date, price double, compare_at_price double")
    moves = spark.createDataFrame([("ended", "ended1", DAY, "up")], "brand string, product_id string, event_date date, direction string")
    got = {r.brand: r.frozen for r in quality.frozen_prices(shots, moves, str(DAY), min_products=2).collect()}
    assert got == {"still": True, "sale": False, "ended": False}


def test_table_health_names_what_is_wrong(spark):
    table = spark.createDataFrame([(DAY, "a", 1.0, None), (None, "b", None, None)], "day date, brand string, score double, depth_pct double")
    runs = spark.createDataFrame([("t", "ok", 5, at(9, 1)), ("t", "ok", 0, at(9, 2))], "signal_id string, status string, rows_written int, run_at timestamp")
    row = quality.table_health("t", table, "day", str(DAY), ["score", "depth_pct"], 2, runs).first()
    assert (row.n_rows, row.orphan_rows, row.empty_rows, row.worst_column, row.worst_rate) == (2, 1, 1, "depth_pct", 1.0)
    assert row.flags == "critical: orphan rows; critical: empty rows; warn: dead column; warn: a later run wrote nothing" and row.score == 60.0
    empty = quality.table_health("u", table.limit(0), "day", str(DAY), ["score"], 2, runs).first()
    assert (empty.score, empty.run_status) == (0.0, None) and empty.flags.startswith("critical: no rows")


def test_integrity_finds_late_writes_and_orphans(spark):
    products = spark.createDataFrame([(1,)], "product_id long")
    shots = spark.createDataFrame([(1, 5.0), (2, 0.0)], "product_id long, price double")
    lots = spark.createDataFrame([(1, 5.0, DAY, at(12)), (1, None, None, at(1)), (9, None, DAY, at(1))], "product_id long, first_observed_price double, delisted_at date, last_updated_at timestamp")
    got = {r.check: r.n for r in quality.integrity(shots, products, lots).collect()}
    assert got == {"orphan_snapshots": 1, "orphan_variants": 1, "bad_prices": 1, "null_baselines": 1, "written_after_delist": 1}


def test_event_tiers_keep_one_row_per_id(spark):
    schema = "event_id long, brand string, event_date date, witnessed boolean"
    hot = spark.createDataFrame([(1, "a", DAY, None)], schema)
    cold = spark.createDataFrame([(1, "a", DAY, True), (2, "a", DAY, True), (2, "a", DAY, True), (3, "a", DAY, None), (4, "a", dt.date(2023, 1, 1), True)], schema)
    assert sorted((r.event_id, r.witnessed) for r in lake.stock_history(hot, cold, str(DAY)).collect()) == [(1, None), (2, True)]
    assert [r.event_id for r in lake.stock_history(hot, cold.drop("witnessed"), str(DAY)).collect()] == [1]
    rules = spark.createDataFrame([("b", DAY)], "brand string, until date")
    assert sorted(r.event_id for r in lake.price_event_history(hot, cold, rules, str(DAY)).collect()) == [1, 2, 3]


def test_scans_archives_and_ad_hoc_tables(spark, tmp_path):
    root = str(tmp_path / "cold")
    lake.replace_days(spark.createDataFrame([(1, DAY), (2, DAY - dt.timedelta(days=9))], "id long, snapshot_date date"), root)
    schema = spark.createDataFrame([], "id long, snapshot_date date, note string").schema
    assert [tuple(r) for r in scan_days(spark, root, str(DAY), str(DAY), schema, defaults={"note": "old"}).collect()] == [(1, DAY, "old")]
    assert sorted(r.id for r in lake.archive_table(spark, root).collect()) == [1, 2] and spark.sql("select count(*) from archive").first()[0] == 2
    rows, more = lake.ad_hoc(spark, {"t": spark.range(5)}, "select * from t", 3)
    assert rows.count() == 3 and more
    prices = spark.createDataFrame([(1, "b", "c", DAY, 5.0)], "product_id long, brand string, category_normalized string, snapshot_date date, price double")
    assert lake.tiered_price_history(prices, None, str(DAY)).first().source == "hot"
    both = lake.tiered_price_history(prices, prices.withColumn("price", F.lit(9.0)), str(DAY)).collect()
    assert [(r.price, r.source) for r in both] == [(5.0, "hot+cold")]


def test_reports_are_written_twice_and_weeks_begin_on_monday(spark, tmp_path):
    maintenance.write_report(spark.createDataFrame([(1, 'a "b", c')], "n int, t string"), str(tmp_path), "run1")
    for place in ("run1", "latest"):
        assert tuple(spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/{place}/csv").first()) == ("1", 'a "b", c')
        assert spark.read.json(f"{tmp_path}/{place}/json").first().n == 1
    assert sorted(r.week_start for r in rollups.pending_weeks(spark, "2024-01-10").collect()) == [dt.date(2024, 1, 1), dt.date(2024, 1, 8)]


def test_settled_frames_are_read_from_the_shared_folder(spark, sf):
    shop, plain = Shop(spark, sf), Shop(spark, sf)
    shop.settle("products", "snapshots")
    assert "shop-" in shop.snapshots.inputFiles()[0] and "shop-" not in plain.snapshots.inputFiles()[0]
    assert shop.snapshots.exceptAll(plain.snapshots).count() == 0 and shop.snapshots.count() == plain.snapshots.count()


def test_flash_events_against_plain_search(spark):
    import numpy as np

    rng = np.random.default_rng(11)
    start = dt.datetime(2024, 1, 1)
    rows = [(i, int(rng.integers(0, 3)), start + dt.timedelta(minutes=int(rng.integers(0, 9000))), str(rng.choice(["up", "down"], p=[0.1, 0.9]))) for i in range(400)]
    rows += [(900, 9, start, "down"), (901, 9, start + dt.timedelta(hours=24), "up"), (902, 9, start, "up"), (903, 8, start, "down"), (904, 8, start + dt.timedelta(hours=24, microseconds=-1), "up")]
    got = {r.event_id for r in signals.flash_events(spark.createDataFrame(rows, "event_id int, product_id int, recorded_at timestamp, direction string")).collect()}
    day = dt.timedelta(hours=24)
    want = {i for i, p, t, d in rows if d == "down" and any(q == p and e == "up" and t < u < t + day for _, q, u, e in rows)}
    assert got == want and 903 in want and 900 not in want and 50 < len(want) < 350


def test_flash_events_of_one_product_take_one_pass(spark):
    """A million events of one product, every tenth a rise: all cuts but those after the last rise."""
    n = 1_000_000
    rows = spark.range(n).select(F.col("id").alias("event_id"), F.lit(1).alias("product_id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7).alias("recorded_at"), F.when(F.col("id") % 10 == 9, "up").otherwise("down").alias("direction"))
    begun = time.monotonic()
    assert signals.flash_events(rows).count() == n * 9 // 10
    assert time.monotonic() - begun < 60


def test_day_files_are_known_by_name(spark, tmp_path):
    root = str(tmp_path / "days")
    day = lambda n: DAY + dt.timedelta(days=n)
    lake.replace_days(spark.createDataFrame([(n, day(n), float(n)) for n in (0, 1, 3)], "id long, snapshot_date date, price double"), root)
    lake.replace_days(spark.createDataFrame([(4, day(4))], "id long, snapshot_date date"), root)  # an old file without prices
    for name in ("snapshot_date=soon", "snapshot_date=2024-02-31", "tmp", "_x"):
        (tmp_path / "days" / name).mkdir()
        (tmp_path / "days" / name / "part-0.parquet").write_bytes(b"no parquet")
    part = next((tmp_path / "days" / f"snapshot_date={day(3)}").glob("*.parquet"))
    (tmp_path / "days" / f"{day(5)}.parquet").write_bytes(part.read_bytes())  # a day as a single file
    (tmp_path / "days" / f"{day(9)}.parquet").write_bytes(b"not opened")
    schema = spark.createDataFrame([], "price double, id int, snapshot_date date, note string, witnessed boolean").schema
    rows = scan_days(spark, root, str(day(0)), str(day(5)), schema.add("seen", "boolean"), defaults={"witnessed": False, "price": -1.0})
    assert [d for d, _ in list_days(spark, root)] == [day(n) for n in (0, 1, 3, 4, 5, 9)]
    assert rows.columns == ["price", "id", "snapshot_date", "note", "witnessed", "seen"]


def test_scan_window(spark, tmp_path):
    root = str(tmp_path / "days")
    day = lambda n: DAY + dt.timedelta(days=n)
    lake.replace_days(spark.createDataFrame([(n, day(n), float(n)) for n in (0, 1, 3)], "id long, snapshot_date date, price double"), root)
    lake.replace_days(spark.createDataFrame([(4, day(4))], "id long, snapshot_date date"), root)
    broken = next((tmp_path / "days" / f"snapshot_date={day(0)}").glob("*.parquet"))
    broken.write_bytes(b"broken")  # outside the window: not even its footer is read
    part = next((tmp_path / "days" / f"snapshot_date={day(3)}").glob("*.parquet"))
    (tmp_path / "days" / f"{day(5)}.parquet").write_bytes(part.read_bytes())
    schema = spark.createDataFrame([], "price double, id long, snapshot_date date, witnessed boolean").schema
    rows = scan_days(spark, root, str(day(1)), str(day(5)), schema, defaults={"witnessed": False, "price": -1.0})
    assert sorted(tuple(r) for r in rows.collect()) == [(-1.0, 4, day(4), False), (1.0, 1, day(1), False), (3.0, 3, day(3), False), (3.0, 3, day(5), False)]
    assert {f.split("snapshot_date=")[-1][:10] for f in rows.inputFiles() if "snapshot_date=" in f} == {str(day(n)) for n in (1, 3, 4)}
    for where in (root, str(tmp_path / "none")):
        none = scan_days(spark, where, "2020-01-01", "2020-02-01", schema)
        assert none.schema == schema and none.count() == 0
    found = {r["table"]: (r.days, r.earliest, r.latest) for r in depth(spark, {"a": (root, "snapshot_date"), "b": (str(tmp_path / "none"), "day")}).collect()}
    assert found == {"a": (5, day(0), day(5)), "b": (0, None, None)}


def test_older_days_of_the_archive_are_not_shuffled(spark, tmp_path):
    root = str(tmp_path / "cold")
    day = lambda n: DAY + dt.timedelta(days=n)
    lake.replace_days(spark.createDataFrame([(n, day(n), "b", 1.0) for n in range(6)], "event_id long, event_date date, brand string, price double"), root, "event_date")
    hot, cold = spark.createDataFrame([(4, day(4), "b", 2.0), (7, day(5), "b", 2.0)], "event_id long, event_date date, brand string, price double"), spark.read.parquet(root)
    want = [(0, 1.0), (1, 1.0), (2, 1.0), (3, 1.0), (4, 2.0), (5, 1.0), (7, 2.0)]
    for rows in (lake.stitch(hot, cold, "event_id", "event_date"), lake._one_per_event(hot, cold, str(day(9)), 90)):
        assert sorted((r.event_id, r.price) for r in rows.collect()) == want
        lines = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].splitlines()
        depth_of = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
        moved = []
        for i, line in enumerate(lines):
            if "FileScan" in line:
                above, least = [], depth_of(line)
                for up in reversed(lines[:i]):
                    if depth_of(up) < least:
                        least = depth_of(up)
                        above.append(up)
                moved.append(any("Exchange" in up for up in above))
        assert sorted(moved) == [False, True]
    assert sorted(r.event_id for r in lake.stitch(hot.limit(0), cold, "event_id", "event_date").collect()) == list(range(6))


def test_a_changed_value_is_caught(spark, tmp_path):
    rows = spark.createDataFrame([(i, DAY, float(i), {"a": str(i)}, [i]) for i in range(50)], "id long, snapshot_date date, price double, m map<string,string>, a array<long>")
    assert lake.differing_days(rows, rows.orderBy(F.desc("id")).repartition(7)) == []
    for changed in (rows.withColumn("price", F.when(F.col("id") == 7, 1.0).otherwise(F.col("price"))), rows.withColumn("price", F.when(F.col("id") != 7, F.col("price"))), rows.where("id <> 3").unionByName(rows.where("id = 4"))):
        assert lake.differing_days(rows, changed) == [DAY]
    swapped = spark.createDataFrame([(1, DAY, None, 5), (2, DAY, 5, None)], "id long, snapshot_date date, a int, b int")
    assert lake.differing_days(swapped, swapped.withColumns({"a": F.col("b"), "b": F.col("a")})) == [DAY]


def test_only_proven_days_leave_and_context_goes_along(spark, tmp_path, monkeypatch):
    day = lambda n: DAY - dt.timedelta(days=n)
    hot = spark.createDataFrame([(i, i % 2, day(i * 10)) for i in range(5)] + [(9, 0, None)], "id long, product_id int, snapshot_date date")
    names = spark.createDataFrame([(0, "zero")], "product_id int, product_name string")
    root = str(tmp_path / "cold")
    kept = lake.replace_days
    monkeypatch.setattr(lake, "replace_days", lambda df, path, d: kept(df.withColumn("id", F.when(F.col("id") == 3, 33).otherwise(F.col("id"))), path, d))
    left = maintenance.archive_days(hot, root, str(tmp_path / "s"), "id", str(DAY), 14, context=names, context_keys=["product_id"])
    assert sorted(r.id for r in left.collect()) == [0, 1, 3, 9]  # the day of 3 is not proven; 9 has no day
    assert {(r.id, r.product_name) for r in spark.read.parquet(root).collect()} == {(2, "zero"), (33, None), (4, "zero")}


def test_legacy_files_go_after_proof(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(1, DAY), (1, DAY), (2, DAY - dt.timedelta(days=1))], "id long, snapshot_date date")
    old = str(tmp_path / "legacy.parquet")
    rows.write.parquet(old)
    with monkeypatch.context() as m:
        m.setattr(maintenance, "replace_days", lambda df, path, day: lake.replace_days(df.where("id = 1"), path, day))
        with pytest.raises(RuntimeError):
            maintenance.repartition_by_day(spark.read.parquet(old), str(tmp_path / "broken"), ["id"], legacy=[old])
    assert spark.read.parquet(old).count() == 3
    assert maintenance.repartition_by_day(spark.read.parquet(old), str(tmp_path / "whole"), ["id"], legacy=[old]) == 2
    assert not (tmp_path / "legacy.parquet").exists()


def test_only_weeks_that_differ_are_written(spark, tmp_path):
    root = str(tmp_path / "weeks")
    day = lambda n: dt.date(2024, 1, n)
    rows = [(1, "b", "c", "g", 9.0, day(n), float(n)) for n in (2, 3, 9, 16, 17, 23)]
    schema = "product_id long, brand string, category_normalized string, gender string, first_observed_price double, snapshot_date date, price double"
    none = (spark.createDataFrame([], "product_id long, direction string, discount_pct double, recorded_at timestamp, event_date date"), spark.createDataFrame([], "product_id long, witnessed boolean, event_type string, recorded_at timestamp"))
    asked = []

    def build(data):
        def run(first, last):
            asked.append((first, last))
            return rollups.weekly_product_summary(spark.createDataFrame(data, schema).where(F.col("snapshot_date").between(F.lit(first), F.lit(last))), *none)

        return run

    def files():
        return {str(f): f.stat().st_mtime_ns for f in (tmp_path / "weeks").glob("week_start=*/*.parquet")}

    lake.replace_days(build(rows)(day(1), day(31)), root, "week_start")
    before = files()
    assert rollups.refresh_weeks(spark, build(rows), root, "2024-01-24") == [] and files() == before
    assert asked[-1] == (day(15), day(28))  # from the Monday of the first day touched to the Sunday of the last
    later = [*rows[:-1], (1, "b", "c", "g", 9.0, day(18), 3.0)]  # a late row, and a week whose only row is gone
    assert rollups.refresh_weeks(spark, build(later), root, "2024-01-24") == [day(15), day(22)]
    after = files()
    assert {f for f in after if f in before} == {f for f in before if "01-01" in f or "01-08" in f} and not any("01-22" in f for f in after)
    full = rollups.weekly_product_summary(spark.createDataFrame(later, schema), *none)
    assert lake.differing_days(full, spark.read.parquet(root), "week_start") == []


def test_reclassifying_from_a_summary_equals_the_whole_history(spark):
    import random

    rng = random.Random(8)
    rows = [(i, rng.randrange(80), rng.choice(["restock", "stockout", "delisted"]), None if rng.random() < 0.1 else True, at(1) + dt.timedelta(hours=rng.randrange(600))) for i in range(250)]
    stock = spark.createDataFrame([(*r, r[4].date()) for r in rows], "event_id long, variant_id long, event_type string, witnessed boolean, recorded_at timestamp, event_date date").persist()
    whole = {tuple(r) for r in capture.reclassify_witnessed(stock, "2024-01-26").collect()}
    assert {r[4] for r in whole} == {None, "orphan_restock", "duplicate_transition", "delist_cycle"}
    for cut in (1, 9, 17):
        days = lambda lo, hi: stock.where(F.col("event_date").between(dt.date(2024, 1, lo), dt.date(2024, 1, hi)))
        summary = capture.transition_summary(days(cut, 17), capture.transition_summary(days(1, cut - 1)) if cut > 1 else None)
        recent = {tuple(r) for r in capture.reclassify_witnessed(days(18, 31), "2024-01-26", before=summary).collect()}
        assert recent == {r for r in whole if r[5] > dt.date(2024, 1, 17)}


def test_overlapping_colours_in_titles(spark):
    import random
    import re

    from stallwatch.functions import rule_tables as R

    rng = random.Random(2)
    parts = [w for c in R.TITLE_COLORS for w in re.split("[ -]", c)]
    titles = [rng.choice(["", "x"]).join(rng.choice(parts) + rng.choice([" ", " ", "-", "", ", ", "é"]) for _ in range(rng.randint(1, 7))) for _ in range(400)]
    got = spark.createDataFrame([(t,) for t in titles], "t string").select("t", taxonomy._named_color(F.col("t")).alias("c")).collect()
    order = sorted(R.TITLE_COLORS, key=lambda c: -len(c))
    for r in got:
        want = next((c for c in order if re.search(f"(?<![a-z]){re.escape(c)}(?![a-z])", r.t)), None)
        assert r.c == want, r.t
    assert sum(r.c is not None for r in got) > 100


def test_graded_titles(spark):
    """Titles as shops write them, graded by hand."""
    rows = [
        ("tail", "Slim Fit Cotton Shirt - Light Blue", "light blue"), ("tail", "Basic T-Shirt | Off White", "off white"), ("tail", "Linen Trousers \u2013 Regular", None), ("tail", "Black Jeans - Slim", "black"),
        ("scan", "Raw denim jacket in navy blue", "navy blue"), ("scan", "Leather belt with gold buckle", None), ("scan", "Gold sandals", "gold"), ("scan", "Tangerine dress", None), ("scan", "Red and dark grey scarf", "dark grey"),
        ("end", "Striped Knit Sweater White", "white"), ("end", "Beige Cap", "beige"), ("end", "Mint Green Set for Girls", "mint green"), ("dash", "Hoodie - sage fog", "sage fog"), ("dash", "Jacket - " + "x" * 31, None), ("end", "", None),
    ]
    got = spark.createDataFrame(rows, "s string, t string, want string").select("t", "want", taxonomy.color_from_title(F.col("s"), F.col("t")).alias("c")).collect()
    assert [(r.t, r.c) for r in got] == [(r.t, r.want) for r in got]


def test_baselines_at_first_sight_and_delisting_twice(spark):
    seen = spark.createDataFrame([(1, 10, at(1), 9.0), (1, 11, at(1), 7.0), (1, 12, at(2), 3.0), (1, 10, at(3), 2.0), (2, 20, at(1), 0.0), (2, 20, at(2), 5.0)], "product_id long, variant_id long, seen_at timestamp, price double")
    none = spark.createDataFrame([], "product_id long, first_observed_price double")
    assert sorted(tuple(r) for r in capture.seed_product_baselines(seen, none).collect()) == [(1, 7.0), (2, 5.0)]  # 12 came later
    known = spark.createDataFrame([(11, 1, 99.0)], "variant_id long, product_id long, first_observed_price double")
    assert sorted((r.variant_id, r.first_observed_price) for r in capture.seed_variant_baselines(seen, known).collect()) == [(10, 9.0), (11, 99.0), (12, 3.0), (20, 5.0)]
    products = spark.createDataFrame([(1, "b", True, DAY), (2, "b", True, dt.date(2024, 1, 30)), (3, "b", False, DAY), (4, "b", None, DAY)], "product_id long, brand string, is_active boolean, last_seen date")
    variants = spark.createDataFrame([(10, 1, True, None), (11, 1, False, DAY), (20, 2, True, None), (30, 3, True, None)], "variant_id long, product_id long, is_in_stock boolean, delisted_at date")
    after, listed, events = capture.delist(products, variants, "2024-01-31")
    assert {r.product_id: r.is_active for r in after.collect()} == {1: False, 2: True, 3: False, 4: None}
    assert {r.variant_id: (r.is_in_stock, r.delisted_at) for r in listed.collect()} == {10: (True, dt.date(2024, 1, 31)), 11: (False, DAY), 20: (True, None), 30: (True, None)}
    assert [(r.variant_id, r.event_type, r.witnessed) for r in events.collect()] == [(10, "delisted", None)]
    again = capture.delist(after, listed, "2024-02-01")
    assert again[2].count() == 0 and sorted(again[1].collect()) == sorted(listed.collect())


def test_markdown_and_report_days(spark, tmp_path):
    maintenance.write_report(spark.createDataFrame([(1, "a|b\nc"), (2, None)], "n int, `t|x` string"), str(tmp_path), "run1")
    for place in ("run1", "latest"):
        assert [r.value for r in spark.read.text(f"{tmp_path}/{place}/md").collect()] == ["| n | t\\|x |", "| --- | --- |", "| 1 | a\\|b<br>c |", "| 2 |  |"]
    path = str(tmp_path / "product")
    lake.replace_days(spark.createDataFrame([(1, DAY), (2, DAY - dt.timedelta(days=1))], "id long, report_date date"), path, "report_date")
    lake.replace_days(spark.createDataFrame([(3, DAY)], "id long, report_date date"), path, "report_date")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 3]


def test_a_stuck_signal_is_cancelled_and_others_finish(spark, tmp_path):
    snaps = spark.createDataFrame([(1, DAY)], "id long, snapshot_date date")

    def stuck():
        wait = F.udf(lambda x: time.sleep(600) or x, "long")
        return snaps.withColumn("id", wait("id"))

    begun = time.monotonic()
    runs = maintenance.run_signals(spark, [maintenance.Signal("after", lambda: snaps, requires=["stuck"]), maintenance.Signal("stuck", stuck), maintenance.Signal("a", lambda: snaps), maintenance.Signal("b", lambda: snaps, requires=["a"])], snaps, str(tmp_path / "out"), str(tmp_path / "log"), time_limit=15)
    assert time.monotonic() - begun < 120
    got = {r.signal_id: (r.status, r.reason) for r in runs.collect()}
    assert got == {"after": ("skipped", "needs stuck"), "stuck": ("failed", "cancelled after 15 s"), "a": ("ok", None), "b": ("ok", None)}


def test_waves(spark):
    made = lambda name, *needs: maintenance.Signal(name, None, requires=list(needs))
    waves = maintenance.run_waves([made("c", "b", "elsewhere"), made("a"), made("b", "a"), made("d", "a")])
    assert [[s.signal_id for s in w] for w in waves] == [["a"], ["b", "d"], ["c"]]
    with pytest.raises(ValueError):
        maintenance.run_waves([made("a", "b"), made("b", "a")])


def test_subcategories_are_filled_in_two_passes(spark):
    rows = [(1, " T-SHIRTS", "Print basic", None, True), (2, "jeans", "mom flare", None, True), (3, "jeans", "MOM fit", None, True), (4, "jeans", "mom fit", None, False), (5, "jeans", "slim", "known", True), (6, None, "slim", None, True), (7, "jeans", None, None, True), (8, "dresses", "maximum", None, True), (9, "dresses", "Maxi", None, None), (9, "dresses", "Maxi", None, None)]
    products = spark.createDataFrame(rows, "product_id long, category_normalized string, product_name string, subcategory string, is_active boolean")
    filled = taxonomy.fill_subcategories(products)
    assert filled.columns == products.columns
    got = sorted((r.product_id, r.subcategory) for r in filled.collect())
    assert got == [(1, "basic"), (2, "flare"), (3, "mom-fit"), (4, None), (5, "known"), (6, None), (7, None), (8, None), (9, None), (9, None)]
    assert taxonomy.fill_subcategories(products.limit(0)).count() == 0


def test_distress_rounds_ties_of_depths_up_in_any_order(spark):
    depths = {"a": [28.49, 5.76, 25.3], "b": [2.86, 0.01, 0.0, None], "c": [-0.05, -0.05], "d": [None]}
    rows = [("x", "y", brand, depth) for brand, values in depths.items() for depth in values]
    schema = "category_normalized string, subcategory string, brand string, last_depth_pct double"
    for drawn in (rows, rows[::-1], sorted(rows, key=str)):
        got = {r.brand: (r.escalating, r.avg_depth) for r in order_board.distress(spark.createDataFrame(drawn, schema), 0).collect()}
        assert got == {"a": (3, 19.9), "b": (4, 1.0), "c": (2, 0.0), "d": (1, None)}  # 19.85, 0.95666, -0.05: half up


def test_alerts_are_neither_moved_nor_repeated(spark):
    drops = spark.createDataFrame([(1, "b", "c", ["S", "M"], 50.0, 20.0, 90.0), (1, "b", "c", ["S"], 50.0, 20.0, 90.0), (1, "b", "c", ["S"], 50.0, 9.4, 90.0), (2, "b", "c", ["S"], 80.0, 20.0, 90.0)], "product_id long, brand string, category_normalized string, sizes_in_stock array<string>, price_after double, discount_pct double, first_observed_price double")
    users = spark.createDataFrame([(1, True, None), (2, True, 60.0), (2, True, 10.0), (3, False, None), (4, True, 60.0), (4, True, None)], "user_id long, is_active boolean, price_ceiling double")
    sizes = spark.createDataFrame([(u, "c", "S") for u in (1, 1, 2, 3, 4)], "user_id long, category string, size string")
    follows = spark.createDataFrame([(u, "b") for u in (1, 1, 2, 3, 4)], "user_id long, brand string")
    found = capture.match_alerts(drops, users, sizes, follows)
    assert sorted((r.user_id, r.product_id) for r in found.collect()) == [(1, 1), (1, 2), (2, 1), (4, 1), (4, 2)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan.split("Aggregate")[0] and "RepartitionByExpression" not in plan.split("Join")[0]  # nothing gathers the pairs


def test_alerts_keep_a_drop_over_a_block_of_followers(spark):
    kind = "brand string, category string, size string"
    drops = spark.createDataFrame([("b", "c", "S", p, 10.0 + p, 20.0) for p in range(90)], f"{kind}, product_id long, price_after double, discount_pct double")
    ceilings = {u: None if u % 3 else u / 10 for u in range(1000)}
    wanted = spark.createDataFrame([("b", "c", "S", u, c) for u, c in ceilings.items()], f"{kind}, user_id long, price_ceiling double")
    found = [(r.product_id, r.user_id) for r in capture.meet(drops, wanted, slices=2, block=64).collect()]
    assert sorted(found) == [(p, u) for p in range(90) for u, c in ceilings.items() if c is None or 10.0 + p <= c]
    runs = 1 + sum(a[0] != b[0] for a, b in zip(found, found[1:]))
    assert runs <= 90 * (1000 // 64 + 2)  # as many as there are blocks; a written column then repeats itself
