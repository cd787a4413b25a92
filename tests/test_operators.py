"""Contracts, documented departures and properties of the table operators."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from arealoom.functions.text import key_slug
from arealoom.operators import aggregates as AG
from arealoom.operators import audit as AU
from arealoom.operators import bridges as B
from arealoom.operators import catalog as C
from arealoom.operators import joins as J
from arealoom.operators import period as P
from arealoom.operators import profiling as PR
from arealoom.operators import reshape as RS
from arealoom.operators import windows as W
from arealoom.operators.audit import ContractError
from arealoom.operators.cells import combine_headers, detect_header_row
from arealoom.plans.master import assemble_master


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


@pytest.fixture(scope="module")
def alloc(spark):
    values = spark.createDataFrame([("A", 100.0), ("B", 50.0), ("C", None)], "f string, v double")
    edges = [("A", "X", 0.25), ("A", "Y", 0.75), ("B", "Y", 1.0), ("C", "Z", 1.0), ("D", "Z", 1.0), ("A", "Q", 0.0)]
    return values, spark.createDataFrame(edges, "f string, t string, r double")


def test_allocation_fixture(alloc):
    values, bridge = alloc
    out = B.allocate(values, bridge, "f", "t", "r", ["v"])
    assert rows(out.select("t", "v", "split_edges"), "t") == [("X", 25.0, 1), ("Y", 125.0, 1), ("Z", None, 0)]
    audit = B.allocation_audit(values, out, bridge, "f", ["v"]).first()
    assert (audit.source_total, audit.allocated_total, audit.retained_pct, audit.status) == (150, 150, 100, "pass")


def test_target_of_suppressed_counts_is_null_unless_asked(alloc):
    values, bridge = alloc
    zero = B.allocate(values, bridge, "f", "t", "r", ["v"], zero_if_all_null=True)
    assert zero.filter("t = 'Z'").first().v == 0.0


def test_retained_is_compared_as_a_percentage(alloc):
    values, bridge = alloc
    lost = bridge.filter("f <> 'B'")
    out = B.allocate(values, lost, "f", "t", "r", ["v"])
    audit = B.allocation_audit(values, out, lost, "f", ["v"])
    assert audit.first().status == "review"
    assert AU.allocation_gate(audit, 60).first().status == "pass"
    assert AU.allocation_gate(audit, 60, True).first().status == "fail"


def test_dominant_tie_goes_to_the_smaller_code(spark):
    df = spark.createDataFrame([("K", "Q", 0.5), ("K", "P", 0.5), ("K", "R", 0.2), ("L", "S", None)], "k string, c string, w double")
    got = rows(B.dominant(df, "k", "c", "w").select("k", "c", "multi_region", "assignment_method"), "k")
    none = "single_or_first_record_no_weight_found"
    assert got == [("K", "P", True, "dominant_by_weight"), ("L", "S", False, none)]


def test_dominant_gives_one_row_per_key(spark):
    df = spark.range(3000).select((F.col("id") % 97).alias("k"), (F.col("id") % 31).alias("c"), F.rand(1).alias("w"))
    best = B.dominant(df, "k", "c", "w")
    assert best.count() == best.select("k").distinct().count() == 97


WINDOW = dict(target="2021-12-31", start="2021-01-01", end="2022-06-30")
PERIOD_CASES = [
    (["2021-06-30", "2022-03-31"], "target_window", "later", "2022-03-31", "closest_to_target_inside_window"),
    (["2021-12-01", "2022-01-30"], "target_window", "later", "2022-01-30", "closest_to_target_inside_window"),
    (["2021-12-01", "2022-01-30"], "target_window", "earlier", "2021-12-01", "closest_to_target_inside_window"),
    (["2019-06-30", "2023-06-30"], "target_window", "later", "2023-06-30",
     "no_period_inside_window_closest_available_to_target"),
    (["2021-06-30", "2022-03-31", "2023-03-31"], "latest_within_window", "later", "2022-03-31",
     "latest_available_inside_target_window"),
    (["2021-01-05", "2022-07-01"], "closest_to_target_any", "later", "2022-07-01", "closest_to_target_any"),
    (["2021-06-30", "2020-03-31"], "earliest", "later", "2020-03-31", "earliest_available"),
    (["2021-06-30", "2020-03-31"], "latest", "later", "2021-06-30", "latest_available"),
]


@pytest.mark.parametrize("available, policy, tie, wanted, basis", PERIOD_CASES)
def test_choose_period(spark, available, policy, tie, wanted, basis):
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in available * 2], "d date")
    got = P.choose_period(df, "d", policy, tie=tie, **WINDOW).first()
    assert (got.selected_period.isoformat(), got.alignment_basis) == (wanted, basis)
    chosen = P.select_period(df, "d", policy=policy, tie=tie, **WINDOW)
    again = P.select_period(chosen, "d", policy=policy, tie=tie, **WINDOW)
    assert chosen.count() == again.count() == 2


def test_no_period(spark):
    df = spark.createDataFrame([(None,)], "d date")
    assert P.choose_period(df, "d", **WINDOW).first().alignment_basis == "no_available_periods"


def test_join_contracts(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, x string")
    right = spark.createDataFrame([(1, 10), (1, 11), (None, 12)], "k int, y int")
    with pytest.raises(AU.ContractError):
        J.contract_join(left, right, "k")
    one = right.filter("y <> 11")
    got = J.contract_join(left, one, "k", flag="present")
    assert rows(got.select("x", "y", "present"), "x") == [("a", 10, True), ("b", None, False), ("c", None, False)]
    with pytest.raises(AU.ContractError):
        J.contract_join(left, one.withColumnRenamed("y", "x"), "k")
    renamed = J.contract_join(left, one.withColumnRenamed("y", "x"), "k", collision="rename_right", suffixes=("", "_r"))
    assert renamed.columns == ["k", "x", "x_r"]


def test_semi_and_anti_make_the_whole(spark):
    left = spark.range(100).withColumnRenamed("id", "k")
    right = left.filter("k % 3 = 0")
    assert J.in_spine(left, right, "k").count() + J.unmatched(left, right, "k", "x").count() == 100


def test_fallback_join_scopes(spark):
    left = spark.createDataFrame([("101021007", "21007"), ("zz", "12345"), ("yy", "99999")], "c string, s string")
    right = spark.createDataFrame(
        [("101021007", "11007", "T1"), ("900002345", "12345", "T2"), ("800009999", "99999", "T3"), ("700009999", "99999", "T4")],
        "full string, short string, t string",
    )
    by_row = J.fallback_join(left, right, ("c", "full"), ("s", "short"))
    assert rows(by_row.select("c", "t", "join_method"), "c") == [
        ("101021007", "T1", "exact_key"), ("yy", None, "ambiguous_derived_key"), ("zz", "T2", "derived_key"),
    ]
    by_table = J.fallback_join(left, right, ("c", "full"), ("s", "short"), scope="table")
    assert rows(by_table.select("c", "join_method"), "c") == [
        ("101021007", "exact_key"), ("yy", "unmatched"), ("zz", "unmatched"),
    ]
    with pytest.raises(AU.ContractError):
        J.fallback_join(left, right, ("c", "full"), ("s", "short"), on_ambiguous="raise")


def test_merge_wide_skips_repeated_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, c string")
    b = spark.createDataFrame([(1, "y", 5), (2, "z", 6)], "k int, c string, d int")
    assert rows(J.merge_wide([a, b], "k").select("k", "c", "d"), "k") == [(1, "x", 5), (2, None, 6)]


def test_normalise_ratio_median_is_exact(spark):
    for values, scaled in (([0.5, 1.0, 80.0], False), ([0.5, 2.0], True), ([0.2, 1.5], False), ([50.0], True), ([None], False)):
        df = spark.createDataFrame([(v,) for v in values], "r double")
        first = rows(B.normalise_ratio(df, "r"))
        assert first == [((v / 100 if scaled else v) if v is not None else None,) for v in values]


def test_ffill_matches_a_plain_window(spark):
    from pyspark.sql import Window

    df = spark.range(5000).select(
        (F.col("id") % 2).alias("p"), F.col("id").alias("n"), F.when(F.col("id") % 501 == 3, F.col("id")).alias("v")
    )
    w = Window.partitionBy("p").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    want = rows(df.select("n", F.last("v", True).over(w).alias("v")), "n")
    assert rows(W.ffill(df, "p", "n", ["v"], block=64).select("n", "v"), "n") == want


def test_duplicate_groups_numbers_are_consecutive(spark):
    df = spark.range(900).select(
        F.sha2((F.col("id") % 400).cast("string"), 256).alias("h"), F.concat(F.lit("f/"), F.col("id").cast("string")).alias("p")
    )
    out = W.duplicate_groups(df, "h", "p")
    ids = sorted(r[0] for r in out.select("duplicate_group_id").distinct().collect())
    assert ids == list(range(1, 401))
    assert out.filter("suggested_keep").count() == 400


def test_merge_records_keeps_every_origin(spark):
    a = spark.createDataFrame([("k", "", 1), ("k", "v2", 2)], "key string, v string, o int")
    b = spark.createDataFrame([("k", "v3", 1)], "key string, v string, o int")
    assert rows(W.merge_records([("a", a), ("b", b)], "key", ["v"], "o")) == [("k", "a;a;b", "v2")]


def test_unique_names_never_clash(spark):
    names = ["A b", "a_b", "a_b_2", "A B", "", "Unnamed: 1"]
    unique = C.unique_names(names)
    assert unique == ["a_b", "a_b__2", "a_b_2", "a_b_3", "col", "col_2"]
    catalog = spark.createDataFrame([("t", i, n) for i, n in enumerate(names)], C.CATALOG_SCHEMA)
    got = [r[0] for r in C.unique_columns(catalog).orderBy("ordinal").select("unique_name").collect()]
    assert got == unique


def test_rename_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "a__unnamed int, a__relative_root_mean_square_error_flag int")
    with pytest.raises(AU.ContractError):
        C.rename_by_suffix(df)


def test_finest_level_wins_and_can_be_restricted(spark):
    df = spark.range(40).select((F.col("id") + 10100).cast("string").alias("code"))
    assert PR.geography_from_values(df).first().native_geography == "sa3"
    assert PR.geography_from_values(df, allowed=["lga", "state"]).first().native_geography == "lga"


def test_detection(spark):
    df = spark.createDataFrame(
        [("31/12/2021", "101021007", "Goulburn", "1,234", "12"), ("30/06/2021", "101021008", "Yass", "n.p.", "13")],
        "RprtDt string, SA2Cd2016 string, SA2Nm2016 string, PrtcpntCnt string, rate string",
    )
    named = df.withColumnRenamed("PrtcpntCnt", "ParticipantCount")
    assert PR.detect_period_column(named) == "RprtDt"
    assert PR.detect_measure(named, ["SA2Cd2016", "SA2Nm2016"]) == "ParticipantCount"
    assert PR.detect_key(named, "sa2") == "SA2Cd2016"
    assert PR.detect_name_column(named, "SA2Cd2016") == "SA2Nm2016"


def test_expectations(spark):
    df = spark.createDataFrame([("a", "p"), ("a", "q"), (None, "r")], "f string, g string")
    for broken in (
        lambda: AU.expect_unique(df, "f"), lambda: AU.expect_not_null(df, "f"), lambda: AU.expect_fd(df, "f", "g"),
        lambda: AU.expect_range(df, {"n": (F.count("*"), 10, 20)}),
        lambda: AU.gate(AU.run_checks(df, [AU.Check("none", F.count("*"), lambda v: v == 0)])),
    ):
        with pytest.raises(AU.ContractError):
            broken()
    AU.expect_unique(df, "g")


def test_pct_zero_denominator(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "n double, d double")
    from arealoom.functions import pct

    assert df.select(pct("n", "d")).first()[0] is None


def test_header_of_a_sparse_grid(spark):
    cells = [
        ("f", "s", 0, 0, "Title"), ("f", "s", 2, 0, "Area"), ("f", "s", 2, 2, "Persons"), ("f", "s", 3, 0, "Code"),
        ("f", "s", 3, 1, "Name"), ("f", "s", 3, 2, "Count"), ("f", "s", 3, 3, "Rate %"), ("f", "s", 4, 0, "101"),
        ("f", "s", 4, 3, "5"),
    ]
    grid = spark.createDataFrame(cells, "file string, sheet string, row_idx int, col_idx int, value string")
    found = detect_header_row(grid)
    assert found.first().header_row == 3
    got = {r.col_idx: r.header for r in combine_headers(grid, found, window=2).collect()}
    assert got == {0: "Area | Code", 1: "Area | Name", 2: "Persons | Count", 3: "Persons | Rate %"}


def test_duplicate_null_key_is_a_group(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    assert rows(AG.duplicate_keys(df, "k")) == [(None, 2)]


def test_merge_wide_raises_on_a_repeated_key(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y")], "k int, c string")
    b = spark.createDataFrame([(1, 5)], "k int, d int")
    with pytest.raises(Exception, match="several rows for key"):
        J.merge_wide([a, b], "k").collect()


def test_an_unlisted_pivot_name_raises(spark):
    long = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (1, None, 3.0)], "k int, name string, v double")
    assert RS.pivot_first(long, "k", "name", "v", ["a", "b"], F.col("v")).first().asDict() == {"k": 1, "a": 1.0, "b": 2.0}
    with pytest.raises(Exception, match="not listed"):
        RS.pivot_first(long, "k", "name", "v", ["a"], F.col("v")).collect()


def test_long_labels_stay_apart(spark):
    stem = "m" * 120
    long = spark.createDataFrame([(1, stem + "one", 1.0), (1, stem + "two", 2.0)], "k int, name string, v double")
    labels = [r.s for r in long.select(key_slug("name", 90, "plain").alias("s")).collect()]
    assert len(set(labels)) == 2 and all(len(s) <= 90 for s in labels)
    assert set(RS.pivot_sum(long, "k", ["name"], "v", labels).first()[1:]) == {1.0, 2.0}


def test_places_of_a_whole_sort(spark):
    df = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 7 > 0, F.col("id") % 13).alias("v")).repartition(9)
    got = {r.id: r.place for r in W.numbered_sort(df, "-v", "id").collect()}
    want = sorted(range(5000), key=lambda i: (i % 7 == 0, -(i % 13) if i % 7 else 0, i))
    assert [i for i, _ in sorted(got.items(), key=lambda x: x[1])] == want and sorted(got.values()) == list(range(1, 5001))


def test_a_master_checks_each_side_once(spark):
    spine = spark.range(20).withColumnRenamed("id", "k")
    sources = {f"s{i}": spark.range(10).select(F.col("id").alias("k"), F.lit(i).alias(f"v{i}")) for i in range(5)}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("master", "checks of a master")
    try:
        out = assemble_master(spine, "k", sources)
        jobs = len(tracker.getJobIdsForGroup("master"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # one check of each side, each a few jobs of adaptive stages, whatever the number of joins before it
    assert jobs <= 4 * 6
    assert out.count() == 20 and out.filter("source_s4_present_flag").count() == 10
    with pytest.raises(ContractError):
        assemble_master(spine, "k", {"twice": sources["s0"].union(sources["s0"])})


def test_five_detectors_from_one_stored_profile(spark, tmp_path):
    P = PR
    rows = [(f"1{i:08d}", f"Area {i % 40}", "30 June 2021", str(i * 3), "x" if i % 9 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "`SA2 Code` string, `SA2 name` string, period string, `participant count` string, note string")
    P.column_profile(df).write.parquet(str(tmp_path / "profile"))
    profile = spark.read.parquet(str(tmp_path / "profile"))
    scores = P.scores_from_profile(profile, "sa2")
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    got = {(r.detector, r.column_name): round(r.score, 6) for r in scores.collect()}
    for name, direct in {
        "measure": P.measure_scores(df), "period": P.period_column_scores(df), "key": P.key_column_scores(df, "sa2"),
        "indicator": P.indicator_scores(df).withColumnRenamed("numeric_share", "score"),
        "name": P.alphabetic_shares(df).withColumnRenamed("text_share", "score"),
    }.items():
        assert {c: s for (d, c), s in got.items() if d == name} == {r.column_name: round(r.score, 6) for r in direct.collect()}, name
    # profiles of parts merge to the profile of the whole
    parts = P.column_profile(df.withColumn("file", F.substring("note", 1, 1)), by="file")
    merged = {r.column_name: r.asDict() for r in P.merge_profiles(parts).drop("distinct_sketch").collect()}
    whole = {r.column_name: r.asDict() for r in profile.drop("distinct_sketch").collect()}
    assert merged == whole
    sizes = {r.column_name: r.n for r in profile.select("column_name", F.hll_sketch_estimate("distinct_sketch").alias("n")).collect()}
    assert abs(sizes["SA2 Code"] - 400) < 20 and sizes["note"] == 1


def test_code_columns_have_one_length(spark):
    P = PR
    for n in (150, 1500, 15_000, 150_000):
        rows = spark.range(n).select(
            F.col("id").cast("string").alias("running"), (F.col("id") % 2000).cast("string").alias("counted"),
            F.concat(F.lit("1"), F.lpad((F.col("id") % 90).cast("string"), 4, "0")).alias("sparse"),
        )
        scores = {r.column_name: r.level for r in P.geography_value_scores(rows).filter("level <> 'lga'").collect()}
        assert scores == {"sparse": "sa3"}, n


def test_origins_with_their_counts(spark):
    a, b = spark.range(3).select(F.lit(1).alias("k"), "id", F.lit("x").alias("v")), spark.range(1).select(F.lit(1).alias("k"), "id", F.lit("y").alias("v"))
    merged = lambda **o: [tuple(r) for r in W.merge_records([("a", a), ("b", b)], "k", ["v"], "id", **o).collect()]
    assert merged() == [(1, "a;a;a;b", "x")] and merged(counted=True) == [(1, "a*3;b*1", "x")]


def test_texts_are_parsed_once_where_they_are_few(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 50 > 0, F.concat((F.col("id") % 12 + 2010).cast("string"), F.lit(" Q1"))).alias("label"))
    plain = rows.withColumn("day", PR.parse_period(F.col("label")))
    once = PR.parsed_once(rows, "label", "day")
    assert "Join" in once._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, once.collect())) == sorted(map(str, plain.collect()))
    many = PR.parsed_once(rows.withColumn("label", F.col("id").cast("string")), "label", "day")
    assert "Join" not in many._jdf.queryExecution().optimizedPlan().toString()
    assert PR.parsed_once(rows.filter("id < 0"), "label", "day").count() == 0


def test_a_column_that_is_there_is_replaced_by_what_is_parsed(spark):
    rows = spark.range(5000).select("id", F.lit("old").alias("Day"), F.concat((F.col("id") % 12 + 2010).cast("string"), F.lit(" Q1")).alias("label"))
    for out in ("day", "label"):
        once, plain = PR.parsed_once(rows, "label", out), rows.withColumn(out, PR.parse_period(F.col("label")))
        assert "Join" in once._jdf.queryExecution().optimizedPlan().toString()
        assert once.columns == plain.columns and once.dtypes == plain.dtypes
        assert sorted(map(str, once.collect())) == sorted(map(str, plain.collect()))


def test_ratio_sums_on_a_bound_do_not_depend_on_the_order_of_edges(spark):
    # added up in the first order these are less than 0.98 as doubles, in the second they are not
    for ratios in [(0.31, 0.11, 0.26, 0.18, 0.12), (0.31, 0.18, 0.11, 0.26, 0.12)]:
        edges = spark.createDataFrame([("a", x) for x in ratios], "code string, ratio double").coalesce(1)
        assert not B.ratio_sum_check(edges, "code", "ratio").first()["outside_tolerance"]
    edges = spark.createDataFrame([("a", 0.97999), ("b", 1.02001), ("c", 1.02), ("d", None)], "code string, ratio double")
    assert rows(B.ratio_sum_check(edges, "code", "ratio").select("code", "outside_tolerance"), "code") == [
        ("a", True), ("b", True), ("c", False), ("d", None),
    ]


def _sheets(spark, path, n):
    """Sheets of a short row each in one small file, unfolded to cells after it is read."""
    spark.range(n).coalesce(1).select(F.col("id").cast("string").alias("sheet")).write.parquet(path)
    cell = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("col_idx")
    words = F.array(*[F.lit(w) for w in ("Area code", "Name", "Count", "Rate")])
    return spark.read.parquet(path).select(
        F.lit("f").alias("file"), "sheet", F.lit(0).alias("row_idx"), cell).withColumn("value", F.element_at(words, F.col("col_idx") + 1))


def test_cells_are_measured_before_they_are_broadcast(spark, tmp_path):
    grid = _sheets(spark, f"{tmp_path}/sheets", 50)
    plan = combine_headers(grid, detect_header_row(grid))._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan


def test_headers_go_to_the_right_in_every_row_of_the_window(spark):
    given = [(0, 0, "Title"), (1, 0, "Top"), (1, 2, "Other"), (2, 0, "Area"), (2, 1, "Area"), (2, 2, None), (2, 3, "Rate"), (3, 4, "data"), (2, None, "x")]
    grid = spark.createDataFrame([("f", "s", *c) for c in given], "file string, sheet string, row_idx int, col_idx int, value string")
    last = spark.createDataFrame([("f", "s", 2), ("f", "other", 0)], "file string, sheet string, header_row int")
    got = lambda window: rows(combine_headers(grid, last, window).select("col_idx", "header"), "col_idx")
    assert got(2) == [(0, "Top | Area"), (1, "Top | Area"), (2, "Other | Area"), (3, "Other | Rate"), (4, "Other | Rate")]
    assert got(5)[4] == (4, "Title | Other | Rate") and got(1)[0] == (0, "Area")


def test_header_scores_are_hash_aggregates(spark, tmp_path):
    plan = detect_header_row(_sheets(spark, f"{tmp_path}/sheets", 50))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    given = [("f", "s", r, c, v) for r, c, v in [(5, 0, "w70"), (5, 1, "w1"), (7, 0, "w70 w1"), (7, 1, "x"), (9, 0, "w70"), (9, 1, "z"), (9, 2, "y")]]
    grid = spark.createDataFrame(given, "file string, sheet string, row_idx int, col_idx int, value string")
    assert [tuple(r) for r in detect_header_row(grid, [f"w{i}" for i in (1, *range(10, 80))]).collect()] == [("f", "s", 5, 12)]


def test_short_rows_are_dealt_before_they_are_unfolded(spark, tmp_path):
    from arealoom.checks import registry

    parts = spark.range(25_000).select(F.col("id").alias("p_partkey"), *[F.lit("x").alias(c) for c in ("p_name", "p_brand", "p_type")])
    parts.withColumns({"p_size": F.lit(1), "p_retailprice": F.lit(1.5)}).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert registry.cells(spark, str(tmp_path)).rdd.getNumPartitions() == 3


def test_pages_are_dealt_before_they_are_made(spark, tmp_path):
    from arealoom.checks import sources

    parts = spark.range(25_000).select(F.col("id").alias("p_partkey"), F.lit("x").alias("p_name"), F.lit("x").alias("p_type"))
    parts.withColumns({"p_size": F.lit(1), "p_retailprice": F.lit(1.5)}).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    pages = sources._measure_pages(spark, str(tmp_path))
    assert pages.rdd.getNumPartitions() == 5 and pages.select("p_partkey").distinct().count() == 25_000
