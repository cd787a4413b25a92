"""Readers and writers on small files."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from arealoom.sources import files as FI
from arealoom.sources import pages as PG
from arealoom.sources import tables as T


def test_encodings(spark, tmp_path):
    texts = {"u8": ("name\nÅé\n", "utf-8"), "cp": ("name\n“é”\n", "cp1252"), "l1": ("name\né\x81\n", "latin-1")}
    for name, (text, encoding) in texts.items():
        (tmp_path / f"a {name}.csv").write_bytes(text.encode(encoding))
    paths = [str(tmp_path / f"a {n}.csv") for n in texts]
    found = {r.path[-6:-4]: r.encoding for r in T.file_encodings(spark, paths).collect()}
    assert found == {"u8": "UTF-8", "cp": "windows-1252", "l1": "ISO-8859-1"}
    got = {r.name for r in T.read_csv_any_encoding(spark, paths).collect()}
    assert got == {"Åé", "“é”", "é\x81"}


def test_read_table_prefers_parquet(spark, tmp_path):
    base = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        T.read_table(spark, base)
    (tmp_path / "t.csv").write_text("a\n007\n")
    assert T.read_table(spark, base).first().a == "007"
    spark.range(1).write.parquet(base + ".parquet")
    assert T.read_table(spark, base).columns == ["id"]


def test_broken_archive_is_reported(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("d/a.csv", "x\r\n1\r\n")
        z.writestr("b.xlsx", "..")
        z.writestr("c.pdf", "..")
    files = spark.createDataFrame([("ok.zip", buffer.getvalue()), ("bad.zip", b"zz")], "path string, content binary")
    members = FI.zip_members(files)
    status = {(r.path, r.member): r.member_status[:9] for r in members.collect()}
    assert status == {
        ("ok.zip", "d/a.csv"): "extracted", ("ok.zip", "b.xlsx"): "held", ("ok.zip", "c.pdf"): "not_tabul",
        ("bad.zip", ""): "failed: F",
    }
    assert [r.value for r in FI.member_lines(members).orderBy("line").collect()] == ["x", "1"]


def test_staging_reads_into_archives(spark, tmp_path):
    from arealoom.plans.staging import stage_native

    raw = tmp_path / "raw" / "profiles"
    raw.mkdir(parents=True)
    with zipfile.ZipFile(raw / "all.zip", "w") as z:
        z.writestr("2021/a.csv", "SA3 Code 2021,n\r\n10102,5\r\n10103,6\r\n")
        z.writestr("2022/a.csv", "SA3 Code 2021,n\r\n10102,7\r\n")
        z.writestr("notes.pdf", "..")
        z.writestr("sheet.xlsx", "..")
    (raw / "b 1+.csv").write_text("x,y\n,\n1,é\n")
    (raw / "c.pdf").write_text("..")
    (raw / "bad.zip").write_text("..")
    (raw / "book.xlsx").write_text("..")
    (raw / "empty.csv").write_text("x,y\n")
    (raw / "nine.csv").write_text("region,n\n" + "".join(f"1{i:08d},{i}.5\n" for i in range(9)))
    (raw / "five.csv").write_text("region,n\n" + "".join(f"1{i:04d},{i}.5\n" for i in range(9)))
    (raw / "cp.csv").write_bytes("name;n\nCafé – x;1\n\"a;b\nc\";2\n".encode("cp1252"))
    out = str(tmp_path / "native")
    for _ in range(2):
        audit = stage_native(spark, str(tmp_path / "raw"), out, [("profiles", "/profiles/")])
        got = sorted((r.path.split("/profiles/")[1], r.native_geography, r.status, r.rows) for r in audit.collect())
        assert got == [
            ("all.zip!2021/a.csv", "sa3", "staged", 2), ("all.zip!2022/a.csv", "sa3", "staged", 1),
            ("all.zip!notes.pdf", "", "held_member_not_tabular", 0), ("all.zip!sheet.xlsx", "", "held_member_not_decoded", 0),
            ("b%201+.csv", "unknown", "staged", 1), ("bad.zip", "", "held_unreadable_archive", 0), ("book.xlsx", "", "held_workbook", 0),
            ("c.pdf", "", "held_report_context", 0), ("cp.csv", "unknown", "staged", 2), ("empty.csv", "", "held_empty_table", 0),
            ("five.csv", "sa3", "staged", 9), ("nine.csv", "sa2", "staged", 9),
        ]
    staged = spark.read.option("mergeSchema", True).parquet(out)
    assert {r.source_family for r in staged.select("source_family").collect()} == {"profiles"}
    assert {r.name for r in staged.filter("name IS NOT NULL").select("name").collect()} == {"Café – x", "a;b\nc"}


def test_headings_reset_and_tables_nest(spark):
    html = (
        "<h1>Area</h1><h2>People</h2><h4>old</h4><h3>Age</h3>"
        "<table><tr><th>Label<th>Count<th>%<th>State</tr><tr><td>0-4<td>1,200<td>5.5<td>9</tr>"
        "<tr><td>More information on<td>3<td>4</tr></table>"
        "<h2>Homes</h2><table><tr><td>Rent</td><td>Weekly</td></tr><tr><td>Median &amp; mode</td><td>$350</td></tr></table>"
    )
    pages = spark.createDataFrame([(1, html), (2, None)], "k int, html string")
    got = [
        (r.variable_name, r.value, r.section, r.topic)
        for r in PG.html_tables_to_long(pages, "k", "html").orderBy("table_no", "row_no", "measure_type").collect()
    ]
    assert got == [
        ("census_qs_people_age_label_0_4_count", 1200.0, "People", "Age"),
        ("census_qs_people_age_label_0_4_pct", 5.5, "People", "Age"),
        ("census_qs_homes_rent_median_and_mode_count", 350.0, "Homes", ""),
    ]
    tokens = PG.tokens_of(pages, "k", "html")
    assert tokens.filter("tag = 'h2'").count() == 2


def test_inventory_skips_archives_and_opens_nothing(spark, tmp_path):
    for name in ("a/x.csv", "archive/y.csv", "a/z.pdf"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("1")
    listed = FI.file_inventory(spark, str(tmp_path), [".csv"])
    assert [r.file_name for r in listed.collect()] == ["x.csv"]
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()


def test_hash_of_files(spark, tmp_path):
    (tmp_path / "a").write_text("abc")
    (tmp_path / "b").write_text("abcdef")
    got = {r.size: r.sha256 for r in FI.content_hash_of(spark, str(tmp_path), max_size=4).collect()}
    assert got[3].startswith("ba7816bf") and got[6] is None


def test_large_files_are_no_hash_failures(spark, tmp_path):
    (tmp_path / "a").write_text("abc")
    (tmp_path / "b").write_text("abcdef")
    files = FI.content_hash_of(spark, str(tmp_path), max_size=4)
    assert {r.size: r.hash_status for r in files.collect()} == {3: "hashed", 6: "too_large"}
    files = files.withColumns({"file_extension": F.lit(""), "family": F.lit("x")})
    got = FI.freeze(files, files, "family").first()
    assert (got.hashed_files, got.hash_failures, got.too_large_files) == (1, 0, 1)
    assert got.freeze_status == "review_too_large_files"
    assert FI.freeze(files.drop("hash_status"), files, "family").first().freeze_status == "review_hash_failures"


def test_delimiters(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x;y\n1,5;2\n")
    (tmp_path / "b.txt").write_text("x\ty\n1\t2\n")
    got = {r.path[-5]: r.delimiter for r in T.detect_delimiter(spark, str(tmp_path)).collect()}
    assert got == {"a": ";", "b": "\t"}
    assert T.read_csv_sniffed(spark, [str(tmp_path / n) for n in ("a.txt", "b.txt")]).select(F.sum("y")).first()[0] == 4


def _write_quoted(path, rows, end="\r\n"):
    import csv

    with open(path, "w", newline="", encoding="utf-8") as file:
        csv.writer(file, lineterminator=end).writerows(rows)


def test_quoted_line_ends_are_read_by_several_tasks(spark, tmp_path):
    """Small splits, cells of many lines (some longer than a split), and every border case around them."""
    import random

    rng = random.Random(8)
    cell = ["plain", 'say "hi"', "two\nlines", "a\r\nb", "", ",", '"', "x\n" * 400, '"\n"']
    rows = [["id", "no te", "z"]] + [[f"{i:05d}", rng.choice(cell), rng.choice(cell)] for i in range(3000)]
    _write_quoted(tmp_path / "a.csv", rows)
    _write_quoted(tmp_path / "b.csv", [rows[0], *rows[5:900]], "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
        got = T.read_csv_text(spark, paths)
        assert got.columns == ["id", "no te", "z"]
        whole = T._csv(spark, paths, ",", "UTF-8", True)
        assert whole.rdd.getNumPartitions() == 2 and got.count() == 3895
        assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 10
        key = lambda r: tuple(x or "" for x in r)
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, whole.collect()), key=key)
        want = [[x.replace("\r\n", "\n") or None for x in r] for r in rows[1:]]
        assert sorted(map(list, T.read_csv_text(spark, paths[0]).collect()), key=key) == sorted(want, key=key)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_an_open_quote_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"never closed\n2,b\n')
    whole = [tuple(r) for r in T._csv(spark, str(tmp_path / "a.csv"), ",", "UTF-8", True).collect()]
    got = [tuple(r) for r in T.read_csv_text(spark, str(tmp_path / "a.csv")).collect()]
    assert [(a, b.rstrip()) for a, b in got] == [(a, b.rstrip()) for a, b in whole]
    (tmp_path / "b.csv").write_text("x,y\n")
    assert T.read_csv_text(spark, str(tmp_path / "b.csv"), multi_line=True).count() == 0


def test_only_changed_files_are_staged_again(spark, tmp_path):
    import os

    from arealoom.plans.staging import last_manifest, stage_changed, staged_rows

    raw, out = tmp_path / "raw", str(tmp_path / "native")
    raw.mkdir()
    for name, shift in (("a", 0), ("b", 100), ("c", 200)):
        (raw / f"{name}.csv").write_text("SA2 Code,n\n" + "".join(f"1{i:08d},{i + shift}\n" for i in range(5)))
    with zipfile.ZipFile(raw / "z.zip", "w") as z:
        z.writestr("m.csv", "SA3 Code,k\n10102,5\n")
    (raw / "d.pdf").write_text("..")

    def now():
        return sorted(((r.n or r.k), r.native_geography) for r in staged_rows(spark, out).collect())

    def audit_of(run):
        return sorted((os.path.basename(r.path), r.status, r.rows) for r in run.collect())

    first = audit_of(stage_changed(spark, str(raw), out, []))
    assert first == [("a.csv", "staged", 5), ("b.csv", "staged", 5), ("c.csv", "staged", 5), ("d.pdf", "held_report_context", 0), ("z.zip!m.csv", "staged", 1)]
    rows = now()
    assert len(rows) == 16 and rows.count(("5", "sa3")) == 1
    # same size and time: not opened, so other content does not show
    stat = os.stat(raw / "a.csv")
    (raw / "a.csv").write_text((raw / "a.csv").read_text().replace(",3", ",9"))
    os.utime(raw / "a.csv", ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert audit_of(stage_changed(spark, str(raw), out, [])) == first and now() == rows
    assert last_manifest(spark, out)[0] == 1
    # one file changes, one goes
    (raw / "b.csv").write_text("SA2 Code,n\n100000001,777\n")
    (raw / "c.csv").unlink()
    again = audit_of(stage_changed(spark, str(raw), out, []))
    assert again == [("a.csv", "staged", 5), ("b.csv", "staged", 1), ("d.pdf", "held_report_context", 0), ("z.zip!m.csv", "staged", 1)]
    assert now() == sorted([(str(i), "sa2") for i in range(5)] + [("777", "sa2"), ("5", "sa3")])
    assert last_manifest(spark, out)[0] == 2


def test_checked_and_published_in_one_job(spark, tmp_path):
    from arealoom.operators.audit import Check, ContractError
    from arealoom.sources.sinks import publish_checked

    df = spark.range(100).select("id", (F.col("id") % 7).alias("k"), F.lit(1.5).alias("v"))
    checks = [Check("rows", F.count("*"), lambda v: v == 100), Check("total", F.sum("v"))]

    def jobs(work):
        group = f"publish-{id(work)}"
        spark.sparkContext.setJobGroup(group, "")
        try:
            return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    audit, count = jobs(lambda: publish_checked(df, str(tmp_path / "out"), checks))
    assert count == 1
    assert [tuple(r)[:3] for r in audit.collect()] == [("rows", 100.0, "pass"), ("total", 150.0, "info")]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100
    with pytest.raises(ContractError, match="rows = 50"):
        publish_checked(df.filter("id < 50"), str(tmp_path / "bad"), checks)
    with pytest.raises(ContractError, match="repeated_keys = 93"):
        publish_checked(df, str(tmp_path / "bad"), [], ["k"])
    with pytest.raises(ContractError, match="null_keys = 1"):
        publish_checked(df.withColumn("id", F.expr("nullif(id, 5)")), str(tmp_path / "bad"), [], "id")
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    publish_checked(df, str(tmp_path / "good"), [], ["id"], ["k"])
    assert spark.read.parquet(str(tmp_path / "good")).columns == ["id", "v", "k"]
    with pytest.raises(FileExistsError):
        publish_checked(df, str(tmp_path / "good"), [])


def test_jobs_of_discovery_do_not_grow_with_the_tables(spark):
    from arealoom.plans.sources import extract_indicators

    keys = spark.range(50).select(F.col("id").cast("string").alias("code"))
    one = lambda i: spark.range(50).select("id", F.col("id").cast("string").alias("place"), (F.col("id") * i + 1000).alias("count"), F.lit("x").alias("note"))

    def jobs(n):
        group = f"discovery-{n}"
        spark.sparkContext.setJobGroup(group, "")
        wide, long = extract_indicators({f"t{i}": one(i) for i in range(n)}, {"area": keys}, "area", "id")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return wide, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    few, (wide, many) = jobs(2)[1], jobs(10)
    assert many <= few
    assert wide.columns == ["join_key", *[f"t{i}__count" for i in range(10)]] and wide.count() == 50


def test_items_of_a_json_list_are_read_by_several_tasks(spark, tmp_path):
    import json
    import random

    rng = random.Random(4)
    value = ["plain", 'q"uote', "br[ack]et}{", "back\\slash\\", "line\nend", "é", ""]
    rows = [{"id": i, "a": rng.choice(value), "deep": {"x": [[1, 2], [3]], "y": [{"z": rng.choice(value)}, {}]}} for i in range(2000)]
    texts = {
        "indented": json.dumps(rows, indent=2), "lines": "[\n" + ",\n".join(map(json.dumps, rows)) + "\n]\n", "flat": json.dumps(rows[:50]),
        "crlf": json.dumps(rows[:300], indent=1).replace("\n", "\r\n"), "shared": json.dumps(rows[:300], indent=1).replace("},\n {", "}, {"), "none": "[]",
        "object": json.dumps(rows[3], indent=3),
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text, newline="")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        for name in texts:
            path = str(tmp_path / f"{name}.json")
            whole, got = spark.read.option("multiLine", True).json(path), T.read_json_records(spark, path)
            assert got.schema == whole.schema, name
            assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect())), name
        from arealoom.sources.records import list_items

        items = list_items(spark, str(tmp_path / "indented.json"))
        assert items.count() == 2000 and items.select(F.spark_partition_id()).distinct().count() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_long_rows_are_worked_off_in_pieces_of_few_bytes(spark, tmp_path):
    import io
    import zipfile

    import pyarrow as pa

    from arealoom.sources import files, records

    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 1000] * 5000)], ["value"])
    cut = list(records.slices(iter([batch, batch.slice(0, 0), batch.slice(0, 1)]), 100_000))
    assert max(b.num_rows for b in cut) <= 100 and sum(b.num_rows for b in cut) == 5001

    def packed(size):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as archive:
            archive.writestr("a.csv", "y" * size)
        return buffer.getvalue()

    names = [f"{i}.zip" for i in range(6)]
    archives = pa.RecordBatch.from_arrays([pa.array(names), pa.array([packed(3 << 20)] * 6)], ["path", "content"])
    out = list(files._members(True)(iter([archives])))
    assert [b.num_rows for b in out] == [2, 2, 2, 0]
    assert [p for b in out for p in b.column("path").to_pylist()] == names
