from pyspark.sql import functions as F

import pytest

from reptally.operators import tables as tb
from reptally.sources import output, wide

from sorted_rows import rows

TABLE = "\r\n".join(
    [
        "seq_number\tA.1\tB.1\tA.1\tsum.taxonomy",
        "merged_r1_1\t5\t0\t7\tx;y;;z",
        "forward_r1_2\t1\tNA\t0\t;;a",
        "unmerged_r1_3\t0\t2\t3\tx;y;;z",
    ]
)
SHEET = "\r\n".join(
    [
        "Seq_number\tNew_name\tSite\tBio_rep\tTech_rep\tSample_Control\tControl_Type",
        "A.1\ts1\tS\tA\t1\tSample\tNA",
        "B.1\tp1\tNA\tNA\tNA\tControl\tPos",
        "A.1\ts2\tS\tB\t1\tSample\tNA",
    ]
)


@pytest.fixture
def files(tmp_path):
    table, sheet = tmp_path / "table.txt", tmp_path / "sheet.txt"
    table.write_bytes(TABLE.encode())
    sheet.write_bytes(SHEET.encode())
    return str(table), str(sheet)


def test_repeated_headers_crlf_and_dots(spark, files):
    got = wide.read_wide(spark, files[0])
    assert got.columns == ["feature", "A.1", "B.1", "A.1#2", "taxon"]
    assert got.filter("feature = 'merged_r1_1'").first()["taxon"] == "x;y;;z"


def test_nth_header_meets_nth_sheet_row(spark, files):
    sheet = wide.read_sheet(spark, files[1])
    assert rows(sheet, "raw_name", "sample") == [("A.1", "s1"), ("A.1#2", "s2"), ("B.1", "p1")]
    long = wide.rename_samples(wide.to_long(wide.read_wide(spark, files[0])), sheet)
    assert rows(long.filter("reads > 0"), "sample", "feature", "reads") == [
        ("p1", "unmerged_r1_3", 2),
        ("s1", "forward_r1_2", 1),
        ("s1", "merged_r1_1", 5),
        ("s2", "merged_r1_1", 7),
        ("s2", "unmerged_r1_3", 3),
    ]
    assert long.count() == 9 and long.filter("reads is null").count() == 0


def test_sheet_missing_values(spark, files):
    sheet = wide.read_sheet(spark, files[1])
    assert sheet.filter("control_type is null").count() == 2
    assert sheet.filter("site is null").select("sample").first()[0] == "p1"


def test_unmapped_name_stays(spark, long):
    sheet = spark.createDataFrame([("raw", "new")], "raw_name string, sample string")
    got = wide.rename_samples(long(("r", "raw", "f", "t", 1), ("r", "other", "f", "t", 2)), sheet)
    assert rows(got, "sample", "reads") == [("new", 1), ("other", 2)]


def test_run_label_drops_read_type_and_number(spark):
    ids = spark.createDataFrame([("merged_c19_fish_12",), ("unmerged_x_1",)], "feature string")
    assert rows(wide.run_label(ids), "run") == [("c19_fish",), ("x",)]


def test_sheet_dedupe(spark):
    sheet = spark.createDataFrame([("a", "s", "S"), ("b", "s", "S")], "raw_name string, sample string, site string")
    assert rows(wide.sheet_dedupe(sheet)) == [("s", "S")]


def test_taxon_ids_are_dense_and_one_per_taxon(spark):
    key = spark.range(5000).select(
        F.concat(F.lit("f"), "id").alias("feature"), F.concat(F.lit("t"), F.col("id") % 1200).alias("taxon")
    )
    dim = wide.taxon_dim(wide.taxon_key(key, key))
    numbers = sorted(int(r[0].split("_")[1]) for r in dim.select("taxon_id").collect())
    assert numbers == list(range(1, 1201))
    assert dim.filter("taxon = 't7'").first()["first_feature"] == "f1207"


def test_union_fills_missing_counts(spark):
    a = spark.createDataFrame([("f", 1)], "feature string, x bigint")
    b = spark.createDataFrame([("g", 2)], "feature string, y bigint")
    assert rows(wide.union_runs(a, b), "feature", "x", "y") == [("f", 1, 0), ("g", 0, 2)]


def test_long_wide_long(spark, long):
    start = long(("r", "a.1", "f", "t", 3), ("r", "b", "f", "t", 1), ("r", "b", "g", "u", 2))
    table = tb.count_matrix(start)
    assert table.columns == ["feature", "taxon", "a.1", "b"]
    back = wide.to_long(table).filter("reads > 0")
    assert rows(back, "feature", "taxon", "sample", "reads") == rows(start, "feature", "taxon", "sample", "reads")


def test_too_many_columns(spark, long):
    start = long(("r", "a", "f", "t", 3), ("r", "b", "f", "t", 1))
    spark.conf.set("spark.sql.pivotMaxValues", "1")
    try:
        with pytest.raises(output.TooWide):
            tb.count_matrix(start)
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_written_tables_come_back(spark, long, tmp_path):
    start = long(("r", "a", "f", "t", 3), ("q", "b", "f", "t", 1))
    back = output.write_table(start, str(tmp_path / "t"))
    assert back.columns == start.columns and rows(back) == rows(start)
    path = output.write_csv(start, str(tmp_path / "c"), ["reads"])
    assert rows(spark.read.csv(path, header=True, schema=start.schema)) == rows(start)


def test_many_tables_with_columns_of_their_own_in_one_scan(spark, tmp_path):
    want, paths = [], []
    for t in range(100):
        names = [f"s{t}.{k}" for k in range(t % 4 + 1)] + ["same", "same"]
        head, at = list(names), t % 3
        head.insert(at, wide.FEATURE_HEADER)
        head.append(wide.TAXON_HEADER)
        lines = ["\t".join(f'"{h}"' if t % 2 else h for h in head)]
        for r in range(3):
            counts = [str((t + r * k) % 3) if k else "NA" for k in range(len(names))]
            taxon = "NA" if r == 2 else f"t{r}; a b"
            cells = list(counts)
            cells.insert(at, f"merged_x{t}_{r}")
            lines.append("\t".join([*cells, taxon]))
            for k, (name, c) in enumerate(zip(names, counts)):
                label = f"{name}#2" if name == "same" and k == len(names) - 1 else name
                want.append((f"merged_x{t}_{r}", None if r == 2 else taxon, label, 0 if c == "NA" else int(c)))
        path = tmp_path / f"table{t}.txt"
        path.write_text(("\r\n" if t % 5 else "\n").join(lines))
        paths.append(str(path))
    key = lambda r: (r[0], r[2])
    whole = wide.read_long(spark, paths, zeros=True)
    assert sorted(map(tuple, whole.collect()), key=key) == sorted(want, key=key)
    assert sorted(map(tuple, wide.read_long(spark, paths).collect()), key=key) == sorted((w for w in want if w[3]), key=key)
    # one scan of the text, whatever the number of tables
    assert whole._jdf.queryExecution().optimizedPlan().toString().count("text") <= 2


def test_a_table_without_its_columns_is_an_error(spark, tmp_path):
    (tmp_path / "good.txt").write_text("seq_number\ta\tsum.taxonomy\nf\t1\tt\n")
    (tmp_path / "bad.txt").write_text("name\ta\nf\t1\n")
    with pytest.raises(Exception, match="needs the columns"):
        wide.read_long(spark, [str(tmp_path / "good.txt"), str(tmp_path / "bad.txt")]).collect()


def test_taxon_ids_stay_over_loads(spark):
    make = lambda *pairs: spark.createDataFrame(list(pairs), "feature string, taxon string")
    first = wide.taxon_dim(make(("f", "a"), ("g", "b"), ("h", None), ("i", None)))
    assert sorted(r["taxon_id"] for r in first.collect()) == ["taxon_1", "taxon_2", "taxon_3"]
    assert rows(first.filter("taxon is null"), "taxon_id", "first_feature") == [("taxon_1", "h")]
    second = wide.taxon_dim(make(("a0", "a"), ("c0", "c"), ("d0", "d"), ("e0", None)), first)
    assert set(rows(first.fillna({"taxon": "-"}))) < set(rows(second.fillna({"taxon": "-"})))
    assert sorted(int(r["taxon_id"][6:]) for r in second.collect()) == [1, 2, 3, 4, 5]
    # the missing taxon may come later, and an empty first load changes nothing
    late = wide.taxon_dim(make(("x", None)), wide.taxon_dim(make(("f", "a"))))
    assert rows(late.filter("taxon is null"), "taxon_id") == [("taxon_2",)]
    assert rows(wide.taxon_dim(make(("f", "a")), first.limit(0))) == [("a", "taxon_1", "f")]


def test_taxon_ids_by_shuffle(spark, no_broadcast):
    make = lambda n: spark.range(n).select(F.col("id").cast("string").alias("feature"), F.when(F.col("id") > 0, F.concat(F.lit("t"), "id")).alias("taxon"))
    first = wide.taxon_dim(make(300))
    second = wide.taxon_dim(make(500), first)
    assert sorted(int(r["taxon_id"][6:]) for r in second.collect()) == list(range(1, 501))


def cells_of(table, index, column):
    """Every cell of a wide table with columns, as rows."""
    return table.unpivot(index, None, column, "reads").select(*index, column, "reads").collect()


@pytest.mark.parametrize("per_block", [output.NAMES_PER_BLOCK, 2, 1])
def test_cells_are_those_of_the_wide_table(spark, long, monkeypatch, per_block):
    monkeypatch.setattr(output, "NAMES_PER_BLOCK", per_block)
    monkeypatch.setattr(output, "CELLS_PER_TASK", 4)
    start = long(
        ("r", "b", "f", "t", 3), ("r", "a", "f", "t", 1), ("q", "a", "f", "t", 1), ("r", "e", "g", None, 2), ("r", "c", "h", "t", None),
        ("r", None, "f", "t", 5), ("r", None, "only", "u", 5), *[("r", s, "all", "v", 4) for s in "abcde"],
    )
    key = lambda r: tuple(map(str, r))
    want = cells_of(tb.count_matrix(start), ["feature", "taxon"], "sample")
    got = tb.count_matrix(start, cells=True).select("feature", "taxon", "sample", "reads").collect()
    assert sorted(got, key=key) == sorted(want, key=key) and len(got) == 25
    sheet = spark.createDataFrame([("a", "Sample"), ("x", "Sample"), ("x", "Sample"), (None, None), ("p", "Control")], "sample string, sample_control string")
    want = cells_of(tb.align_samples(start, sheet), ["taxon"], "sample")
    assert sorted(tb.align_samples(start, sheet, cells=True).select("taxon", "sample", "reads").collect(), key=key) == sorted(want, key=key)
    assert tb.count_matrix(start.limit(0), cells=True).count() == 0


def test_cells_of_more_columns_than_a_pivot_may_have(spark, long):
    limit = int(spark.conf.get("spark.sql.pivotMaxValues"))
    many = spark.range(limit + 2000).selectExpr("'r' run", "concat('s', id) sample", "concat('f', id % 2) feature", "'t' taxon", "id + 1 reads")
    got = tb.count_matrix(many, cells=True)
    assert got.count() == 2 * (limit + 2000) == got.dropDuplicates(["feature", "sample"]).count()
    assert rows(got.filter("reads > 0"), "feature", "taxon", "sample", "reads") == rows(many, "feature", "taxon", "sample", "reads")
    assert tb.align_samples(many, spark.createDataFrame([("x", "S")], "sample string, sample_control string"), cells=True).count() == limit + 2001


def test_text_tables_of_any_width_are_written_and_read(spark, long, tmp_path, monkeypatch):
    monkeypatch.setattr(output, "CELLS_PER_FILE", 9000)
    limit = int(spark.conf.get("spark.sql.pivotMaxValues"))
    many = spark.range(limit + 1).selectExpr("concat('s', id) sample", "concat('merged_r_', id % 5) feature", "'t; a b' taxon", "id + 1 reads")
    many = many.unionByName(long(("r", None, "merged_r_9", "", 4)).drop("run"))
    path = output.write_wide(many, ["feature", "taxon"], "sample", "reads", str(tmp_path / "wide"), [wide.FEATURE_HEADER, wide.TAXON_HEADER])
    assert len(list((tmp_path / "wide").glob("part-*"))) > 3
    assert rows(wide.read_long(spark, [path]), "sample", "feature", "taxon", "reads") == rows(many.filter("sample is not null"), "sample", "feature", "taxon", "reads")
    whole = wide.read_long(spark, [path], zeros=True)
    assert whole.count() == 6 * (limit + 1) and whole.filter("feature = 'merged_r_9' and reads = 0 and taxon = ''").count() == limit + 1
    empty = output.write_wide(many.limit(0), ["feature", "taxon"], "sample", "reads", str(tmp_path / "none"), [wide.FEATURE_HEADER, wide.TAXON_HEADER])
    assert wide.read_long(spark, [empty], zeros=True).count() == 0
