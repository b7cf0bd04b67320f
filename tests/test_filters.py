import pytest

from reptally.operators import filters as fl
from reptally.operators import steplog as sl

from sorted_rows import rows

SHEET = "sample string, site string, bio_rep string, tech_rep string, sample_control string, control_type string"


@pytest.fixture
def sheet(spark):
    return spark.createDataFrame(
        [
            ("s1", "S", "A", "1", "Sample", None),
            ("p1", None, None, None, "Control", "Pos"),
            ("b1", None, None, None, "Control", "Blank"),
        ],
        SHEET,
    )


@pytest.fixture
def kinds(long):
    return long(*[("r", "s1", f"{k}_r_1", "t", 4) for k in ("merged", "unmerged", "forward", "reverse")])


def test_read_types(kinds):
    assert rows(fl.keep_read_type(kinds, "merged_only"), "feature") == [("merged_r_1",)]
    assert rows(fl.keep_read_type(kinds, "merged_and_forward"), "feature") == [("forward_r_1",), ("merged_r_1",)]
    assert fl.keep_read_type(kinds, "all").count() == 4
    with pytest.raises(ValueError):
        fl.keep_read_type(kinds, "merged")


def test_singletons_count_over_all_samples(long):
    start = long(("r", "a", "f", "t", 1), ("r", "a", "g", "t", 1), ("r", "b", "g", "t", 1), ("r", "a", "h", "t", 2))
    assert rows(fl.drop_singletons(start), "feature") == [("g",), ("g",), ("h",)]


def test_retention_counts_features(kinds):
    assert fl.retention_pct(kinds, fl.keep_merged(kinds)).first()["pct"] == 25.0


def test_sources(long, sheet):
    start = long(("r", "s1", "f", "t", 1), ("r", "p1", "f", "t", 1), ("r", "b1", "f", "t", 1), ("r", "zz", "f", "t", 1))
    got = fl.label_source(start, sheet)
    assert rows(got, "sample", "source") == [("b1", "Blanks"), ("p1", "Positives"), ("s1", "Samples"), ("zz", "Samples")]
    again = fl.label_source(fl.attach_sheet(start, sheet, (*fl.HIERARCHY, "control_type")))
    assert rows(again, "sample", "source") == rows(got, "sample", "source")
    assert rows(again.filter("sample = 'zz'"), "site", "bio_rep") == [("NA", "NA")]


def test_control_lists(sheet):
    lists = fl.control_lists(sheet)
    assert rows(lists["controls"]) == [("b1",), ("p1",)]
    assert rows(lists["positives"]) == [("p1",)] and rows(lists["blanks"]) == [("b1",)]


def test_control_features(long):
    start = long(
        ("r", "p1", "f", "t", 3, "Positives"), ("r", "p2", "f", "t", 4, "Positives"), ("r", "s", "g", "t", 9, "Samples"),
        extra=", source string",
    )
    assert rows(fl.control_features(start, fl.POSITIVES)) == [("f", "t", 7)]


def test_drop_zero(long):
    assert fl.drop_zero(long(("r", "a", "f", "t", 0), ("r", "a", "g", "t", 1))).count() == 1


def test_null_profile(sheet):
    got = {r["column"]: (r["missing"], r["present"]) for r in fl.null_profile(sheet).collect()}
    assert got["site"] == (2, 1) and got["sample"] == (0, 3)


def test_stage_log(long):
    start = long(("r", "a", "f", "t", 2), ("r", "b", "f", "t", 3), ("q", "a", "g", "t", 1))
    log = sl.stage_log(sl.stage_summary(start, sl.STAGES[0]), sl.stage_summary(start.filter("reads > 2"), sl.STAGES[1]))
    assert rows(log, "stage", "run", "stat", "number") == [
        ("Step_0", "q", "nHashes", 1), ("Step_0", "q", "nReads", 1), ("Step_0", "q", "nsamples", 1),
        ("Step_0", "r", "nHashes", 1), ("Step_0", "r", "nReads", 5), ("Step_0", "r", "nsamples", 2),
        ("Step_1.Jump", "r", "nHashes", 1), ("Step_1.Jump", "r", "nReads", 3), ("Step_1.Jump", "r", "nsamples", 1),
    ]
