from datetime import date
from decimal import Decimal

import pytest

from spendweave.plans.audit import length_violations, row_counts
from spendweave.sources.specs import FACEBOOK, GOOGLE, TIKTOK
from spendweave.sources.badrows import BadRow, bad_cells, first_bad_cell
from spendweave.sources.store import drop_scratch, get_view, load_raw, materialise, publish, read_raw, scratch_folder

HEADER = ",".join(FACEBOOK.columns)
GOOD = "2024-01-01,fb_1,Brand,set_1,Set,100,10,5.50,2,50,0.0123,90,1.20"


def _write(folder, *lines, header=HEADER, name="feed.csv"):
    file = folder / name
    file.write_text("\n".join([header, *lines]) + "\n")
    return str(file)


def _read(spark, folder, *lines, header=HEADER):
    return read_raw(spark, _write(folder, *lines, header=header), FACEBOOK)


def test_types_and_values(spark, tmp_path):
    df = _read(spark, tmp_path, GOOD)
    assert df.schema == FACEBOOK.schema()
    assert tuple(df.first()) == (
        date(2024, 1, 1), "fb_1", "Brand", "set_1", "Set", 100, 10, Decimal("5.50"), 2, 50, Decimal("0.0123"), 90,
        Decimal("1.20"),
    )


def test_null_tokens_spaces_and_quotes(spark, tmp_path):
    line = '2024-01-01, fb_1 ,NULL,null,,NULL, 10 ," 5.50 ",null,,0.0123,90,1.20'
    row = _read(spark, tmp_path, line, GOOD.replace("Brand", '"a,b ""c"""'), GOOD.replace("Brand", '" x "')).collect()
    assert tuple(row[0])[1:10] == ("fb_1", None, None, None, None, 10, Decimal("5.50"), None, None)
    assert row[1].campaign_name == 'a,b "c"'
    assert row[2].campaign_name == "x"


def test_null_token_is_exact(spark, tmp_path):
    assert _read(spark, tmp_path, GOOD.replace("Brand", "Null")).first().campaign_name == "Null"


def test_whole_number_with_decimals(spark, tmp_path):
    rows = _read(spark, tmp_path, GOOD.replace(",100,", ",100.0,"), GOOD.replace(",100,", ",12.5,")).collect()
    assert [r.impressions for r in rows] == [100, 13]


@pytest.mark.parametrize(
    "line",
    [
        GOOD.replace(",100,", ",abc,"),
        GOOD.replace("2024-01-01", "someday"),
        GOOD.rsplit(",", 1)[0],
        GOOD + ",7",
        GOOD.replace("fb_1", "x" * 51),
        GOOD.replace("5.50", "12345678901.00"),
    ],
    ids=["not a number", "not a date", "short row", "long row", "long text", "too large"],
)
def test_bad_row_fails_the_load(spark, tmp_path, line):
    source = _write(tmp_path, GOOD, line)
    with pytest.raises(Exception):
        load_raw(spark, source, str(tmp_path / "table"), FACEBOOK)


def _bad_lines(tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    good = [GOOD.replace("fb_1", f"fb_{k}") for k in range(3000)]
    wrong = {
        ("a.csv", 1205): (GOOD.replace(",100,", ", none ,"), "impressions", "none", "not a bigint"),
        ("a.csv", 2900): (GOOD.rsplit(",", 3)[0], "", GOOD.rsplit(",", 3)[0], "not 13 cells"),
        ("b.csv", 7): (GOOD.replace("2024-01-01", "2024-13-01"), "date", "2024-13-01", "not a date"),
        ("b.csv", 3000): (GOOD.replace("fb_1", "x" * 51), "campaign_id", "x" * 51, "longer than 50"),
    }
    for name in ("a.csv", "b.csv", "c.csv"):
        lines = [HEADER, *good]
        lines.insert(40, "")  # blank lines count as lines and are no rows
        for (file, line), (text, *_) in wrong.items():
            if file == name:
                lines[line - 1] = text
        (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder), [(file, line, *told) for (file, line), (_, *told) in wrong.items()]


@pytest.mark.parametrize("block", ["128m", "20k"])
def test_bad_cells_are_told_by_file_line_and_cell(spark, tmp_path, block):
    source, want = _bad_lines(tmp_path)
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    try:
        for k in keys:
            spark.conf.set(k, block)
        found = bad_cells(spark, source, FACEBOOK).collect()
        assert sorted((r.file.rsplit("/", 1)[1], r.line, r.column, r.cell.strip(), r.problem) for r in found) == want
        with pytest.raises(BadRow) as stopped:
            load_raw(spark, source, str(tmp_path / "table"), FACEBOOK)
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
    bad = stopped.value
    assert (bad.file.rsplit("/", 1)[1], bad.line, bad.column, bad.cell.strip(), bad.problem) == want[0]
    assert "a.csv, line 1205, impressions" in str(bad)


def test_a_good_feed_has_no_bad_cells(spark, tmp_path):
    source = _write(tmp_path, GOOD, GOOD.replace("100", " NULL "))
    assert first_bad_cell(spark, source, FACEBOOK) is None and bad_cells(spark, source, FACEBOOK).isEmpty()


def test_bad_cells_parse_a_line_once(spark, tmp_path):
    found = bad_cells(spark, _write(tmp_path, GOOD), FACEBOOK)
    for read in (found, found.drop("line"), found.select("file").distinct(), found.where("line > 1 AND column = 'date'")):
        assert read._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 1


def test_every_bad_cell_of_a_line_is_told(spark, tmp_path):
    wrong = "soon," + "x" * 51 + ",null,\"\",NULL,12.5, none ,5.555,1e30,,abc,+7,NULL"
    source = _write(tmp_path, GOOD, HEADER, wrong, "null" + ",NULL" * 12)
    told = [(r.line, r.column, r.cell, r.problem) for r in bad_cells(spark, source, FACEBOOK).collect()]
    assert told == [
        (4, "date", "soon", "not a date"), (4, "campaign_id", "x" * 51, "longer than 50"), (4, "clicks", "none", "not a bigint"),
        (4, "conversions", "1e30", "not a bigint"), (4, "engagement_rate", "abc", "not a decimal(10,4)"),
    ]
    first = first_bad_cell(spark, source, FACEBOOK)
    assert (first.line, first.column, first.cell, first.problem) == told[0]


def test_one_task_reads_each_file_with_line_breaks(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(6):
        _write(folder, *[GOOD.replace("Brand", '"two\nlines"')] * 2000, name=f"{k}.csv")
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    try:
        for k in keys:
            spark.conf.set(k, "20k")  # a tenth of a file
        whole = read_raw(spark, str(folder), FACEBOOK, multi_line=True)
        assert whole.rdd.getNumPartitions() == 6 and whole.count() == 12_000
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)


def test_short_row_fails_even_if_few_columns_are_read(spark, tmp_path):
    with pytest.raises(Exception):
        _read(spark, tmp_path, GOOD, GOOD.rsplit(",", 3)[0]).select("campaign_id").collect()


@pytest.mark.parametrize("header", [HEADER.replace("clicks", "klicks"), HEADER + ",extra", HEADER.replace(",reach", "")])
def test_wrong_header_fails(spark, tmp_path, header):
    with pytest.raises(Exception):
        _read(spark, tmp_path, GOOD, header=header).collect()


def test_load_twice_is_the_same_and_reads_many_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        _write(folder, GOOD, GOOD.replace("fb_1", f"fb_{i}"), name=f"{i}.csv")
    first = sorted(load_raw(spark, str(folder), str(tmp_path / "t"), FACEBOOK).collect())
    again = load_raw(spark, str(folder), str(tmp_path / "t"), FACEBOOK)
    assert sorted(again.collect()) == first and len(first) == 6
    assert row_counts({"a": again, "b": again.limit(0)}).collect() == [("a", 6), ("b", 0)]


def test_line_break_inside_quotes(spark, tmp_path):
    source = _write(tmp_path, GOOD.replace("Brand", '"two\nlines"'))
    assert read_raw(spark, source, FACEBOOK, multi_line=True).first().campaign_name == "two\nlines"
    with pytest.raises(Exception):
        read_raw(spark, source, FACEBOOK).collect()


def test_other_layouts_read_their_own_header(spark, tmp_path):
    g = "2024-01-01,g,N,a,A,100,10,5.50,2,80.00,0.1000,0.55,7,0.91"
    t = "2024-01-01,t,N,a,A,100,10,5.50,2,80,60,40,20,10,3,2,1"
    google = read_raw(spark, _write(tmp_path, g, header=",".join(GOOGLE.columns), name="g.csv"), GOOGLE)
    tiktok = read_raw(spark, _write(tmp_path, t, header=",".join(TIKTOK.columns), name="t.csv"), TIKTOK)
    assert (google.schema, google.first().quality_score) == (GOOGLE.schema(), 7)
    assert (tiktok.schema, tiktok.first().video_watch_100) == (TIKTOK.schema(), 10)


def test_published_table_is_partitioned_and_keeps_its_columns(spark, tmp_path):
    df = spark.createDataFrame([("Google", 1), ("TikTok", 2)], "platform string, n bigint")
    out = publish(df, str(tmp_path / "p"), ["platform"])
    assert out.columns == ["platform", "n"] and sorted(out.collect()) == [("Google", 1), ("TikTok", 2)]
    assert (tmp_path / "p" / "platform=Google").is_dir()
    publish(df.limit(0), str(tmp_path / "q"))


def test_view_read_lowers_names_and_casts_dates(spark):
    spark.sql("select '2024-01-05' as DATE, 1 as N").createOrReplaceTempView("upper_view")
    df = get_view(spark, "upper_view")
    assert df.dtypes == [("date", "date"), ("n", "int")]


def test_length_check_counts(spark):
    row = ("x" * 51,) + ("y",) * 3
    df = spark.createDataFrame([row, ("x",) * 4], "campaign_id string, campaign_name string, ad_set_id string, ad_set_name string")
    assert [tuple(r) for r in length_violations(df, FACEBOOK).collect()] == [
        ("campaign_id", 50, 1), ("campaign_name", 200, 0), ("ad_set_id", 50, 0), ("ad_set_name", 200, 0)
    ]


def test_scratch_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    folder = scratch_folder(spark)
    assert folder.startswith(configured or spark.sparkContext.getCheckpointDir())
    assert folder.endswith(spark.sparkContext.applicationId)


def test_scratch_tables_count_their_rows_and_can_be_dropped(spark, tmp_path):
    kept, rows = materialise(spark.range(1000).repartition(7), "numbers")
    assert rows == 1000 and kept.count() == 1000
    gone, _ = materialise(spark.range(5), "few")
    out = publish(kept, str(tmp_path / "kept"))
    drop_scratch(spark)
    assert out.count() == 1000
    with pytest.raises(Exception):
        gone.collect()
