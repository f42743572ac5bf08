"""Published versions: switched at once, pruned by date, refreshed by day, and dropped on request."""

from datetime import date, timedelta
from pathlib import Path

import pytest

from spendweave.operators.selection import Selection
from spendweave.plans import pipeline
from spendweave.sources import files, versions
from spendweave.sources.specs import UNIFIED_COLUMNS
from tests import ads
from tests.test_plans import plan_of


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def state(tables):
    return {name: rows(df) for name, df in tables.items()}


@pytest.fixture(scope="module")
def feeds(spark):
    """Rows of some four months."""
    return ads.random_feeds(seed=5, rows=150)


def moved(feed, days):
    """The same rows, spread over more months."""
    return [(row[0] + timedelta(days=days * (k % 5)), *row[1:]) for k, row in enumerate(feed)]


@pytest.fixture
def raw(spark, feeds):
    return ads.frames(spark, *[moved(f, 31) for f in feeds])


def tree(folder):
    return {str(p.relative_to(folder)) for p in Path(folder).rglob("*.parquet")}


def test_a_failed_run_leaves_the_old_version(spark, raw, tmp_path, monkeypatch):
    folder = str(tmp_path / "out")
    before = state(pipeline.publish_marts(*raw, folder))
    held = versions.Draft.write

    def failing(self, name, *args, **options):
        if name == "platform_summary":
            raise RuntimeError("lost in the middle")
        return held(self, name, *args, **options)

    monkeypatch.setattr(versions.Draft, "write", failing)
    with pytest.raises(RuntimeError, match="lost in the middle"):
        pipeline.publish_marts(raw[0].limit(3), raw[1], raw[2], folder)
    monkeypatch.undo()
    assert versions.numbers(spark, folder) == [1]
    assert state(pipeline.read_marts(spark, folder)) == before


def test_versions_stand_side_by_side_until_they_are_dropped(spark, raw, tmp_path):
    folder = str(tmp_path / "out")
    first = pipeline.publish_marts(*raw, folder)
    before = state(first)
    second = state(pipeline.publish_marts(raw[0].limit(5), *raw[1:], folder))
    assert before != second and versions.numbers(spark, folder) == [1, 2]
    assert state(first) == before == state(pipeline.read_marts(spark, folder, 1))
    assert state(pipeline.read_marts(spark, folder)) == second
    assert versions.drop_versions(spark, folder) == [1]
    assert versions.numbers(spark, folder) == [2] and state(pipeline.read_marts(spark, folder)) == second
    with pytest.raises(Exception):
        pipeline.read_marts(spark, folder, 1)["unified_ads"].collect()
    assert versions.drop_versions(spark, folder) == []
    with pytest.raises(ValueError):
        versions.drop_versions(spark, folder, 0)


def test_of_two_runs_on_one_base_one_wins(spark, tmp_path):
    folder = str(tmp_path / "out")
    drafts = [versions.draft(spark, folder) for _ in range(2)]
    for k, draft in enumerate(drafts):
        draft.write("numbers", spark.range(k + 1))
    drafts[1].commit()
    with pytest.raises(RuntimeError, match="another run"):
        drafts[0].commit()
    assert versions.version(spark, folder).read("numbers").count() == 2
    assert [n for n in files.names(spark, f"{folder}/versions") if not n.endswith(".crc")] == ["0000000001.json"]


def test_nothing_published(spark, raw, tmp_path):
    with pytest.raises(FileNotFoundError):
        pipeline.read_marts(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        pipeline.refresh_marts(*raw, str(tmp_path), [date(2024, 1, 1)])


@pytest.fixture
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "9999")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_a_date_range_reads_its_months_only(spark, raw, tmp_path, whole_plans):
    folder = str(tmp_path / "out")
    tables = pipeline.publish_marts(*raw, folder)
    sel = Selection(dates=(date(2024, 2, 10), date(2024, 3, 5)), platforms=["Google", "TikTok"])
    some = pipeline.read_facts(spark, folder, sel)
    assert some.columns == UNIFIED_COLUMNS == tables["unified_ads"].columns
    assert rows(some) == [r for r in rows(tables["unified_ads"]) if sel.dates[0] <= r[1] <= sel.dates[1] and r[0] in sel.platforms]
    filters = next(line for line in plan_of(some).splitlines() if "PartitionFilters" in line)
    partitions, pushed = filters.split("PushedFilters")
    assert "month" in partitions and "GreaterThanOrEqual(date,2024-02-10)" in pushed and "In(platform" in pushed

    def read(df):
        run = df._jdf.queryExecution()
        run.toRdd().count()
        return run.executedPlan().collectLeaves().apply(0).metrics().apply("numFiles").value()

    # two months of five or more
    assert 0 < read(some) < read(pipeline.read_facts(spark, folder, Selection())) / 2


def test_files_are_sorted_by_date(spark, raw, tmp_path):
    pipeline.publish_marts(*raw, str(tmp_path / "out"))
    import pyarrow.parquet as pq

    for file in (tmp_path / "out" / "unified_ads").rglob("*.parquet"):
        found = pq.read_table(file, columns=["platform", "date"], partitioning=None).to_pylist()
        order = [(r["platform"], r["date"]) for r in found]
        assert order == sorted(order) and {d.replace(day=1).isoformat() for _, d in order} == {file.parent.name.removeprefix("month=")}


def test_refresh_of_some_days_equals_a_full_publish(spark, feeds, tmp_path):
    spread = [moved(f, 31) for f in feeds]
    days = sorted({r[0] for f in spread for r in f})
    replaced = [days[3], days[4], date(2031, 5, 5)]  # one in an early month, and one without rows

    def changed(feed):
        kept = [r for r in feed if r[0] not in replaced]
        new = [(replaced[0], "c_new", "N_new", *r[3:]) for r in feed[:4]]  # the other day loses all its rows
        return kept + new

    after = [changed(f) for f in spread]
    folder = str(tmp_path / "out")
    pipeline.publish_marts(*ads.frames(spark, *spread), folder)
    files_before = tree(tmp_path / "out" / "unified_ads")
    refreshed = pipeline.refresh_marts(*ads.frames(spark, *after), folder, replaced)
    full = pipeline.publish_marts(*ads.frames(spark, *after), str(tmp_path / "full"))
    assert state(refreshed) == state(full)
    # untouched months are still read from the files of the first run
    months = {d.replace(day=1).isoformat() for d in replaced}
    used = {p for p in versions.version(spark, folder).tables["unified_ads"].parts}
    untouched = {str(Path(p).parent) for p in files_before if not any(f"month={m}" in p for m in months)}
    assert untouched and untouched <= used and files_before <= tree(tmp_path / "out" / "unified_ads")
    # and survive when the first version goes, unlike the files that were replaced
    versions.drop_versions(spark, folder)
    assert state(pipeline.read_marts(spark, folder)) == state(full)
    assert {str(Path(p).parent) for p in tree(tmp_path / "out" / "unified_ads")} == used


def test_refresh_without_days_changes_nothing(spark, raw, tmp_path):
    folder = str(tmp_path / "out")
    before = state(pipeline.publish_marts(*raw, folder))
    assert state(pipeline.refresh_marts(*raw, folder, [])) == before and versions.numbers(spark, folder) == [1]


def test_empty_feeds_and_missing_dates(spark, tmp_path):
    none = ads.frames(spark)
    assert not any(state(pipeline.publish_marts(*none, str(tmp_path / "none"))).values())
    undated = [(None, *ads.facebook_row()[1:]), ads.facebook_row()]
    tables = pipeline.publish_marts(*ads.frames(spark, undated), str(tmp_path / "undated"))
    assert tables["unified_ads"].count() == 2 and tables["daily_platform_summary"].count() == 2
    again = pipeline.refresh_marts(*ads.frames(spark, undated), str(tmp_path / "undated"), [ads.DAY])
    assert state(again) == state(tables)


def test_the_dashboard_reads_no_facts(spark, raw, tmp_path):
    from spendweave.plans import navigation, panels

    tables = pipeline.publish_marts(*raw, str(tmp_path / "out"))
    names = sorted({r.campaign_name or "" for r in tables["unified_ads"].collect()})[1:3]
    dates = (date(2024, 1, 5), date(2024, 3, 9))
    choices = {
        "platform_summary": [Selection(), Selection(platforms=["Google"]), Selection(dates=(dates[0],))],
        "daily_platform_summary": [Selection(dates=dates), Selection(dates=dates, platforms=["TikTok", "Google"])],
        "campaign_performance": [Selection(campaigns=names), Selection(platforms=["Facebook"], campaigns=names)],
        "campaign_rollup": [Selection(dates=dates, campaigns=names)],
    }
    plain = dict(tables)
    for level, selections in choices.items():
        for sel in selections:
            assert navigation.level(sel) == level
            quick = panels.dashboard(tables["unified_ads"], tables, sel)
            slow = panels.dashboard(tables["unified_ads"], plain, sel)
            assert quick and list(quick) == list(slow)
            for name in ("kpi_cards", "spend_share", "conversions"):
                assert rows(quick[name]) == rows(slow[name]), (level, name)
                assert quick[name].dtypes == slow[name].dtypes
                assert any("/unified_ads/" in file for file in slow[name].inputFiles())
            assert not any("/unified_ads/" in file for df in quick.values() for file in df.inputFiles())
    assert panels.dashboard(tables["unified_ads"], tables, Selection(campaigns=["nobody"])) == {}


def test_counts_and_bounds_come_from_footers(spark, raw, tmp_path):
    from spendweave.plans import audit

    folder = str(tmp_path / "out")
    tables = pipeline.publish_marts(*raw, folder)
    counts = audit.stored_row_counts(spark, folder)
    assert {r.table_name: r.row_count for r in counts.collect()} == {n: df.count() for n, df in tables.items()}
    bounds = audit.stored_date_bounds(spark, folder)
    days = [r.date for r in tables["unified_ads"].collect()]
    assert tuple(bounds.first()) == (min(days), max(days))
    for df, pushed in ((counts, "PushedAggregation: [COUNT(*)]"), (bounds, "MIN(date), MAX(date)")):
        plan = plan_of(df)
        assert pushed in plan and "PushedAggregation: []" not in plan


def test_positions_without_one_task(spark):
    from pyspark.sql import functions as F

    from spendweave.operators import pick

    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).withColumn("v", (F.col("id") * 7919) % 5000)
        out = pick.numbered(df.orderBy("v"), "v")
        assert all(r.position == r.v + 1 for r in out.collect()) and out.count() == 5000
        assert out.dtypes == [("v", "bigint"), ("position", "bigint")]
        assert pick.numbered(df.limit(0).orderBy("v"), "v").collect() == []
        # the only window over all is over one row per partition
        text = out._jdf.queryExecution().optimizedPlan().toString()
        window = text.index("Window [")
        assert text.count("Window [") == 1 and "Aggregate [_part" in text[window:]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
