"""Pages by position, and resuming without reading what lies behind."""

import pytest
from events import events

from commitpost.sources.outbox import resume_after
from commitpost.streaming.paged import PagedOutbox


def backlog(spark, sizes):
    rows = [{"id": f"{s}{n}", "source": s, "aggregate_id": f"k{n % 3}", "commit_lsn": n // 4 * 10 + 10, "row_seq": n} for s, size in sizes.items() for n in range(size)]
    return events(spark, rows)


class Pages:
    def __init__(self, fail_at=None):
        self.seen, self.fail_at = [], fail_at

    def __call__(self, rows, page):
        found = rows.select("source", "id").collect()
        self.seen.append((page, sorted(r["id"] for r in found)))
        if page == self.fail_at:
            self.fail_at = None
            raise RuntimeError("died")


def test_pages_are_bounded_and_hold_every_event_once(spark, tmp_path):
    """Transactions of four events are cut by pages of three."""
    pages = Pages()
    PagedOutbox(spark, backlog(spark, {"a": 7, "b": 2}), str(tmp_path), 3).run(pages)
    assert pages.seen == [(0, ["a0", "a1", "a2", "b0", "b1"]), (1, ["a3", "a4", "a5"]), (2, ["a6"])]


def test_a_restart_repeats_the_unfinished_page_and_goes_on(spark, tmp_path):
    rows, pages = backlog(spark, {"a": 7}), Pages(fail_at=1)
    with pytest.raises(RuntimeError):
        PagedOutbox(spark, rows, str(tmp_path), 3).run(pages)
    more = backlog(spark, {"a": 8, "c": 1})  # a larger table by the time of the restart
    PagedOutbox(spark, lambda: more, str(tmp_path), 3).run(pages)
    assert pages.seen == [(0, ["a0", "a1", "a2"]), (1, ["a3", "a4", "a5"]), (1, ["a3", "a4", "a5"]), (2, ["a6", "a7", "c0"])]


def test_pages_that_go_out_together_are_the_same_pages(spark, tmp_path):
    """Steps of 1 and 2 pages; the second dies and is repeated, and the steps start small again."""
    steps = []

    def take(rows, page):
        steps.append((page, sorted((r["page"], r["id"]) for r in rows.select("page", "id").collect())))
        if len(steps) == 2:
            raise RuntimeError("died")

    rows, store = backlog(spark, {"a": 20, "b": 4}), str(tmp_path)
    with pytest.raises(RuntimeError):
        PagedOutbox(spark, rows, store, 3, together=4).run(take)
    PagedOutbox(spark, rows, store, 3, together=4).run(take)
    assert [page for page, _ in steps] == [0, 1, 1, 3, 5] and steps[1] == steps[2]
    pages = sorted(sum((found for _, found in steps[:1] + steps[2:]), []))
    assert pages == sorted([(n // 3, f"a{n}") for n in range(20)] + [(n // 3, f"b{n}") for n in range(4)])


def test_resume_reads_only_what_lies_ahead(spark, tmp_path):
    rows = backlog(spark, {"a": 400, "b": 400})
    for low in range(0, 1000, 100):
        rows.where(f"commit_lsn > {low} and commit_lsn <= {low + 100}").coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    acks = spark.createDataFrame([("a", 900), ("b", 950)], "source string, acked bigint")
    read = spark.read.parquet(str(tmp_path / "log"))
    found = resume_after(read, acks)
    joined = resume_after(read, acks, literals=1)
    assert sorted(found.collect()) == sorted(joined.collect()) and found.count() == 40 + 20
    found.collect()
    leaf = found._jdf.queryExecution().executedPlan()
    plan = leaf.toString()
    assert "PushedFilters" in plan and "GreaterThan(commit_lsn,900)" in plan and "Join" not in plan


def test_sources_without_an_ack_start_at_the_beginning(spark):
    rows = backlog(spark, {"a": 8, "b": 4})
    acks = spark.createDataFrame([("a", 10), ("a", 5), (None, 7), ("z", 99)], "source string, acked bigint")
    for literals in (1000, 0):
        assert sorted(r["id"] for r in resume_after(rows, acks, literals).collect()) == ["a4", "a5", "a6", "a7", "b0", "b1", "b2", "b3"]
    assert resume_after(rows, acks.where("1 = 0")).count() == 12
