import gc
import weakref

import pytest

import __spark_entry__ as entry
from plazalake.plans import extract_queries
from plazalake.plans.registry import ORACLES, QUERIES
from plazalake.sources import pages as page_files
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, name):
    assert differences(spark, con, SF, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", ["b8_cards", "b8_cards_in_sql", "b2_find_postings", "b2_last_branch_first", "b3_paging_at_any_depth"])
def test_pages_are_walked_in_many_tasks(spark, name):
    """The parts are one row group of one file, so without dealing them out one task would walk all pages."""
    rows = QUERIES[name](spark, SF).rdd
    assert sum(rows.mapPartitions(lambda part: [any(True for _ in part)]).collect()) >= 8


def test_saved_pages_lie_in_folders_of_one_task(spark):
    """So a commit moves whole folders, and a listing takes a task for each of them and not for each page."""
    found = QUERIES["s4_saved_pages"](spark, SF)
    files = [f.split("/")[-3:] for f in found.inputFiles()]
    writers = {}
    for folder, page, name in files:
        assert folder.startswith("folder=") and page.startswith("page=")
        writers.setdefault(folder, set()).add(name.split("-")[1])
    assert len(files) == found.count() and all(len(w) == 1 for w in writers.values())


def test_saved_pages_go_in_portions(spark, con, monkeypatch):
    """The driver holds the path of each file that is listed, so no listing has all of them, and former ones are gone."""
    name, listed, held, read_pages = "s4_saved_pages", [], [], page_files.read_pages

    def noted(*args):
        assert not any(frame() for frame in held)
        frames = read_pages(*args)
        listed.append(len(frames[0].inputFiles()))
        held.append(weakref.ref(frames[0]._jdf))
        return frames

    monkeypatch.setattr(page_files, "read_pages", noted)
    monkeypatch.setattr(extract_queries, "PORTION", 10, raising=False)
    gc.disable()  # so that it is not by chance
    try:
        found = QUERIES[name](spark, SF)
    finally:
        gc.enable()
    assert sum(listed) == found.count() == 50 and len(listed) == 5 and max(listed) < 20
    assert sum("/page=" in f for f in found.inputFiles()) == listed[-1]
    held.clear()
    assert differences(spark, con, SF, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
