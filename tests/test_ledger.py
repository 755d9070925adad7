"""What a load ledger must survive: each sequence gives what a rebuild of all pages gives."""

import pytest

from larder.operators import merge
from larder.plans.silver import Warehouse, append_state
from larder.session import names, remove, work_dir
from larder.sources import landing, published
from larder.sources.published import Load, PublishedTable
from larder.streaming import incremental
from tests.helpers import pages, table

TABLES = ("recipes", "menu_recipes")


def page(day, *ids):
    recipes = ", ".join(f'{{"id": "{i}", "name": "{i}@{day}"}}' for i in ids)
    return (f"2026-01-{day:02d}", "menus", f'{{"data": [{{"id": "m{day}", "recipes": [{recipes}]}}]}}')


def land(spark, home, *weeks):
    landing.append_bronze(pages(spark, *weeks), f"{home}/bronze")


def stream(spark, home, house, files=1000, checkpoint="checkpoint"):
    incremental.silver_stream(
        incremental.bronze_stream(spark, f"{home}/bronze", files_per_batch=files), house,
        f"{home}/{checkpoint}", TABLES)


def assert_whole(spark, home, house):
    whole = Warehouse(spark, work_dir(spark, "whole"))
    whole.rebuild(landing.read_bronze(spark, f"{home}/bronze"), TABLES)
    for name in TABLES:
        assert table(house.table(name)) == table(whole.table(name))


def test_a_checkpoint_made_anew_loses_nothing(spark):
    home = work_dir(spark, "anew")
    house = Warehouse(spark, f"{home}/silver")
    land(spark, home, page(1, 1), page(2, 2))
    stream(spark, home, house)
    remove(spark, f"{home}/checkpoint")
    land(spark, home, page(3, 3))
    stream(spark, home, house)
    assert [r[0] for r in table(house.table("recipes"), "id")] == ["1", "2", "3"]
    assert_whole(spark, home, house)


def test_a_checkpoint_put_back_loses_nothing(spark, tmp_path):
    """A copy of an older checkpoint has the old id and gives old numbers to new rows."""
    import shutil
    home = work_dir(spark, "copy")
    house = Warehouse(spark, f"{home}/silver")
    land(spark, home, page(1, 1))
    stream(spark, home, house)
    shutil.copytree(f"{home}/checkpoint", f"{home}/copy")
    land(spark, home, page(2, 2))
    stream(spark, home, house)
    land(spark, home, page(3, 3))
    stream(spark, home, house, checkpoint="copy")
    assert_whole(spark, home, house)


def test_a_crash_between_write_and_commit(spark, monkeypatch):
    home = work_dir(spark, "crash")
    house = Warehouse(spark, f"{home}/silver")
    land(spark, home, page(1, 1))
    stream(spark, home, house)
    land(spark, home, page(2, 1, 2))
    with monkeypatch.context() as broken:
        def lost(session, path):
            if "menu_recipes" in path:
                raise OSError("driver lost")
            touch(session, path)
        touch = published.touch
        broken.setattr(published, "touch", lost)
        with pytest.raises(Exception, match="driver lost"):
            stream(spark, home, house)
    assert house.store("menu_recipes").current_version() == 0
    stream(spark, home, house)  # the same batch again: one table has it, the other not
    assert house.store("recipes").current_version() == 1
    assert house.store("menu_recipes").current_version() == 1
    assert_whole(spark, home, house)


def test_two_streams_into_one_warehouse(spark):
    home = work_dir(spark, "two")
    house = Warehouse(spark, f"{home}/silver")
    land(spark, home, page(1, 1), page(2, 2))
    stream(spark, home, house, 1, "one")
    stream(spark, home, house, 1, "other")
    land(spark, home, page(3, 1, 3))
    stream(spark, home, house, 1, "other")
    stream(spark, home, house, 1, "one")
    assert_whole(spark, home, house)


def test_replay_after_expiry_is_known_from_a_bounded_log(spark, monkeypatch):
    monkeypatch.setattr("larder.plans.silver.DELTAS", 2)
    monkeypatch.setattr(published, "COMPACT", 5)
    store = PublishedTable(spark, work_dir(spark, "expiry"))

    def load(day, number):
        rows = spark.createDataFrame([(day % 4, f"2026-01-{day:02d}")], "id int, pull_date string")
        append_state(store, merge.fold(rows, ["id"], [], []), Load("s", number))

    for n in range(20):
        load(1 + n, n)
    before, version = table(merge.combine(*store.parts())), store.current_version()
    assert "version=0" not in names(spark, store.path)
    for n in range(20):
        load(28, n)  # other rows: nothing of them may be written
        assert store.publish(None, load=Load("s", n)) is None
    assert store.current_version() == version
    assert table(merge.combine(*store.parts())) == before
    assert not store.has(Load("s", 20)) and not store.has(Load("t", 3))
    assert not store.has(Load("s", 3, "another plan"))
    # Bounded: the log, two ledgers of one file, and the versions in use.
    assert len(store.commits()) <= 2 * 3 + 5
    found = names(spark, store.path)
    ledgers = [n for n in found if n.startswith("ledger=")]
    assert 1 <= len(ledgers) <= 2 and len([n for n in found if n.startswith("version=")]) <= 7
    assert all(sum(n.endswith(".parquet") for n in names(spark, f"{store.path}/{n}")) == 1
               for n in ledgers)


def test_a_compaction_cut_off_anywhere_loses_no_key(spark, monkeypatch):
    monkeypatch.setattr(published, "COMPACT", 3)
    store = PublishedTable(spark, work_dir(spark, "cut"))
    rows = spark.range(1)

    def lost(*_):
        raise OSError("driver lost")

    monkeypatch.setattr(published, "remove", lost)
    for n in range(8):
        try:
            store.publish(rows, load=Load("s", n))
        except OSError:
            pass
    assert all(store.has(Load("s", n)) for n in range(8))


# --- deactivation by complete pulls ---------------------------------------------------


def part(day, number, last, *ids):
    pull, endpoint, payload = page(day, *ids)
    return pull, endpoint, payload[:-1] + f', "meta": {{"last_page": {last}}}}}', number


def active(house):
    return {i: a for i, a in table(house.table("recipes"), "id", "is_active")}


def test_an_aborted_pull_deactivates_nothing(spark):
    first = [part(1, 1, 2, 1, 2), part(1, 2, 2, 3, 4)]
    second = [part(2, 1, 2, 1, 5), part(2, 2, 2, 2)]
    home = work_dir(spark, "aborted")
    plain = Warehouse(spark, f"{home}/plain", deactivate=True)
    house = Warehouse(spark, f"{home}/gated", deactivate=True, audited=True)
    for each in (plain, house):
        each.append(pages(spark, *first), TABLES)
        each.append(pages(spark, second[0]), TABLES)
    assert active(plain) == {"1": 1, "2": 0, "3": 0, "4": 0, "5": 1}
    assert active(house) == {"1": 1, "2": 1, "3": 1, "4": 1, "5": 1}
    report = [(str(r.pull_date), r.is_complete, [tuple(m) for m in r.missing])
              for r in house.audit().orderBy("pull_date").collect()]
    assert report == [("2026-01-01", True, []), ("2026-01-02", False, [(2, 2)])]
    # The missing page is malformed at first, then pulled again.
    house.append(pages(spark, ("2026-01-02", "menus", "{damaged", 2)), TABLES)
    assert active(house)["3"] == 1
    house.append(pages(spark, second[1]), TABLES)
    assert active(house) == {"1": 1, "2": 1, "3": 0, "4": 0, "5": 1}
    # A later aborted pull changes nothing but what it brings.
    house.append(pages(spark, part(3, 1, 3, 3)), TABLES)
    assert active(house) == {"1": 1, "2": 1, "3": 1, "4": 0, "5": 1}
    rebuilt = Warehouse(spark, f"{home}/rebuilt", deactivate=True, audited=True)
    rebuilt.rebuild(pages(spark, *first, *second, part(3, 1, 3, 3)), TABLES)
    assert active(rebuilt) == active(house)


def test_without_a_complete_pull_all_stay_active(spark):
    house = Warehouse(spark, work_dir(spark, "never"), deactivate=True, audited=True)
    house.append(pages(spark, part(1, 1, 2, 1)), TABLES, Load("s", 0))
    house.append(pages(spark, part(2, 2, 2, 2)), TABLES, Load("s", 1))
    house.append(pages(spark, part(2, 2, 2, 2)), TABLES, Load("s", 1))
    assert active(house) == {"1": 1, "2": 1}
    assert house.store("_pages").current_version() == 1
