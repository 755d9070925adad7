"""Bronze to silver: a full rebuild and an incremental append that give the same tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.operators import bronze as raw
from larder.operators import merge
from larder.operators.flatten import ORDER, Stage, silver_observations
from larder.schemas import SILVER, TABLES
from larder.session import remove, work_dir
from larder.sources.published import Load, PublishedTable

AUDIT = "_pages"  # the marks of an audited warehouse, beside its tables
WRITERS = 4  # tables written at the same time
#: Documents a staged file holds. Files are opened at a cost of 4 MB in a split of 128, so a task
#: sorts at most 32 times as many before its first combine, however well they compress.
STAGED = 50_000
DELTAS = 8  # deltas after which a table's state is written whole again


def fold_table(name: str, rows: DataFrame) -> DataFrame:
    """Observations of a silver table as state rows."""
    table = TABLES[name]
    present = "present" if "present" in rows.columns else None
    return merge.fold(rows, table.keys, table.attribute_names, ORDER, present=present,
                      stamp="ingestion_timestamp")


def fold_bronze(bronze: DataFrame, tables: Iterable[str] = SILVER,
                stage: Stage | None = None) -> dict[str, DataFrame]:
    """State rows of silver tables over the pulls given (malformed pages yield none)."""
    return {name: fold_table(name, rows)
            for name, rows in silver_observations(bronze, tables, stage).items()}


#: The endpoints whose pages a table's rows come from; the others come from one of their name.
SOURCES = {"recipes": ("menus", "recipes"), "recipe_ingredients": ("menus", "recipes"),
           "menu_recipes": ("menus",),
           **{f"recipe_{kind}": ("recipes",) for kind in ("allergens", "tags", "labels")}}


def append_state(store: PublishedTable, state: DataFrame, load: Load | None = None,
                 combine: Callable[..., DataFrame] = merge.combine) -> None:
    """Add state rows as a delta, which costs what the batch costs. Every :data:`DELTAS` loads the
    state is written whole and what that replaces is deleted."""
    store.publish(state, base=not store.commits(), load=load)
    if len(store.parts()) > DELTAS:
        store.publish(combine(*store.parts()))
        store.expire()


class Warehouse:
    """Silver state tables below one folder.

    With ``deactivate`` a key that the newest pull of its table lacks is inactive; without it
    every key stays active, as in the published tables. With ``audited`` the warehouse keeps marks
    of the well-formed pages of every load, and only a pull of which no page is missing (in any
    locale of the table's endpoints) deactivates: an aborted pull may add keys and dates, but
    what it lacks stays as it was. All loads of an audited warehouse must be made with it.
    """

    def __init__(self, spark: SparkSession, path: str, deactivate: bool = False,
                 audited: bool = False):
        self.spark, self.path, self.deactivate = spark, path.rstrip("/"), deactivate
        self.audited = audited

    def store(self, name: str) -> PublishedTable:
        return PublishedTable(self.spark, f"{self.path}/{name}")

    def state(self, name: str) -> DataFrame:
        """A table's state rows: its base and deltas combined."""
        return merge.combine(*self.store(name).parts())

    def _load(self, bronze: DataFrame, tables: tuple[str, ...],
              write: Callable[[PublishedTable, DataFrame], object]) -> None:
        """Fold pages and write each table. With several tables, parsed documents are staged as
        Parquet, and removed when all tables are written."""
        home = work_dir(self.spark, "documents")

        def stage(name: str, rows: DataFrame) -> Callable[[StructType], DataFrame]:
            # Read a few times and then removed: a dictionary costs more than it saves.
            (rows.write.option("maxRecordsPerFile", STAGED).option("compression", "zstd")
             .option("parquet.enable.dictionary", False).parquet(f"{home}/{name}"))
            return lambda schema: self.spark.read.schema(schema).parquet(f"{home}/{name}")

        states = fold_bronze(bronze, tables, stage if len(tables) > 1 else None)
        self._each(lambda name: write(self.store(name), states[name]), tables)
        remove(self.spark, home)

    def _each(self, publish: Callable[[str], object], tables: tuple[str, ...]) -> None:
        """Publish tables side by side, so that small ones do not queue behind large ones. If
        one fails the load can be repeated: merging what is already merged changes nothing."""
        with ThreadPoolExecutor(max_workers=WRITERS) as pool:
            list(pool.map(publish, tables))

    def audit(self) -> DataFrame:
        """The page audit of all loads; ``is_complete`` and ``missing`` report aborted pulls."""
        return raw.audit_of(raw.combine_marks(*self.store(AUDIT).parts()))

    def rebuild(self, bronze: DataFrame, tables: tuple[str, ...] = SILVER) -> None:
        """Recompute tables from all of bronze."""
        if self.audited:
            store = self.store(AUDIT)
            store.publish(raw.page_marks(raw.well_formed(bronze)))
            store.expire()
        self._load(bronze, tables, lambda store, state: (store.publish(state), store.expire()))

    def append(self, new_pulls: DataFrame, tables: tuple[str, ...] = SILVER,
               load: Load | None = None) -> None:
        """Merge new pages. Pages merged before, or pulls older than the table, do no harm. Tables
        that have the ``load`` already are left out, and if all have it nothing is read."""
        if self.audited:
            store = self.store(AUDIT)
            if load is None or not store.has(load):
                append_state(store, raw.page_marks(raw.well_formed(new_pulls)), load,
                             raw.combine_marks)
        if load is not None:
            tables = tuple(name for name in tables if not self.store(name).has(load))
        if tables:
            self._load(new_pulls, tables,
                       lambda store, state: append_state(store, state, load))

    def table(self, name: str, newest_pull: Column | None = None) -> DataFrame:
        """A silver table; with ``newest_pull`` keys missing from that pull are inactive. A
        deactivating warehouse takes the newest pull that the table itself has seen, an audited one
        the newest of its endpoints that is complete."""
        parts = self.store(name).parts()
        if newest_pull is None and self.deactivate:
            # The newest date of the parts is that of the state, and needs no combining.
            newest_pull = raw.newest_complete_pull(
                self.audit(), SOURCES.get(name, (name,))) if self.audited else merge.newest_pull(
                reduce(DataFrame.unionByName, (part.select(merge.LAST) for part in parts)),
                merge.LAST)
        return merge.published(merge.combine(*parts), newest_pull)
