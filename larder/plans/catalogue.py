"""The tables a query can use: stored or derived silver tables, and gold tables on top."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date
from functools import cache

from pyspark.sql import DataFrame

from larder.operators import gold
from larder.schemas import GOLD, SILVER
from larder.sources.published import PublishedTable

ITEMS = "weekly_items"


class Catalogue:
    """Table name -> DataFrame, built on first use.

    ``builders`` gives the bronze and silver tables (and, if they are stored, gold tables);
    a gold table it lacks is planned from silver. ``as_of`` is the reference date of every
    relative-date query, ``compat`` selects the published behaviour of the gold tables.
    """

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]], as_of: date,
                 locale: str = gold.LOCALE, compat: bool = False):
        self._builders, self._made = dict(builders), {}
        self.as_of, self.locale, self.compat = as_of, locale, compat

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            builder = self._builders.get(name) or self._gold_builder(name)
            self._made[name] = builder()
        return self._made[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    def _gold_builder(self, name: str) -> Callable[[], DataFrame]:
        if name == ITEMS:
            return lambda: gold.weekly_items(self.menus, self.menu_recipes,
                                             active_menus_only=False)
        if name not in GOLD:
            raise KeyError(f"no such table: {name}")
        items = self[ITEMS] if ITEMS in self._builders else None
        return {
            "weekly_menu_metrics": lambda: gold.weekly_menu_metrics(
                self.menus, self.menu_recipes, self.recipes, self.locale, self.compat, items),
            "recipe_survival_metrics": lambda: gold.recipe_survival_metrics(
                self.recipes, self.as_of),
            "ingredient_trends": lambda: gold.ingredient_trends(
                self.ingredients, self.recipe_ingredients, self.recipes, self.menu_recipes,
                self.menus, self.compat, items),
            "menu_stability_metrics": lambda: gold.menu_stability_metrics(
                self.menus, self.menu_recipes, self.locale, items),
            "allergen_density": lambda: gold.allergen_density(
                self.menus, self.menu_recipes, self.recipes, self.recipe_allergens,
                self.allergens, items),
        }[name]

    def _with(self, builders: Mapping[str, Callable[[], DataFrame]]) -> Catalogue:
        return Catalogue({**self._builders, **builders}, self.as_of, self.locale, self.compat)

    def _stored(self, name: str, path: str) -> Callable[[], DataFrame]:
        """A builder that writes a table once, also for catalogues that are made from this one."""
        @cache
        def build() -> DataFrame:
            rows = self[name]
            return PublishedTable(rows.sparkSession, f"{path}/{name}").publish(rows)
        return build

    def storing_silver(self, path: str) -> Catalogue:
        """This catalogue with silver tables written below ``path`` when first used, for sources
        that derive them anew at each reference."""
        return self._with({name: self._stored(name, path) for name in SILVER})

    def storing_gold(self, path: str) -> Catalogue:
        """This catalogue with gold tables written below ``path`` when first used.

        They share one stored table of weekly items, so the menu links are joined once.
        """
        staged = self._with({ITEMS: self._stored(ITEMS, path)})
        return staged._with({name: staged._stored(name, path) for name in GOLD})

    def refresh_gold(self, path: str) -> Catalogue:
        """Recompute and publish all gold tables below ``path``."""
        stored = self.storing_gold(path)
        for name in GOLD:
            stored[name]
        return stored
