"""Schemas of the input files, and tables whose columns have other names."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

# Column names and types of the four input tables.
INTERACTIONS = (
    "app_id BIGINT NOT NULL, helpful INT, funny INT, date STRING, is_recommended BOOLEAN, "
    "hours DOUBLE, user_id BIGINT NOT NULL, review_id BIGINT NOT NULL"
)
ITEMS = (
    "app_id BIGINT NOT NULL, title STRING, date_release STRING, win BOOLEAN, mac BOOLEAN, "
    "linux BOOLEAN, rating STRING, positive_ratio INT, user_reviews INT, price_final DOUBLE, "
    "price_original DOUBLE, discount DOUBLE, steam_deck BOOLEAN"
)
ITEM_TAGS = "app_id BIGINT NOT NULL, description STRING, tags ARRAY<STRING>"
USERS = "user_id BIGINT NOT NULL, products INT, reviews INT"


@dataclass(frozen=True)
class Columns:
    """Names of the columns that are read, where a caller's tables have their own."""

    user: str = "user_id"
    item: str = "app_id"
    liked: str = "is_recommended"
    title: str = "title"
    tags: str = "tags"
    reviews: str = "reviews"

    def _own(self) -> dict[str, str]:
        return {
            self.user: "user_id",
            self.item: "app_id",
            self.liked: "is_recommended",
            self.title: "title",
            self.tags: "tags",
            self.reviews: "reviews",
        }

    def standard(self, table: DataFrame) -> DataFrame:
        """The columns read from a table, by their standard names; others are left out, so
        that none of them can be taken for one that is read."""
        return table.select(*[table[name].alias(new) for name, new in self._own().items() if name in table.columns])

    def restored(self, result: DataFrame) -> DataFrame:
        """A result with its columns by the caller's names."""
        return result.withColumnsRenamed({new: name for name, new in self._own().items()})
