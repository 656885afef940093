"""Joins of the sales fact with its three dimensions.

All joins are inner: rows without a partner, and rows with a NULL key, drop
out; a dimension key with several rows multiplies the fact rows.

A dimension is broadcast only when its measured size is below the limit.
Beyond it the join is a sort-merge join. Hot keys (one customer with a third of
all sales) are dealt over many tasks when they are given; without them, AQE
splits what it finds too large.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martweave.contract import CUSTOMER_COLUMNS, SALES_TEAM_COLUMNS, STORE_COLUMNS
from martweave.functions.sales import full_name
from martweave.operators.hot_join import hot_keys, join_spread
from martweave.operators.sizing import BROADCAST_LIMIT, Size, is_whole, key_word, measure, row_bytes, word_bit


class Dimensions:
    """The customer, store and sales-team tables, with their measured sizes.

    The sizes are taken at first use, by one job over all three tables.
    """

    KEYS = {"customer": "customer_id", "store": "id", "sales_team": "id"}
    FACT_KEYS = {"customer": "customer_id", "store": "store_id", "sales_team": "sales_person_id"}

    def __init__(
        self,
        customer: DataFrame,
        store: DataFrame,
        sales_team: DataFrame,
        broadcast_limit: int = BROADCAST_LIMIT,
    ):
        self.customer = customer.select(*CUSTOMER_COLUMNS)
        self.store = store.select(*STORE_COLUMNS)
        self.sales_team = sales_team.select(*SALES_TEAM_COLUMNS)
        self.broadcast_limit = broadcast_limit

    @cached_property
    def sizes(self) -> dict[str, Size]:
        return measure({name: (getattr(self, name), key) for name, key in self.KEYS.items()})

    def fits(self, name: str) -> bool:
        """True when the whole dimension may be broadcast."""
        return self.sizes[name].bytes <= self.broadcast_limit

    @property
    def all_fit(self) -> bool:
        return all(self.fits(name) for name in self.KEYS)

    def keys_fit(self, name: str) -> bool:
        """True when the dimension's keys with their copies may be broadcast, as they often may where names may not."""
        return self.fits(name) or self.sizes[name].distinct_keys * row_bytes(2) <= self.broadcast_limit

    @property
    def all_keys_fit(self) -> bool:
        return all(self.keys_fit(name) for name in self.KEYS)

    @cached_property
    def _words(self) -> dict[str, int]:
        return {}

    def words_fit(self, name: str) -> bool:
        """True when ``key_words(name)``, and the copies of keys with several rows, may be broadcast.

        Numbers given one after the other take a row of 64 keys each, scattered ones a row each: the rows are counted
        where they can be few enough.
        """
        size = self.sizes[name]
        several = (size.keys - size.distinct_keys) * row_bytes(2)  # no fewer than the keys that have several rows
        room = (self.broadcast_limit - several) // row_bytes(2)
        if not is_whole(getattr(self, name), self.KEYS[name]) or size.distinct_keys > 64 * room:
            return False
        if name not in self._words:
            self._words[name] = getattr(self, name).select(key_word(self.KEYS[name])).distinct().count()
        return self._words[name] <= room

    def placed(self, name: str, frame: DataFrame) -> DataFrame:
        """``frame``, which is no larger than dimension ``name``, as a join side."""
        return F.broadcast(frame) if self.fits(name) else frame

    def placed_keys(self, name: str, frame: DataFrame) -> DataFrame:
        """``frame``, which is no larger than ``key_copies(name)``, as a join side."""
        return F.broadcast(frame) if self.keys_fit(name) else frame

    def unique(self, name: str) -> bool:
        return self.sizes[name].unique

    def hot_keys(self, fact: DataFrame) -> dict[str, DataFrame]:
        """Hot keys of ``fact`` for each dimension that is too large to broadcast, from one pass over their columns.

        ``fact`` should be a written table. When all dimensions fit, nothing is read. A dimension without a hot key is
        left out, so its join has no salts.
        """
        names = {self.FACT_KEYS[name]: name for name in self.KEYS if not self.fits(name)}
        found = hot_keys(fact, list(names)) if names else {}
        return {names[key]: hot for key, hot in found.items() if not hot.isEmpty()}

    def key_copies(self, name: str) -> DataFrame:
        """``(key, copies)``: one row per key with the number of its rows."""
        key = F.col(self.KEYS[name]).alias("key")
        table = getattr(self, name)
        if self.unique(name):
            return table.select(key, F.lit(1).alias("copies"))
        return table.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))

    def key_words(self, name: str) -> DataFrame:
        """``(word, bits)``: the keys of a dimension, 64 neighbours to a row."""
        key = self.KEYS[name]
        words = getattr(self, name).where(F.col(key).isNotNull()).groupBy(key_word(key).alias("word"))
        return words.agg(F.bit_or(word_bit(key)).alias("bits"))

    def matched(self, name: str, rows: DataFrame, words: bool = True) -> DataFrame:
        """``rows`` whose key is in dimension ``name``, with ``copies`` when a key may have several rows there.

        Keys too many to broadcast are looked up by their bits where these may be (and ``words`` allows it): the rows stay
        with their tasks.
        """
        own, key = self.FACT_KEYS[name], self.KEYS[name]
        if not words or self.keys_fit(name) or not is_whole(rows, own) or not self.words_fit(name):
            partners = self.key_copies(name)
            found = rows.join(self.placed_keys(name, partners), rows[own] == partners["key"], "inner").drop("key")
            return found.drop("copies") if self.unique(name) else found
        held = (key_word(own) == F.col("word")) & (F.col("bits").bitwiseAND(word_bit(own)) != 0)
        found = rows.join(F.broadcast(self.key_words(name)), held, "inner").drop("word", "bits")
        if self.unique(name):
            return found
        several = self.key_copies(name).where("copies > 1").withColumnRenamed("copies", "more")
        found = found.join(F.broadcast(several), found[own] == several["key"], "left").drop("key")
        return found.withColumn("copies", F.coalesce("more", F.lit(1))).drop("more")

    def customer_names(self) -> DataFrame:
        """What the customer mart shows of a customer, one row per distinct content."""
        shown = self.customer.select(
            "customer_id", full_name("first_name", "last_name").alias("full_name"), "address", "phone_number"
        )
        return shown if self.unique("customer") else shown.distinct()

    def seller_names(self) -> DataFrame:
        """What the incentive mart shows of a sales person, one row per distinct content."""
        shown = self.sales_team.select(
            F.col("id").alias("sales_person_id"), full_name("first_name", "last_name").alias("full_name")
        )
        return shown if self.unique("sales_team") else shown.distinct()


def _inner(
    fact: DataFrame, dims: Dimensions, name: str, dimension: DataFrame, key: str, hot: Mapping[str, DataFrame] | None
) -> DataFrame:
    own = Dimensions.FACT_KEYS[name]
    if hot and name in hot and not dims.fits(name):
        return join_spread(fact, dimension, [own], [key], hot[name]).drop(key)
    return fact.join(dims.placed(name, dimension), fact[own] == dimension[key], "inner").drop(key)


def join_customer(fact: DataFrame, dims: Dimensions, hot: Mapping[str, DataFrame] | None = None) -> DataFrame:
    customer = dims.customer.withColumnRenamed("customer_id", "customer_key")
    return _inner(fact, dims, "customer", customer, "customer_key", hot)


def join_store(fact: DataFrame, dims: Dimensions, hot: Mapping[str, DataFrame] | None = None) -> DataFrame:
    store = dims.store.withColumnRenamed("id", "store_key")
    return _inner(fact, dims, "store", store, "store_key", hot)


def join_sales_team(fact: DataFrame, dims: Dimensions, hot: Mapping[str, DataFrame] | None = None) -> DataFrame:
    team = dims.sales_team.select(
        F.col("id").alias("sales_person_key"),
        F.col("first_name").alias("sales_person_first_name"),
        F.col("last_name").alias("sales_person_last_name"),
        F.col("address").alias("sales_person_address"),
        F.col("pincode").alias("sales_person_pincode"),
        "manager_id",
        "is_manager",
    )
    return _inner(fact, dims, "sales_team", team, "sales_person_key", hot)


def enrich(fact: DataFrame, dims: Dimensions, hot: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The fact with customer, store and sales-team columns.

    ``hot`` is ``dims.hot_keys(fact)``: hot keys of dimensions that are not broadcast.
    """
    lines = fact.drop("product_name", "price", "quantity")
    return join_sales_team(join_store(join_customer(lines, dims, hot), dims, hot), dims, hot)
