"""The run from raw rows to segments: which tables are written, which stay lazy."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tallyloom.config import FEED_CONFIG, RetailConfig
from tallyloom.functions.rows import settled
from tallyloom.operators import audit, cleaning, dimensions, facts, lifecycle, measures, rfm, winback
from tallyloom.sources import feed, shapes, shards
from tallyloom.sources.staging import bucketed_scans, delete, fingerprint, forget_kept, new_folder, written_to
from tallyloom.sources.store import StageStore, content_marks, key_of


@dataclass(frozen=True)
class RawTables:
    """The four raw inputs, all columns text."""

    orders: DataFrame
    items: DataFrame
    customers: DataFrame
    products: DataFrame


def feed_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(
        feed.raw_orders(spark, sf_dir),
        feed.raw_items(spark, sf_dir),
        feed.raw_customers(spark, sf_dir),
        feed.raw_products(spark, sf_dir),
    )


# The stages that each stage reads, for stages that a store keeps; settings are part of every key.
READS = {
    "raw_orders": (), "raw_items": (), "raw_customers": (), "raw_products": (),
    "orders_cleaned": ("raw_orders",), "items_cleaned": ("raw_items",),
    "orders_validated": ("orders_cleaned",), "items_validated": ("items_cleaned",),
    "customers": ("raw_customers",), "products": ("raw_products",), "catalogue": ("products",),
    "priced_items": ("items_validated", "catalogue"), "order_totals": ("priced_items",),
    "order_baskets": ("orders_validated", "order_totals"),
    "sales_curated": ("orders_validated", "order_totals", "customers"), "items_for_bi": ("priced_items", "sales_curated"),
    "customer_rfm": ("sales_curated",), "rfm_customer_segments": ("customer_rfm",),
    "dim_customers_for_bi": ("customers", "rfm_customer_segments"), "customer_months": ("sales_curated",),
    "cohort_retention": ("customer_months",), "revenue_new_returning": ("customer_months",),
    "segment_economics": ("sales_curated", "rfm_customer_segments"),
}
# Where a stage's property has another name than the stage.
PROPERTIES = {
    "orders_validated": "orders", "items_validated": "items", "priced_items": "priced", "order_baskets": "baskets",
    "sales_curated": "curated", "items_for_bi": "lines", "rfm_customer_segments": "segments",
    "dim_customers_for_bi": "dim_customers", "cohort_retention": "retention", "revenue_new_returning": "new_returning",
    "segment_economics": "economics",
}

PART_BYTES = 8_000_000  # of the facts' files: about 400,000 lines, which a task sorts in memory


@dataclass
class Shop:
    """All tables of one source, each built on first use.

    Tables that many queries read are written once as stages, in a folder of this
    shop's own; the rest are plain DataFrames over them. ``close`` deletes the folder.
    Raw and cleaned rows follow from one input row each: other stages read them unwritten, see ``rows``.
    With a ``store``, the stages in ``READS`` are kept there for later sessions, and a
    change of the source rewrites its months and the stages that read them.
    """

    spark: SparkSession
    source: str
    raw: RawTables
    cfg: RetailConfig = field(default=FEED_CONFIG)
    names: list[str] = field(default_factory=list)  # of the bucketed stages
    audits: dict[date, DataFrame] = field(default_factory=dict)  # clean audits by day
    store: StageStore | None = None
    versions: dict[str, object] = field(default_factory=dict)  # of the stages taken from the store
    rebuilt: list = field(default_factory=list)  # two states of a kept stage, for the query that compares them

    @cached_property
    def folder(self) -> str:
        return new_folder(self.spark, "stage")

    @cached_property
    def parts(self) -> int:
        """Partitions and buckets of what is dealt by order: the session's number, more for a source that would fill them too full."""
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), feed.fact_bytes(self.spark, self.source) // PART_BYTES)

    def rows(self, kind: str) -> DataFrame:
        """Raw orders or items for the stages made of them: from the source, or from the store's stage."""
        return settled(getattr(self.raw, kind)) if self.store is None else getattr(self, f"raw_{kind}")

    def _stage(self, label, build, cluster=(), by=None) -> DataFrame:
        """The stage table: ``cluster`` sorts each file, without a shuffle, so that row-group statistics can skip rows;
        ``by`` names a column whose values get a folder each, so that filters on it prune files."""
        def made() -> DataFrame:
            return build().sortWithinPartitions(*cluster) if cluster else build()

        if self.store is None or label not in READS:
            return written_to(made(), f"{self.folder}/{label}", by)
        if by is None:
            df, self.versions[label] = self.store.whole(label, self._key(label), made)
        elif not READS[label]:
            df, self.versions[label] = self.store.raw_months(label, made(), by)
        else:
            (source,) = READS[label]
            self._key(label)
            keys = {m: key_of(self.cfg, version) for m, version in self.versions[source].items()}
            df, self.versions[label] = self.store.months(label, keys, made, by)
        return df

    def _key(self, label: str) -> str:
        """Settings and the versions of what a stage reads, which are brought up to date first."""
        for source in READS[label]:
            getattr(self, PROPERTIES.get(source, source))
        if not READS[label]:
            return key_of(content_marks(getattr(self.raw, label.removeprefix("raw_"))))
        return key_of(self.cfg, *[self.versions[source] for source in READS[label]])

    def _bucketed(self, label, build, key="order_id") -> DataFrame:
        """A stage laid out by its join key: stages with one key join and sum without an exchange."""
        buckets = self.parts
        if self.store is not None:
            df, self.versions[label], name = self.store.bucketed(label, self._key(label), build, key, buckets)
            self.names.append(name)
            return df
        name = f"tallyloom_{self.folder.rsplit('-', 1)[-1]}_{label}"
        df = build()
        with bucketed_scans(self.spark):
            (
                df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
                .option("path", f"{self.folder}/{label}").format("parquet").saveAsTable(name)
            )
        self.names.append(name)
        return self.spark.table(name)

    def close(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete(self.spark, self.folder)

    @cached_property
    def shard_folders(self) -> dict[str, str]:
        """Orders and items written once as month shards."""
        folders = {kind: f"{self.folder}/shards/{kind}" for kind in ("orders", "items")}
        for kind, path in folders.items():
            shards.write_months(self.rows(kind), path, replace_all=True)
        return folders

    @cached_property
    def raw_orders(self) -> DataFrame:
        return self._stage("raw_orders", lambda: self.raw.orders, by="source_month")

    @cached_property
    def raw_items(self) -> DataFrame:
        return self._stage("raw_items", lambda: self.raw.items, by="source_month")

    @cached_property
    def raw_customers(self) -> DataFrame:
        return self._stage("raw_customers", lambda: self.raw.customers)

    @cached_property
    def raw_products(self) -> DataFrame:
        return self._stage("raw_products", lambda: self.raw.products)

    def _shapes(self, folders: dict[str, str]) -> dict[str, list[shapes.Shape]]:
        return {kind: shapes.shapes(self.spark, path, kind, self.cfg) for kind, path in folders.items()}

    @cached_property
    def shard_shapes(self) -> dict[str, list[shapes.Shape]]:
        return self._shapes(self.shard_folders)

    @cached_property
    def inventory(self) -> DataFrame:
        """Tables, columns and types of the month shards, read from the shards."""
        return self._stage("inventory", lambda: self._inventory(self.shard_shapes))

    def _inventory(self, found: dict[str, list[shapes.Shape]]) -> DataFrame:
        return shapes.inventory(self.spark, found["orders"], "orders").unionByName(shapes.inventory(self.spark, found["items"], "items"))

    @cached_property
    def faulty_folders(self) -> dict[str, str]:
        """The shards again, with ``feed.FAULTS``: one month lacks a column, one has it in another type."""
        folders = {kind: f"{self.folder}/faulty/{kind}" for kind in ("orders", "items")}
        for kind, path in folders.items():
            for part in feed.faulty(self.rows(kind), kind):
                shards.write_months(part, path)
        return folders

    @cached_property
    def faulty_shapes(self) -> dict[str, list[shapes.Shape]]:
        return self._shapes(self.faulty_folders)

    @cached_property
    def faulty_inventory(self) -> DataFrame:
        return self._stage("faulty_inventory", lambda: self._inventory(self.faulty_shapes))

    def guarded(self, kind: str, found: dict[str, list[shapes.Shape]], inventory: DataFrame) -> DataFrame:
        """A kind's shards as one table, or no rows when their contract is broken."""
        expected = {"orders": audit.ORDER_HEADERS, "items": audit.ITEM_HEADERS}[kind]
        if audit.schema_contract(inventory, kind, expected, self.cfg).first()["contract_ok"]:
            return shapes.read_shapes(self.spark, found[kind], kind)
        return shards.no_rows(self.spark, kind)

    def audit_of(self, found: dict[str, list[shapes.Shape]], inventory: DataFrame) -> DataFrame:
        """The raw audit of shards as they lie there; checks on a source with a broken contract are skipped."""
        orders, items = (self.guarded(kind, found, inventory) for kind in ("orders", "items"))
        return audit.raw_audit(audit.RawSource(orders, items, self.raw_customers, self.raw_products, inventory, self.parts), self.cfg)

    @cached_property
    def raw_audit(self) -> DataFrame:
        """29 rows, written once: the findings read them."""
        source = audit.RawSource(self.rows("orders"), self.rows("items"), self.raw_customers, self.raw_products, self.inventory, self.parts)
        return self._stage("raw_audit", lambda: audit.raw_audit(source, self.cfg))

    def clean_audit(self, day: date) -> DataFrame:
        """29 rows, written once a day looked at."""
        if day not in self.audits:
            self.audits[day] = self._stage(f"clean_audit_{day}", lambda: audit.clean_audit(
                self.orders, self.items, self.customers, self.products, self.order_totals, day))
        return self.audits[day]

    @cached_property
    def orders_intake(self) -> DataFrame:
        return cleaning.orders_intake(self.raw_orders, self.cfg)

    @cached_property
    def items_intake(self) -> DataFrame:
        return cleaning.items_intake(self.raw_items, self.cfg)

    @cached_property
    def orders_cleaned(self) -> DataFrame:
        return self._stage("orders_cleaned", lambda: cleaning.orders_cleaned(self.rows("orders"), self.cfg), by="source_month")

    @cached_property
    def items_cleaned(self) -> DataFrame:
        return self._stage("items_cleaned", lambda: cleaning.items_cleaned(self.rows("items"), self.cfg), by="source_month")

    @cached_property
    def orders(self) -> DataFrame:
        return self._bucketed("orders_validated", lambda: cleaning.orders_validated(
            cleaning.orders_cleaned(self.rows("orders"), self.cfg) if self.store is None else self.orders_cleaned, self.parts))

    @cached_property
    def items(self) -> DataFrame:
        return self._bucketed("items_validated", lambda: cleaning.items_validated(
            cleaning.items_cleaned(self.rows("items"), self.cfg) if self.store is None else self.items_cleaned, self.parts))

    @cached_property
    def customers(self) -> DataFrame:
        return self._stage("customers", lambda: dimensions.standardize_customers(self.raw_customers))

    @cached_property
    def products(self) -> DataFrame:
        return self._stage("products", lambda: dimensions.standardize_products(self.raw_products))

    @cached_property
    def catalogue(self) -> DataFrame:
        return self._stage("catalogue", lambda: facts.catalogue(self.products))

    @cached_property
    def priced(self) -> DataFrame:
        return self._bucketed("priced_items", lambda: facts.priced_items(self.items, self.catalogue))

    @cached_property
    def costed(self) -> DataFrame:
        """The columns of ``priced`` that totals and marts read, dealt by order without the wide ones; in a store, ``priced``."""
        if self.store is not None:
            return self.priced
        return self._bucketed("costed_items", lambda: facts.priced_items(self.items, self.catalogue).select(
            "order_id", "product_id", "quantity", "line_net_amount", "known_product", "product_category", "brand", "unit_cost", "copy"))

    @cached_property
    def order_totals(self) -> DataFrame:
        return self._bucketed("order_totals", lambda: facts.order_totals(self.costed))

    @cached_property
    def baskets(self) -> DataFrame:
        return self._stage("order_baskets", lambda: facts.order_baskets(self.orders, self.order_totals))

    @cached_property
    def curated(self) -> DataFrame:
        return self._bucketed(
            "sales_curated", lambda: facts.sales_curated(self.orders, self.order_totals, self.customers)
        )

    @cached_property
    def lines(self) -> DataFrame:
        return self._stage(
            "items_for_bi", lambda: facts.items_for_bi(self.costed, self.curated)
        )

    @cached_property
    def customer_rfm(self) -> DataFrame:
        return self._stage("customer_rfm", lambda: rfm.customer_rfm(self.curated))

    @cached_property
    def segments(self) -> DataFrame:
        return self._stage(
            "rfm_customer_segments", lambda: rfm.rfm_customer_segments(self.customer_rfm, self.cfg),
            ["rfm_segment", "customer_id"],
        )

    @cached_property
    def rfm_for_bi(self) -> DataFrame:
        return rfm.rfm_for_bi(self.segments)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return self._stage(
            "dim_customers_for_bi",
            lambda: dimensions.dim_customers_for_bi(self.customers, self.rfm_for_bi),
        )

    @cached_property
    def customer_months(self) -> DataFrame:
        return self._stage("customer_months", lambda: lifecycle.customer_months(self.curated))

    @cached_property
    def retention(self) -> DataFrame:
        return self._stage("cohort_retention", lambda: lifecycle.cohort_retention(self.customer_months))

    @cached_property
    def new_returning(self) -> DataFrame:
        return self._stage(
            "revenue_new_returning", lambda: lifecycle.revenue_new_returning(self.customer_months)
        )

    @cached_property
    def economics(self) -> DataFrame:
        return self._stage(
            "segment_economics", lambda: winback.segment_economics(self.curated, self.segments)
        )

    @cached_property
    def star(self) -> measures.Star:
        return measures.Star.of(self)


def open_shop(spark: SparkSession, source: str, raw: RawTables, cfg: RetailConfig, root: str) -> Shop:
    """A shop whose stages are kept under ``root``: unchanged ones are read again by every later session."""
    return Shop(spark, source, raw, cfg, store=StageStore(spark, root))


_SHOPS: dict[tuple[str, str, RetailConfig], tuple[tuple, Shop]] = {}


def shop_of(spark: SparkSession, sf_dir: str, cfg: RetailConfig = FEED_CONFIG) -> Shop:
    """The shop over the driver's tables in one folder; another one for other settings or changed files."""
    key, seen = (spark.sparkContext.applicationId, sf_dir, cfg), fingerprint(spark, sf_dir)
    if key not in _SHOPS or _SHOPS[key][0] != seen:
        if key in _SHOPS:
            _SHOPS[key][1].close()
        _SHOPS[key] = (seen, Shop(spark, sf_dir, feed_tables(spark, sf_dir), cfg))
    return _SHOPS[key][1]


def rebuild(spark: SparkSession, sf_dir: str) -> Shop:
    """A shop with no stages yet, for timing a whole run."""
    forget(spark)
    return shop_of(spark, sf_dir)


def forget(spark: SparkSession) -> None:
    """Delete all stages and scratch tables of this application."""
    app = spark.sparkContext.applicationId
    for key in [k for k in _SHOPS if k[0] == app]:
        _SHOPS.pop(key)[1].close()
    forget_kept(spark)
