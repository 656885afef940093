"""The registered queries: every operator over the whole star-schema tables.

Money is cast to double and dates to text at the very end, so that results can be
compared across engines; all sums are made in decimals before that.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martweave.contract import DONE, FACT_SCHEMA, MANDATORY_COLUMNS, STARTED
from martweave.functions.sales import month_key
from martweave.operators import ledger, widening
from martweave.operators.enrich import Dimensions, enrich
from martweave.operators.ranking import rank_sellers
from martweave.operators.totals import seller_totals
from martweave.plans import batch, deliveries, marts
from martweave.plans.store import MartStore
from martweave.sinks import files, quarantine
from martweave.sinks import jdbc as jdbc_sink
from martweave.sources import jdbc as jdbc_source
from martweave.sources import landing, listing, sales_csv
from martweave.sources.retail_tables import open_tables
from martweave.streaming.pickup import run_id_of, start_file_pickup, start_pickup
from martweave.workspace import as_table, is_local, new_folder

Query = Callable[[SparkSession, str], DataFrame]


def comparable(frame: DataFrame) -> DataFrame:
    """Decimals as double, dates as text, whole numbers as bigint."""
    casts = {T.DecimalType: "double", T.DateType: "string", T.IntegerType: "bigint"}
    return frame.select(
        *[F.col(f.name).cast(casts.get(type(f.dataType), f.dataType)).alias(f.name) for f in frame.schema.fields]
    )


def _inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, Dimensions]:
    tables = open_tables(spark, folder)
    return tables.sales_fact(), tables.dimensions()


def _written_inputs(spark: SparkSession, folder: str, *more: str) -> tuple[DataFrame, Dimensions]:
    """Inputs for queries that land their sales in parts: order lines and orders are joined once, not for every part.

    Of the columns beside the fact's only ``more`` are joined and written.
    """
    sales, dims = _inputs(spark, folder)
    return as_table(sales.select(*FACT_SCHEMA.names, *more), "sales", files.COMPRESSION), dims


def _detail(spark: SparkSession, folder: str) -> DataFrame:
    fact, dims = _inputs(spark, folder)
    return enrich(fact.drop("return_flag", "line_status"), dims)


def fact_conform(spark, folder):
    return comparable(open_tables(spark, folder).sales_fact(product_names=True).select(*MANDATORY_COLUMNS))


def fact_enrich(spark, folder):
    return comparable(_detail(spark, folder))


def customer_detail_mart(spark, folder):
    return comparable(marts.customer_detail(_detail(spark, folder)))


def sales_team_detail_mart(spark, folder):
    return comparable(marts.sales_team_detail(_detail(spark, folder)))


def sales_person_monthly_total(spark, folder):
    return comparable(seller_totals(*_inputs(spark, folder)))


def sales_person_rank(spark, folder):
    return comparable(rank_sellers(seller_totals(*_inputs(spark, folder))))


def sales_person_incentive(spark, folder):
    return comparable(marts.sales_person_incentive(*_inputs(spark, folder)))


def sales_person_incentive_of_detail(spark, folder):
    """The incentive mart made from the detail mart."""
    detail = marts.sales_team_detail(_detail(spark, folder))
    return comparable(marts.sales_person_incentive_of_detail(detail))


def customer_monthly_mart(spark, folder):
    return comparable(marts.customer_monthly(*_inputs(spark, folder)))


def _with_second_names(spark, folder) -> tuple[DataFrame, Dimensions]:
    """Inputs where customers of one nation, and sales people of another, have two rows."""
    tables = open_tables(spark, folder)
    fact = tables.sales_fact().drop("return_flag", "line_status")
    customer, team = tables.customer(), tables.sales_team()
    second = F.lit("Second").alias("last_name")
    customer_copies = customer.where("pincode = '3'").select(
        *[second if c == "last_name" else c for c in customer.columns]
    )
    team_copies = team.where("pincode = '5'").select(*[second if c == "last_name" else c for c in team.columns])
    dims = Dimensions(
        customer.unionByName(customer_copies),
        tables.store(),
        team.unionByName(team_copies),
    )
    return fact, dims


def customer_monthly_mart_two_names(spark, folder):
    """Duplicate dimension keys, from fact and dimensions."""
    return comparable(marts.customer_monthly(*_with_second_names(spark, folder)))


def customer_monthly_mart_windowed(spark, folder):
    """Duplicate dimension keys, from the joined detail."""
    detail = marts.customer_detail(enrich(*_with_second_names(spark, folder)))
    return comparable(marts.customer_monthly_of_detail(detail))


def sales_person_incentive_two_names(spark, folder):
    return comparable(marts.sales_person_incentive(*_with_second_names(spark, folder)))


def _with_hot_customer(spark, folder) -> tuple[DataFrame, Dimensions]:
    """Inputs where the sales of every third order are customer 1's, and no dimension is small enough to broadcast."""
    tables = open_tables(spark, folder)
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    moved = orders.withColumn("o_custkey", F.expr("if(o_orderkey % 3 = 0, 1, o_custkey)"))
    fact = as_table(tables.sales_fact(orders=moved).drop("return_flag", "line_status"), "hot-customer")
    return fact, Dimensions(tables.customer(), tables.store(), tables.sales_team(), broadcast_limit=0)


def fact_enrich_hot_customer(spark, folder):
    """A customer with a third of all sales, and dimensions that are joined by shuffles."""
    fact, dims = _with_hot_customer(spark, folder)
    return comparable(enrich(fact, dims, dims.hot_keys(fact)))


def _checked(spark, folder) -> tuple[str, DataFrame]:
    landed = deliveries.land_deliveries(spark, folder)
    return landed, landing.check_files(spark, landing.list_files(spark, landed))


def header_verdicts(spark, folder):
    """Verdict of every landed delivery, with the number of data lines behind it."""
    landed, verdicts = _checked(spark, folder)
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .text(landed)
        .groupBy(landing.metadata_path().alias("path"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    data_lines = F.coalesce(F.col("lines"), F.lit(0)) - F.when(F.col("path").endswith(".csv"), 1).otherwise(0)
    return comparable(
        verdicts.join(lines, "path", "left")
        .groupBy(
            deliveries.delivery_of(F.col("path")).alias("delivery"),
            "verdict",
            F.coalesce("reason", F.lit("")).alias("reason"),
            F.when(F.col("path").endswith(".csv"), F.array_join("missing", ",")).alias("missing"),
            F.array_join("extras", ",").alias("extras"),
        )
        .agg(F.sum(data_lines).alias("data_lines"))
    )


def landed_file_kinds(spark, folder):
    """Listing and split by extension: which deliveries hold csv files."""
    landed = deliveries.land_deliveries(spark, folder)
    return listing.file_table(spark, landed).select(
        deliveries.delivery_of(F.col("path")).alias("delivery"), "is_csv"
    ).distinct()


def quarantined_lines(spark, folder):
    """Data lines of all rejected files, as kept in quarantine."""
    _, verdicts = _checked(spark, folder)
    target = new_folder(spark, "quarantine")
    quarantine.write_quarantine(spark, verdicts, target, "run")
    return _data_lines(spark, target).select("reason", "value")


def _data_lines(spark, quarantined: str) -> DataFrame:
    """``path, reason, value`` of all quarantined lines but each CSV file's own header."""
    kept = spark.read.parquet(f"{quarantined}/reasons").select("path", "origin", "reason", "header")
    return (
        spark.read.text(f"{quarantined}/lines")
        .join(kept, "origin")
        .where(F.col("header").isNull() | (F.col("value") != F.col("header")))
        .select("path", "reason", "value")
    )


def quarantined_files_of_one_name(spark, folder):
    """All sales as rejected files whose names occur in two folders: data lines of each folder."""
    sales, landed = open_tables(spark, folder).sales_fact(), new_folder(spark, "landing")
    early = "sales_date < '1998-01-01'"
    columns = [c for c in MANDATORY_COLUMNS if c != "store_id"]
    for name, part in (("early", sales.where(early)), ("late", _others(sales, early))):
        deliveries.land_named(part, f"{landed}/{name}", "bad", columns)
    target = new_folder(spark, "quarantine")
    verdicts = landing.check_files(spark, landing.list_files(spark, landed))
    quarantine.write_quarantine(spark, verdicts, target, "run")
    return (
        _data_lines(spark, target)
        .groupBy(F.element_at(F.split("path", "/"), -2).alias("folder"), "reason")
        .agg(F.count(F.lit(1)).alias("data_lines"))
    )


def _others(rows: DataFrame, condition: str) -> DataFrame:
    """The rows that ``condition`` leaves out, those it cannot tell included."""
    return rows.where(f"NOT ({condition}) OR ({condition}) IS NULL")


def extras_folded(spark, folder):
    """All accepted sales with their folded extra columns."""
    _, verdicts = _checked(spark, folder)
    fact = sales_csv.read_sales(spark, landing.require_accepted(verdicts))
    return comparable(
        fact.select("customer_id", "store_id", "sales_date", "sales_person_id", "total_cost", "extra_column")
    )


def extras_by_name(spark, folder):
    """Extra columns kept as a map, counted per name and value."""
    _, verdicts = _checked(spark, folder)
    fact = sales_csv.read_sales(spark, landing.require_accepted(verdicts), keep=("extra_map",))
    return (
        fact.select(F.explode("extra_map").alias("extra", "value"))
        .groupBy("extra", "value")
        .agg(F.count(F.lit(1)).alias("sales"))
    )


def union_by_name_batches(spark, folder):
    """Four header shapes united by name into typed columns."""
    _, verdicts = _checked(spark, folder)
    return comparable(sales_csv.read_sales(spark, landing.require_accepted(verdicts)).select(*MANDATORY_COLUMNS))


def parquet_mart_readback(spark, folder):
    """The customer detail written as one table, twice, and read back."""
    target = new_folder(spark, "customer-detail")
    for _ in range(2):
        files.write_parquet(marts.customer_detail(_detail(spark, folder)), target)
    return comparable(spark.read.parquet(target))


def partitioned_mart_readback(spark, folder):
    """The sales-team detail written by month and store, and read back."""
    target = new_folder(spark, "sales-team-detail")
    files.write_partitioned(marts.sales_team_detail(_detail(spark, folder)), target)
    return comparable(spark.read.parquet(target)).withColumn("store_id", F.col("store_id").cast("bigint"))


def snapshot_versioned_readback(spark, folder):
    """Two versions of the customer detail, the second written twice."""
    target = new_folder(spark, "customer-detail")
    detail = marts.customer_detail(_detail(spark, folder))
    files.write_snapshot(detail, target, 1)
    for _ in range(2):
        files.write_snapshot(detail, target, 2)
    return comparable(spark.read.parquet(target)).select(
        files.RUN_COLUMN, "customer_id", "phone_number", "sales_date", "total_cost"
    )


def snapshot_partitioned_readback(spark, folder):
    """The sales-team detail as a version split by month and store."""
    target = new_folder(spark, "sales-team-versions")
    detail = marts.sales_team_detail(_detail(spark, folder))
    files.write_snapshot(detail, target, 1, by=files.SALES_PARTITIONS)
    version = spark.read.parquet(target).where(F.col(files.RUN_COLUMN) == 1).drop(files.RUN_COLUMN)
    return comparable(version)


def _ledger_events(spark, folder) -> DataFrame:
    """Ledger events out of the events table: a purchase ends what others begin."""
    return open_tables(spark, folder).table("events").select(
        F.concat(F.lit("sales_"), F.col("user_id").cast("string"), F.lit(".csv")).alias("file_name"),
        F.concat(F.lit("landing/"), F.col("event_type")).alias("file_location"),
        F.col("event_id").cast("string").alias("run_id"),
        F.when(F.col("event_type") == "purchase", DONE).otherwise(STARTED).alias("status"),
        F.col("ts").alias("event_time"),
    )


def ledger_unfinished(spark, folder):
    """Landed files (one per customer) that an earlier run left unfinished."""
    landed = open_tables(spark, folder).table("customer").select(
        F.concat(F.lit("sales_"), F.col("c_custkey").cast("string"), F.lit(".csv")).alias("file_name")
    )
    return ledger.unfinished(_ledger_events(spark, folder), landed)


def ledger_current_status(spark, folder):
    return ledger.file_states(_ledger_events(spark, folder)).select("file_name", "status")


def ledger_rows(spark, folder):
    """The ledger as a table that is updated when files are done."""
    rows = ledger.ledger_rows(_ledger_events(spark, folder))
    seconds = lambda name: F.substring(F.col(name).cast("string"), 1, 19).alias(name)
    return rows.select("file_name", "file_location", seconds("created_date"), seconds("updated_date"), "status")


def ledger_marked_files(spark, folder):
    """Landed files marked as started, and the accepted ones as done, in a ledger table."""
    _, verdicts = _checked(spark, folder)
    book = ledger.Ledger(spark, new_folder(spark, "ledger"))
    csv_files = verdicts.where(F.col("path").endswith(".csv"))
    book.mark(csv_files, STARTED, "run")
    book.mark(landing.require_accepted(verdicts), DONE, "run")
    return (
        ledger.ledger_rows(book.events())
        .select(deliveries.delivery_of(F.col("file_location")).alias("delivery"), "status")
        .distinct()
    )


def _database(spark) -> str:
    """URL of the database for the round trips, from ``spark.martweave.jdbc.url``.

    Local mode falls back to an embedded one in memory, which only this process
    sees and which therefore cannot serve a cluster.
    """
    url = spark.conf.get("spark.martweave.jdbc.url", None)
    if url is None:
        if not is_local(spark):
            raise RuntimeError("set spark.martweave.jdbc.url to a database that all executors reach")
        spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
        url = f"jdbc:derby:memory:martweave{uuid.uuid4().hex[:8]};create=true"
    return url


def jdbc_roundtrip_customer(spark, folder):
    """The customer dimension to a database table, twice, and back over several connections."""
    url, customer = _database(spark), open_tables(spark, folder).customer()
    for _ in range(2):
        jdbc_sink.rewrite_table(customer, url, "customer_dim", {})
    return comparable(jdbc_source.read_table(spark, url, "customer_dim", {}, "customer_id", connections=4))


def jdbc_mart_append(spark, folder):
    """The incentive mart appended to a new database table."""
    url, table = _database(spark), f"incentive_{uuid.uuid4().hex[:8]}"
    jdbc_sink.append_table(marts.sales_person_incentive(*_inputs(spark, folder)), url, table, {})
    return comparable(jdbc_source.read_table(spark, url, table, {}, "sales_person_id", connections=4))


def stream_pickup_count(spark, folder):
    """Two deliveries found by the stream, one run each; a third run finds nothing."""
    sales = open_tables(spark, folder).sales_fact()
    landed, checkpoint = new_folder(spark, "landing"), new_folder(spark, "pickup")
    target = new_folder(spark, "picked")

    def handle(paths, batch_id):
        accepted = landing.require_accepted(landing.check_files(spark, paths))
        files.write_snapshot(sales_csv.read_sales(spark, accepted), target, batch_id)

    early = "sales_date < '1998-01-01'"
    for part in (sales.where(early), _others(sales, early), None):
        if part is not None:
            deliveries.land_clean(part, landed)
        start_pickup(spark, landed, checkpoint, handle).awaitTermination()
    return comparable(
        spark.read.parquet(target)
        .groupBy(F.col(files.RUN_COLUMN).alias("pickup"))
        .agg(F.count(F.lit(1)).alias("sales"), F.sum("total_cost").alias("amount"))
    )


def recomputed_months(spark, folder):
    """Months that arrive in two deliveries: monthly totals over both."""
    sales, dims = _written_inputs(spark, folder, "line_status")
    store = MartStore(new_folder(spark, "marts"))
    for status, part in (("F", sales.where("line_status = 'F'")), ("O", _others(sales, "line_status = 'F'"))):
        batch.add_sales(spark, part, dims, store, f"run-{status}")
    return comparable(store.read(spark, "customer_monthly"))


def landed_sales_to_marts(spark, folder):
    """All sales as landed files through one batch run; the published incentive mart."""
    sales, dims = _inputs(spark, folder)
    landed = new_folder(spark, "landing")
    deliveries.land_clean(sales, landed)
    store = MartStore(new_folder(spark, "marts"))
    batch.run_batch(spark, landing.list_files(spark, landed), dims, store, "run")
    return comparable(store.read(spark, "sales_person_incentive"))


def unparsed_cells(spark, folder):
    """All sales as landed files, with quantities and amounts that are no numbers for two of the return flags: every such cell."""
    sales, dims = _inputs(spark, folder)
    text = lambda name: F.col(name).cast("string")
    spoiled = sales.withColumn(
        "quantity", F.when(F.col("return_flag") == "R", F.concat(F.lit("x"), text("quantity"))).otherwise(text("quantity"))
    ).withColumn("total_cost", F.when(F.col("return_flag") != "N", "n/a").otherwise(text("total_cost")))
    landed, store = new_folder(spark, "landing"), MartStore(new_folder(spark, "marts"))
    deliveries.land_named(spoiled, landed, "sales")
    batch.run_batch(spark, listing.file_table(spark, landed), dims, store, "run")
    cells = sales_csv.unparsed_cells(store.read(spark, "fact"))
    return comparable(cells.select("customer_id", "store_id", "sales_person_id", "sales_date", "column", "text"))


def extras_widened(spark, folder):
    """Sales in two deliveries whose extra columns differ in type: one whole and then fractional, one days and then times,
    one whole in both, one whole and then text."""
    sales, landed = open_tables(spark, folder).sales_fact(), new_folder(spark, "landing")
    early, extras = "sales_date < '1998-01-01'", ["units", "noted", "code", "label"]
    for name, part, values in (
        ("early", sales.where(early), ("quantity", "CAST(sales_date AS STRING)", "store_id", "quantity")),
        (
            "late",
            _others(sales, early),
            ("quantity + 0.5D", "concat(sales_date, ' 12:30:00')", "store_id", "concat('q', quantity)"),
        ),
    ):
        rows = part.withColumns({e: F.expr(v) for e, v in zip(extras, values, strict=True)})
        deliveries.land_named(rows, f"{landed}/{name}", "sales", [*MANDATORY_COLUMNS, *extras])
    accepted = landing.require_accepted(landing.check_files(spark, listing.file_table(spark, landed)))
    read = as_table(sales_csv.read_sales(spark, accepted, keep=("extra_map", "source_file")), "read")
    typed = widening.typed_extras(read, widening.widened(widening.candidates(read)))
    shown = typed.select("customer_id", "sales_person_id", "extras.*")
    return comparable(shown.withColumn("noted", F.date_format("noted", "yyyy-MM-dd HH:mm:ss")))


def landing_read_twice(spark, folder):
    """Two runs over one landing that keeps its files: every sale counts once."""
    sales, dims = _inputs(spark, folder)
    landed, store = new_folder(spark, "landing"), MartStore(new_folder(spark, "marts"))
    deliveries.land_clean(sales, landed)
    for run in ("day-1", "day-2"):
        batch.run_batch(spark, landing.list_files(spark, landed), dims, store, run)
    return comparable(store.read(spark, "sales_person_incentive"))


def redelivered_file_counts(spark, folder):
    """Files rewritten with other sales under the same names: both versions count."""
    sales, dims = _written_inputs(spark, folder)
    landed, store = new_folder(spark, "landing"), MartStore(new_folder(spark, "marts"))
    early = "sales_date < '1998-01-01'"
    for run, part in (("day-1", sales.where(early)), ("day-2", _others(sales, early))):
        deliveries.land_named(part, landed, "sales")
        batch.run_batch(spark, landing.list_files(spark, landed), dims, store, run)
    return comparable(store.read(spark, "sales_person_incentive"))


def _pick_up(spark, landed: str, checkpoint: str, dims: Dimensions, store: MartStore) -> None:
    def handle(paths, number):
        run = run_id_of(spark, checkpoint, number)
        batch.run_batch(spark, paths, dims, store, run, require_input=False)

    start_pickup(spark, landed, checkpoint, handle).awaitTermination()


def pickup_after_rejected_delivery(spark, folder):
    """All sales without a mandatory column, which are refused, and then all sales as they should be."""
    sales, dims = _written_inputs(spark, folder)
    landed, store = new_folder(spark, "landing"), MartStore(new_folder(spark, "marts"))
    checkpoint = new_folder(spark, "pickup")
    for name, columns in (("bad", [c for c in MANDATORY_COLUMNS if c != "store_id"]), ("good", MANDATORY_COLUMNS)):
        deliveries.land_named(sales, landed, name, columns)
        _pick_up(spark, landed, checkpoint, dims, store)
    return comparable(store.read(spark, "sales_person_incentive"))


def pickup_refuses_unreadable_files(spark, folder):
    """Two deliveries of all sales with a zero-byte file and a hidden one each, three pickups: what each run did with its files.

    Files of sales are shown by their sales, which the fact holds once; refused files by their reason, once each.
    """
    sales, dims = _written_inputs(spark, folder)
    landed, store = new_folder(spark, "landing"), MartStore(new_folder(spark, "marts"))
    checkpoint = new_folder(spark, "pickup")
    runs = []

    def handle(found, number):
        runs.append(run_id_of(spark, checkpoint, number))
        batch.run_batch(spark, found, dims, store, runs[-1], require_input=False)

    early = "sales_date < '1998-01-01'"
    for name, part in (("early", sales.where(early)), ("late", _others(sales, early)), (None, None)):
        if name:
            at = f"{landed}/{name}"
            deliveries.land_named(part, at, "sales")
            deliveries.land_named(part.limit(1), at, "_hidden", files=1)
            deliveries.land_empty(spark, at, "empty.csv")
        start_file_pickup(spark, landed, checkpoint, handle).awaitTermination()
    counted = store.read(spark, "fact").select(
        F.element_at(F.split("source_file", "/"), -2).alias("delivery"), F.lit("counted").alias("outcome"), F.lit(1).alias("n")
    )
    refused = spark.read.parquet(f"{store.quarantine}/reasons").select(
        F.element_at(F.split("path", "/"), -2).alias("delivery"), F.col("reason").alias("outcome"), F.lit(1).alias("n")
    )
    return counted.unionAll(refused).groupBy("delivery", "outcome").agg(F.sum("n").alias("rows"))


def pickup_with_new_checkpoint(spark, folder):
    """A second checkpoint that sees old and new files: old sales are neither erased nor counted again."""
    sales, dims = _written_inputs(spark, folder)
    landed, store = new_folder(spark, "landing"), MartStore(new_folder(spark, "marts"))
    early = "sales_date < '1998-01-01'"
    for part in (sales.where(early), _others(sales, early)):
        deliveries.land_clean(part, landed)
        _pick_up(spark, landed, new_folder(spark, "pickup"), dims, store)
    return comparable(store.read(spark, "sales_person_incentive"))


def rerun_moves_months(spark, folder):
    """A run that did not finish, repeated with sales in other months: the first months go."""
    sales, dims = _written_inputs(spark, folder)
    landed, store = new_folder(spark, "landing"), MartStore(new_folder(spark, "marts"))

    class Lost(RuntimeError):
        pass

    def lose(_):
        raise Lost

    deliveries.land_named(sales.withColumn("sales_date", F.add_months("sales_date", 240)), landed, "sales")
    try:
        batch.run_batch(spark, landing.list_files(spark, landed), dims, store, "run", publish=lose)
    except Lost:
        pass
    deliveries.land_named(sales, landed, "sales")
    batch.run_batch(spark, landing.list_files(spark, landed), dims, store, "run")
    return comparable(store.read(spark, "customer_monthly"))


def concurrent_runs_count_once(spark, folder):
    """A run over all files during which two others finish, one over some of these files and one over a later delivery."""
    sales, dims = _written_inputs(spark, folder)
    landed, store = new_folder(spark, "landing"), MartStore(new_folder(spark, "marts"))
    early, late = "sales_date < '1997-01-01'", "sales_date >= '2000-01-01'"
    middle = _others(sales, f"({early}) OR ({late})")
    deliveries.land_named(sales.where(early), landed, "early")
    shared = landing.list_files(spark, landed)
    deliveries.land_named(middle, landed, "middle")
    begun = []

    def others_are_faster(_):
        if not begun:
            begun.append(True)
            batch.run_batch(spark, shared, dims, store, "second")
            deliveries.land_named(sales.where(late), landed, "late")
            new = [p for p in landing.list_files(spark, landed) if "/late-" in p]
            batch.run_batch(spark, new, dims, store, "third")

    batch.run_batch(spark, landing.list_files(spark, landed), dims, store, "first", publish=others_are_faster)
    return comparable(store.read(spark, "sales_person_incentive"))


def abandoned_run_is_invisible(spark, folder):
    """Sales of half the stores, published; a run over all others that dies before its commit; the marts as readers see them."""
    sales, dims = _written_inputs(spark, folder)
    landed, store = new_folder(spark, "landing"), MartStore(new_folder(spark, "marts"))

    class Lost(RuntimeError):
        pass

    def lose(_):
        raise Lost

    for name, part, publish in (("even", "store_id % 2 = 0", None), ("odd", "store_id % 2 = 1", lose)):
        deliveries.land_named(sales.where(part), f"{landed}/{name}", "sales")
        try:
            paths = landing.list_files(spark, f"{landed}/{name}")
            batch.run_batch(spark, paths, dims, store, name, publish=publish)
        except Lost:
            pass
    return comparable(store.read(spark, "sales_team_detail").drop(files.RUN_COLUMN))


def replaced_files_retract(spark, folder):
    """All sales at wrong amounts and dates, then half the files anew as they should be, then the others: only the last count."""
    sales, dims = _written_inputs(spark, folder)
    landed, store = new_folder(spark, "landing"), MartStore(new_folder(spark, "marts"))
    wrong = sales.withColumn("total_cost", F.col("total_cost") + 1).withColumn("sales_date", F.add_months("sales_date", 3))
    early = "sales_date < '1998-01-01'"
    deliveries.land_named(wrong.where(early), f"{landed}/early", "sales")
    deliveries.land_named(_others(wrong, early), f"{landed}/late", "sales")
    batch.run_batch(spark, landing.list_files(spark, landed), dims, store, "day-1")
    for run, part in (("early", sales.where(early)), ("late", _others(sales, early))):
        deliveries.land_named(part, f"{landed}/{run}", "sales")
        batch.run_batch(spark, landing.list_files(spark, landed), dims, store, run, redelivered=batch.REPLACE)
    detail = marts.sales_person_incentive_of_detail(store.read(spark, "sales_team_detail").drop(files.RUN_COLUMN))
    mart = store.read(spark, "sales_person_incentive")
    return comparable(mart.intersectAll(detail.select(*mart.columns)))


def totals_merged_over_deliveries(spark, folder):
    """Customer totals of five deliveries that share their months, each merged into the sums of those before it."""
    sales, dims = _written_inputs(spark, folder)
    store = MartStore(new_folder(spark, "marts"))
    fifth = F.pmod(F.hash("customer_id", "store_id", "sales_date", "total_cost"), F.lit(5))
    for i in range(5):
        batch.add_sales(spark, sales.where(fifth == i), dims, store, f"delivery-{i}")
    return comparable(store.read(spark, "customer_monthly"))


def month_loses_partners(spark, folder):
    """Sales of one nation's customers in months of their own, which go when the dimension loses these customers."""
    tables = open_tables(spark, folder)
    sales, dims = _inputs(spark, folder)
    leaving = tables.customer().where("pincode = '3'").select(F.col("customer_id").alias("leaving"))
    moved = F.when(F.col("leaving").isNull(), F.col("sales_date")).otherwise(F.add_months("sales_date", 240))
    sales = sales.join(leaving, F.col("customer_id") == F.col("leaving"), "left").withColumn("sales_date", moved)
    landed, store = new_folder(spark, "landing"), MartStore(new_folder(spark, "marts"))
    deliveries.land_clean(sales, landed)
    batch.run_batch(spark, landing.list_files(spark, landed), dims, store, "run")
    months = store.read(spark, "fact").select("sales_month").distinct()
    staying = Dimensions(tables.customer().where("pincode <> '3'"), tables.store(), tables.sales_team())
    batch.recompute_months(spark, months, staying, store)
    return comparable(store.read(spark, "customer_monthly"))


def dimensions_from_database(spark, folder):
    """The incentive mart with all three dimensions read from a database."""
    tables, url = open_tables(spark, folder), _database(spark)
    for name, rows in (("customer", tables.customer()), ("store", tables.store()), ("sales_team", tables.sales_team())):
        jdbc_sink.rewrite_table(rows, url, name, {})
    dims = jdbc_source.read_dimensions(spark, url, {})
    return comparable(marts.sales_person_incentive(tables.sales_fact(), dims))


def stream_pickup_archived(spark, folder):
    """Three pickups that archive what they have handed over: landing and archive hold all sales."""
    sales = open_tables(spark, folder).sales_fact()
    landed, archive, checkpoint = (new_folder(spark, n) for n in ("landing", "archive", "pickup"))
    early = "sales_date < '1998-01-01'"
    for part in (sales.where(early), _others(sales, early), None):
        if part is not None:
            deliveries.land_clean(part, landed)
        start_pickup(spark, landed, checkpoint, lambda paths, number: None, archive=archive).awaitTermination()
    lines = spark.read.option("recursiveFileLookup", "true").option("header", "true").csv([landed, archive])
    return lines.agg(
        F.count(F.lit(1)).alias("sales"), F.sum(F.col("total_cost").cast("decimal(18,2)")).cast("double").alias("amount")
    )


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        fact_conform,
        fact_enrich,
        fact_enrich_hot_customer,
        customer_detail_mart,
        sales_team_detail_mart,
        sales_person_monthly_total,
        sales_person_rank,
        sales_person_incentive,
        sales_person_incentive_of_detail,
        sales_person_incentive_two_names,
        customer_monthly_mart,
        customer_monthly_mart_two_names,
        customer_monthly_mart_windowed,
        header_verdicts,
        landed_file_kinds,
        quarantined_lines,
        extras_folded,
        extras_by_name,
        union_by_name_batches,
        parquet_mart_readback,
        partitioned_mart_readback,
        snapshot_versioned_readback,
        snapshot_partitioned_readback,
        ledger_unfinished,
        ledger_current_status,
        ledger_rows,
        ledger_marked_files,
        jdbc_roundtrip_customer,
        jdbc_mart_append,
        stream_pickup_count,
        recomputed_months,
        landed_sales_to_marts,
        unparsed_cells,
        extras_widened,
        landing_read_twice,
        redelivered_file_counts,
        pickup_after_rejected_delivery,
        pickup_refuses_unreadable_files,
        pickup_with_new_checkpoint,
        rerun_moves_months,
        month_loses_partners,
        concurrent_runs_count_once,
        abandoned_run_is_invisible,
        replaced_files_retract,
        totals_merged_over_deliveries,
        quarantined_files_of_one_name,
        dimensions_from_database,
        stream_pickup_archived,
    )
}
