"""Chosen steps in order: feeds into staging tables, side by side, staging tables into the star, reports out of it (B38, QG).

A step that fails is reported and does not stop the others. Every step can be repeated: merges by key
give the same tables again.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from copy import copy
from dataclasses import dataclass
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.feeds import cash, couriers, pos, sheets, shopee, tiktok
from orderloom.operators import quality
from orderloom.operators.merge import apply_feeds, fold_feeds, upsert
from orderloom.operators.relational import delete_keys, union_all
from orderloom.operators.tracking import LOG_SCHEMA, stamp, watermarks
from orderloom.operators.verdicts import Inspection
from orderloom.plans import partials, reports, star
from orderloom.schemas import LAKE, LAKE_KEYS, LAKE_MODES, STAR, STAR_KEYS, STAR_REFERENCES, TEXT_LIMITS, conform
from orderloom.sources.landed import read_grid, read_landed_json, read_landed_table, table_from_grid, with_header_cells
from orderloom.sources.manifest import Manifest, paths_of
from orderloom.sources.store import TableStore
from orderloom.staged import Staged

Frames = dict[str, DataFrame]


class Run:
    """One run: a stamp, a store, and the places the feeds land in.

    paths   step -> list of sources; a source is a dict of landed paths and of what describes them (account, shop)
    params  start, end (unconfirmed orders of that range are loaded anew), year (of return scans), report parameters,
            multiline (cells of landed sheets hold line breaks)
    """

    def __init__(self, spark: SparkSession, store: TableStore, paths: dict[str, list[dict]], run_ts: datetime,
                 params: dict | None = None):
        self.spark, self.store, self.paths, self.run_ts, self.params = spark, store, paths, run_ts, params or {}
        self.multiline = bool(self.params.get("multiline", False))

    def table(self, path, columns, **options) -> DataFrame:
        return read_landed_table(self.spark, path, list(columns), **{"multiline": self.multiline, **options})

    inspect: Inspection  # of the source at work

    def workbook(self, path, columns, skip_rows: int, tokens: tuple = (), **tags) -> DataFrame:
        grid = read_grid(self.spark, path, path_tokens=tokens, multiline=self.multiline)
        return table_from_grid(grid, list(columns), skip_rows=skip_rows, **tags)

    def json(self, path, schema, key: str | None = None) -> DataFrame:
        return read_landed_json(self.spark, path, schema, key)


def _ghtk(run: Run, src: dict) -> Frames:
    tags = {"source": "Giao Hang Tiet Kiem", "account": src["account"]}
    tokens = tuple(src.get("tokens", ("ghtk",)))
    more = {}
    if src.get("cancelled"):
        more["cancelled"] = run.workbook(src["cancelled"], couriers.GHTK_PARCELS, 15, tokens)
    if src.get("compensations"):
        more["compensations"] = run.workbook(src["compensations"], couriers.GHTK_COMPENSATIONS, 0, tokens)
    return {"deliveryorders": couriers.clean_ghtk_parcels(
        run.workbook(src["parcels"], couriers.GHTK_PARCELS, 15, tokens, **tags),
        run.workbook(src["payments"], couriers.GHTK_PAYMENTS, 10, tokens), **more)}


def _ghn(run: Run, src: dict) -> Frames:
    tokens = tuple(src.get("tokens", ("ghn",)))
    return {"deliveryorders": couriers.clean_ghn_parcels(
        run.workbook(src["parcels"], couriers.GHN_PARCELS, 0, tokens, source="Giao Hang Nhanh", account=src["account"]),
        run.workbook(src["coins"], couriers.GHN_COINS, 2, tokens), run.inspect)}


def _jte(run: Run, src: dict) -> Frames:
    return {"deliveryorders": couriers.clean_jte_parcels(run.workbook(
        src["parcels"], couriers.JTE_PARCELS, 0, ("jte",), source="JT Express", account=src["account"]))}


def _spx(run: Run, src: dict) -> Frames:
    return {"deliveryorders": couriers.clean_spx_parcels(run.workbook(
        src["parcels"], couriers.SPX_PARCELS, 3, ("spx",), source="SPX Express", account=src["account"]), run.inspect)}


def _self_delivery(run: Run, src: dict) -> Frames:
    return {"deliveryorders": couriers.clean_self_delivery(run.table(src["sheet"], couriers.SELF_DELIVERY), run.inspect)}


def _customer_bank(run: Run, src: dict) -> Frames:
    return {"customerbanks": sheets.clean_customer_bank(run.table(src["sheet"], sheets.CUSTOMER_BANK), inspect=run.inspect)}


def _catalogue(run: Run, src: dict) -> Frames:
    return {"dim_product": sheets.clean_catalogue(run.table(src["sheet"], sheets.CATALOGUE), src.get("minimum", 1000), run.inspect)}


def _return_scans(run: Run, src: dict) -> Frames:
    return {"returnedorders_scan": sheets.clean_return_scans(
        run.table(src["sheet"], sheets.RETURN_SCANS), run.params["year"])}


def _delivery_scans(run: Run, src: dict) -> Frames:
    return {"handle_deliveryorders": sheets.clean_delivery_scans(run.table(src["sheet"], sheets.DELIVERY_SCANS))}


def _handling_notes(run: Run, src: dict) -> Frames:
    return {"handle_deliveryorders": sheets.clean_handling_notes(
        *[run.table(path, sheets.HANDLING_NOTES) for path in src["sheets"]], inspect=run.inspect)}


def _jte_cash(run: Run, src: dict) -> Frames:
    rows = run.table(src["folder"], cash.JTE_CASH, path_tokens=("jte",), bad_path="skip", mark=True)
    return {"delivery_reconciliation": cash.clean_jte_cash(rows, run.run_ts.date(), run.inspect)}


def _spx_cash(run: Run, src: dict) -> Frames:
    return {"delivery_reconciliation": cash.clean_spx_cash(
        run.table(src["folder"], cash.SPX_CASH, path_tokens=("spx",), bad_path="skip", mark=True), run.inspect)}


def _ghn_cash(run: Run, src: dict) -> Frames:
    grid = read_grid(run.spark, src["folder"], path_tokens=("ghn",), bad_path="skip", multiline=run.multiline, mark=True)
    rows = with_header_cells(table_from_grid(grid, list(cash.GHN_CASH), skip_rows=20), grid, cash.GHN_CASH_CELLS)
    return {"delivery_reconciliation": cash.clean_ghn_cash(rows, run.run_ts.date(), run.inspect)}


def _ghn_coin_moves(run: Run, src: dict) -> Frames:
    grid = read_grid(run.spark, src["folder"], path_tokens=("ghn",), bad_path="skip", multiline=run.multiline, mark=True)
    rows = table_from_grid(grid, list(cash.GHN_COIN_MOVES), skip_rows=2)
    return {"delivery_reconciliation": cash.clean_ghn_coin_moves(rows, run.run_ts.date(), run.inspect)}


def _tiktok_income(run: Run, src: dict) -> Frames:
    rows = run.table(src["folder"], tiktok.INCOME.values(), exclude_name_chars="")
    return {"tiktok_reconciliation": tiktok.clean_tiktok_income(rows)}


def _pos(run: Run, src: dict) -> Frames:
    orders = run.json(src["orders"], pos.SCHEMA, "info.id")
    # A map of two columns has its order from the file; one file of a map is read by one task.
    place = F.coalesce(F.col("seq").cast("bigint"), F.monotonically_increasing_id()).alias("seq")
    maps = {name: run.spark.read.schema("code STRING, label STRING, seq INT").option("header", True).csv(path).select("code", "label", place)
            for name, path in (src.get("maps") or {}).items()}
    return {"nhanhvnorders": pos.clean_pos_orders(orders, maps), "nhanhvnorderdetails": pos.clean_pos_lines(orders)}


def _shopee(run: Run, src: dict) -> Frames:
    orders, escrows = run.json(src["orders"], shopee.ORDERS, "order_sn"), run.json(src["escrows"], shopee.ESCROWS, "order_sn")
    return {
        "shopeeorders": shopee.clean_shopee_orders(
            orders, escrows, run.json(src["trackings"], shopee.TRACKINGS), src["shop"]),
        "shopeeorderdetails": shopee.clean_shopee_lines(orders, escrows),
        "delivery_reconciliation": shopee.clean_shopee_income(run.json(src["incomes"], shopee.INCOMES)),
    }


def _tiktok(run: Run, src: dict) -> Frames:
    orders = run.json(src["orders"], tiktok.ORDERS)
    return {
        "tiktokorders": tiktok.clean_tiktok_orders(orders, run.json(src["returns"], tiktok.RETURNS), src["shop"]),
        "tiktokorderdetails": tiktok.clean_tiktok_lines(orders),
    }


FEEDS: dict[str, Callable[[Run, dict], Frames]] = {
    "ghtk": _ghtk, "ghn": _ghn, "jte": _jte, "spx": _spx, "self_delivery": _self_delivery,
    "customer_bank": _customer_bank, "catalogue": _catalogue, "return_scans": _return_scans,
    "delivery_scans": _delivery_scans, "handling_notes": _handling_notes, "jte_cash": _jte_cash, "spx_cash": _spx_cash,
    "ghn_cash": _ghn_cash, "ghn_coin_moves": _ghn_coin_moves, "tiktok_income": _tiktok_income, "pos": _pos,
    "shopee": _shopee, "tiktok": _tiktok,
}


def contract(table: str, keys: list[str]) -> dict[str, Column]:
    """What no row of a table may be: without a key, or with a text longer than its column."""
    return {**{f"{table}.{k} is missing": F.col(k).isNull() for k in keys},
            **{f"{table}.{c} is longer than {n}": F.length(c) > n for c, n in TEXT_LIMITS.get(table, {}).items()}}


def load(store: TableStore, table: str, rows: DataFrame, run_ts: datetime) -> DataFrame:
    """Merge cleaned rows into their table under the rule of that table. A row that breaks the table's contract fails the merge."""
    rows = quality.fail_rows(rows, contract(table, {**LAKE_KEYS, **STAR_KEYS}[table]))
    order = "row_no" if "row_no" in rows.columns else None
    if table == "dim_product":
        return store.merge(table, rows, lambda t, s: upsert(t, s, STAR_KEYS[table], stamp_col=None, order_col=order))
    stamped = stamp(rows, run_ts)
    return store.merge(
        table, stamped, lambda t, s: upsert(t, s, LAKE_KEYS[table], mode=LAKE_MODES[table], order_col=order))


def forget_unconfirmed(store: TableStore, start: datetime, end: datetime) -> None:
    """Drop unconfirmed orders of a date range, lines first, so that they are loaded anew (M9)."""
    orders = store.read("nhanhvnorders")
    doomed = orders.filter(F.col("orderstatus").isin(*star.UNCONFIRMED) & F.col("created_at").between(
        F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))).select("orderid")
    for table in ("nhanhvnorderdetails", "nhanhvnorders"):
        store.merge(table, doomed, lambda t, s: delete_keys(t, s, "orderid"))


def read_log(store: TableStore) -> DataFrame:
    """Marks of all past runs; none before the first."""
    return store.spark.read.schema(LOG_SCHEMA).parquet(_log_path(store))


def _log_path(store: TableStore) -> str:
    path = f"{store.root}/dwtable_updatetime_log"
    jvm_path = store.spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(store.spark._jsc.hadoopConfiguration()).mkdirs(jvm_path)
    return path


class State(dict):
    """What became of each step of a run (name -> "ok", "off", "unchanged" or "failed: ..."), and what its rows showed.

    found   step -> reason or doubt -> rows; for the star, problem -> rows
    files   step -> files left out because of a row in them
    """

    def __init__(self):
        super().__init__()
        self.found: dict[str, dict[str, int]] = {}
        self.files: dict[str, list[str]] = {}


def read_rejects(store: TableStore) -> DataFrame:
    """Rejected rows of all runs: source_file, row_no, reasons, cells (JSON), run, feed, source."""
    path = f"{store.root}/_rejects"
    return store.spark.read.schema("source_file STRING, row_no BIGINT, reasons ARRAY<STRING>, cells STRING, run STRING, feed STRING, source STRING, part INT").parquet(path).drop("part")


def star_problems(store: TableStore, fact: DataFrame) -> dict[str, int]:
    """References of fact rows that no dimension holds, counted in one pass over narrow rows (QH). Only partitions with a referenced key are read."""
    counts = [quality.dangling(fact, col, store.reach(dim, fact, {key: col}), key).select(F.lit(f"{col} not in {dim}").alias("problem"))
              for col, (dim, key) in STAR_REFERENCES.items()]
    return {r.problem: r["count"] for r in union_all(*counts).groupBy("problem").count().collect()}


def refresh_star(store: TableStore, *, by_order: bool = True, found: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """Bring the star up to date with the staging tables; only partitions with changes are rewritten, and read beyond their keys."""
    with Staged(store.spark) as stage:
        _refresh(store, stage, by_order, {} if found is None else found)
    return {name: store.read(name) for name in STAR}


def _refresh(store: TableStore, stage: Staged, by_order: bool, found: dict[str, int]) -> None:
    log, seen = read_log(store), store.marks()  # what is written from here on is news for the next run
    lake = {name: store.read(name) for name in LAKE}
    old = {name: store.read(name) for name in STAR}

    def merge(name: str, feeds: star.Feeds) -> DataFrame:
        keys = STAR_KEYS[name]
        return store.merge(name, fold_feeds(feeds, keys), lambda t, s: conform(apply_feeds(t, s, keys), name), stage)

    tables = star.build_star(lake, old, watermarks(log), by_order=by_order, only_touched=True, stage=stage, merge=merge, reach=store.reach)
    fact = stage(quality.fail_rows(tables["fact_orderdetails"], contract("fact_orderdetails", STAR_KEYS["fact_orderdetails"])))
    found |= star_problems(store, fact)
    store.merge("fact_orderdetails", fact, lambda t, s: upsert(t, s, STAR_KEYS["fact_orderdetails"], stamp_col=None))
    # The marks move last: a run that dies before is repeated from the old ones.
    after = star.advance_log(log, {**{n: seen.get(n) for n in LAKE}, "fact and dim tables": store.marks().get("fact_orderdetails")})
    delete_keys(after, log, ["dwtable_name", "updatetime"]).coalesce(1).write.mode("append").parquet(_log_path(store))


def _fresh_source(job: Run, step: str, label: str, source: dict, stage: Staged) -> tuple[dict | None, DataFrame]:
    """The source as far as it has news, None if it has none, and the files that make the news.

    The files of a folder stand for themselves, so only new and changed ones are read; other sources are read whole if one of their files changed.
    """
    manifest = Manifest(job.spark, job.store.root, step, label)
    files = stage(manifest.fresh(paths_of(source)))
    if files.isEmpty():
        return None, files
    if "folder" in source:
        source = {**source, "folder": sorted(r.path for r in files.select("path").collect())}  # names of files to be read now
    return source, files


@dataclass
class Prepared:
    """A cleaned source, written aside."""

    stage: Staged
    ready: Frames
    files: DataFrame | None = None
    unchanged: bool = False


def _prepare(job: Run, step: str, label: str, source: dict, inspect: Inspection, stage: Staged) -> Prepared:
    job = copy(job)
    job.inspect = inspect
    job.spark.sparkContext.setLocalProperty("spark.scheduler.pool", step)  # with a fair scheduler, feeds share the cluster
    files = None
    if job.params.get("only_new"):
        fresh, files = _fresh_source(job, step, label, source, stage)
        if fresh is None:
            return Prepared(stage, {}, files, unchanged=True)
        source = fresh
    # All rows of a source are cleaned and written aside before its first table is touched.
    return Prepared(stage, {table: stage(rows) for table, rows in FEEDS[step](job, source).items()}, files)


def run(steps: list[str], spark: SparkSession, store: TableStore, paths: dict[str, list[dict]], run_ts: datetime,
        params: dict | None = None) -> State:
    """Run the chosen steps (names of FEEDS, then 'star', 'reports') in the given order; give the state of each, with what was rejected or doubtful.

    Feeds that follow one another are read and cleaned side by side, params["parallel"] at a time (4); their tables are merged in the given order, since
    two feeds may write one table. 'star' and 'reports' wait for all before them. params["only_new"]: files that were loaded before and have not
    changed are not read; a source without others is "unchanged". params["partials"]: after the star, count the report partials of the months it wrote anew.
    """
    job = Run(spark, store, paths, run_ts, params)
    state = State()

    def failed(name: str, error: Exception, written: list[str]) -> None:
        warnings.warn(f"{name} failed; tables loaded before the error: {', '.join(written) or 'none'}: {error}", stacklevel=3)
        state[name] = f"failed: {type(error).__name__}"

    def attempt(name: str, action: Callable[[], object]) -> None:
        try:
            action()
            state[name] = "ok"
        except Exception as error:
            failed(name, error, [])

    def finish(step: str, label: str, name: str, work: Future, stage: Staged) -> None:
        written: list[str] = []
        try:
            prepared = work.result()
            for table, rows in prepared.ready.items():
                load(store, table, rows, run_ts)
                written.append(table)
            if prepared.files is not None and not prepared.unchanged:
                Manifest(spark, store.root, step, label).add(prepared.files)
            state[name] = "unchanged" if prepared.unchanged else "ok"
        except Exception as error:
            failed(name, error, written)
        finally:
            stage.drop()

    def feeds(batch: list[str]) -> None:
        with ThreadPoolExecutor(job.params.get("parallel", 4)) as pool:
            waiting = []
            for step in batch:
                for i, source in enumerate(paths.get(step, [])):
                    label = str(source.get("account") or source.get("shop") or i)
                    name, stage = f"{step}/{label}", Staged(spark)
                    inspect = Inspection(stage, f"{store.root}/_rejects", step, label, run_ts)
                    state.found[name], state.files[name] = inspect.found, inspect.files
                    waiting.append((step, label, name, pool.submit(inheritable_thread_target(spark)(_prepare), job, step, label, source, inspect, stage), stage))
            forgotten = "ok"
            for step, label, name, work, stage in waiting:
                if step == "pos" and "pos/forget_unconfirmed" not in state and {"start", "end"} <= job.params.keys():
                    attempt("pos/forget_unconfirmed", lambda: forget_unconfirmed(store, job.params["start"], job.params["end"]))
                    forgotten = state["pos/forget_unconfirmed"]
                if step == "pos" and forgotten != "ok":
                    work.cancel() or work.exception()
                    stage.drop()
                    continue
                finish(step, label, name, work, stage)

    batch: list[str] = []
    for step in [*steps, None]:
        if step is not None and step not in ("star", "reports"):
            batch.append(step)
            continue
        feeds(batch)
        batch = []
        if step == "star":
            store.written.pop("fact_orderdetails", None)
            attempt(step, lambda: refresh_star(store, found=state.found.setdefault("star", {})))
            if job.params.get("partials") and state["star"] == "ok":
                changed = store.written.get("fact_orderdetails", []) if store.there("report_partials") else None
                attempt("partials", lambda: partials.refresh(store, changed))
        elif step == "reports":
            tables = {name: store.read(name) for name in STAR}
            source = paths["reports"][0]
            done = reports.run_report_catalogue(spark, tables, spark.read.json(source["catalogue"]), job.params, source["out"])
            state.update({f"reports/{name}": text for name, text in done.items()})
    return state
