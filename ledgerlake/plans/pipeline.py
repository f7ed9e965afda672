"""Runs the registered tables: as one lazy plan, or layer by layer through stored snapshots."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.operators import interface, quality
from ledgerlake.plans import snapshots
from ledgerlake.plans.registry import (
    PUBLISHED,
    REGISTRY,
    Options,
    TableSpec,
    order_of,
    stored_schema,
)
from ledgerlake.session import build_session, shuffles_dropped, sized_for
from ledgerlake.sources import files, jdbc, sample

log = logging.getLogger(__name__)

#: Tables stored at the same time where none needs another.
TABLES_AT_ONCE = 4
#: Stored bytes of the inputs that one part of a table is made from, and parts at most: every part
#: reads the inputs again, so their number must not grow with the input.
PART_BYTES = 3 << 30
MOST_PARTS = 8

Source = Callable[[str], DataFrame]


def jdbc_source(
    spark: SparkSession,
    connection: jdbc.JdbcConnection,
    num_partitions: int | None = None,
    equal_rows: bool = False,
) -> Source:
    def extract(table: str) -> DataFrame:
        spec = REGISTRY[table]
        how = {"equal_rows": True} if equal_rows else {}
        rows = jdbc.read_jdbc(
            spark, connection, spec.jdbc_table, spec.jdbc_partition_column, num_partitions, **how
        )
        return schemas.conform(rows, table)

    return extract


def parquet_source(spark: SparkSession, directory: str) -> Source:
    return lambda table: files.read_parquet_table(spark, directory, table)


def tbl_source(spark: SparkSession, directory: str) -> Source:
    return lambda table: files.read_tbl(spark, f"{directory.rstrip('/')}/{table}.tbl", table)


def sample_source(spark: SparkSession, directory: str) -> Source:
    return lambda table: sample.load(spark, directory, table)


def build(
    target: str, source: Source, options: Options = Options(), run_ts: datetime | None = None
) -> DataFrame:
    """The target as readers see it, as one lazy plan over the source; nothing is stored."""
    run_ts = run_ts or datetime.now(timezone.utc)
    tables: dict[str, DataFrame] = {}
    for spec in order_of(target, direct=True):
        make = spec.direct or spec.transform
        computed = make(tables, options) if make else source(spec.name)
        stamped = snapshots.stamp(computed, run_ts)
        tables[spec.name] = spec.published(stamped, internal=spec.name != target)
    return tables[target]


def read_table(
    spark: SparkSession, root: str, name: str, internal: bool = False, **how
) -> DataFrame:
    """A stored table as readers see it; ``how`` goes to ``snapshots.read``.

    ``internal`` adds the columns that only other tables need.
    """
    spec = REGISTRY[name]
    schema = None if how.get("merge_schema") else stored_schema(spark, name)
    return spec.published(snapshots.read(spark, spec.path(root), schema, **how), internal)


def run_table(
    spark: SparkSession,
    spec: TableSpec,
    computed: DataFrame,
    root: str,
    run_ts: datetime,
    keep: int = 1,
    rebalance: bool = False,
    compact: bool = False,
    fmt: str = "parquet",
    suites: dict[str, quality.Suite] | None = None,
    results_path: str | None = None,
    cluster: dict[str, tuple[str, ...]] | None = None,
    more: Sequence[DataFrame] = (),
) -> None:
    """Stage, check what was staged, put it in place, and only then drop older snapshots.

    One job reads the source, counts what the checks need and writes; what is checked is what is
    stored, and it is not read again. ``rebalance`` evens out the
    files of source tables, whose task sizes the source decides. ``cluster`` names, per table, the
    columns whose filters shall skip files; their quantiles take one more pass. ``keep`` snapshots
    stay. ``more`` are the table's further parts, for plain files.
    """
    path, even = spec.path(root), rebalance and spec.transform is None
    if snapshots.is_file_format(fmt):
        watched = quality.watched(spec.name, suites)
        by = (cluster or {}).get(spec.name, ())
        staged = snapshots.stage(computed, path, fmt, even, watched.watch, by, more)
        rows = spark.read.format(fmt).schema(computed.drop(schemas.STAMP).schema).load(staged)
        try:
            stamped = snapshots.stamp(rows, run_ts)
            quality.validate(stamped, spec.name, run_ts, suites, results_path, watched)
        except Exception:
            snapshots.discard(spark, staged)
            raise
        snapshots.install(spark, staged, path, snapshots.micros(run_ts))
    else:
        stamped = snapshots.stamp(computed, run_ts)
        quality.validate(stamped, spec.name, run_ts, suites, results_path)
        snapshots.write_snapshot(computed, path, run_ts, even, fmt)
    if compact:
        snapshots.compact(spark, path, stored_schema(spark, spec.name), fmt=fmt)
    if snapshots.is_file_format(fmt):
        snapshots.retain(spark, path, keep)


def run(
    spark: SparkSession,
    target: str,
    source: Source,
    root: str,
    options: Options = Options(),
    run_upstream: bool = True,
    persist: bool = True,
    run_ts: datetime | None = None,
    fmt: str = "parquet",
    **table_options,
) -> DataFrame:
    """Compute ``target`` and return it as readers see it.

    ``persist`` stores every table on the way, each once and all with one stamp, and each
    reads its inputs back from storage. Without ``run_upstream`` only the target is computed,
    from the stored inputs. ``persist=False`` composes one lazy plan instead.
    """
    run_ts = run_ts or datetime.now(timezone.utc)
    if persist:
        tables = order_of(target) if run_upstream else [REGISTRY[target]]
        _store(spark, tables, source, root, options, run_ts, fmt, **table_options)
        return read_table(spark, root, target, fmt=fmt)
    if run_upstream:
        return build(target, source, options, run_ts)
    spec = REGISTRY[target]
    computed = _compute(spark, spec, source, root, options, fmt)
    return spec.published(snapshots.stamp(computed, run_ts))


def _compute(
    spark: SparkSession, spec: TableSpec, source: Source, root: str, options: Options, fmt: str
) -> DataFrame:
    """The table from its stored inputs, or from the source."""
    if spec.transform is None:
        return source(spec.name)
    inputs = {u: read_table(spark, root, u, internal=True, fmt=fmt) for u in spec.upstream}
    return spec.transform(inputs, options)


def _parts(
    spark: SparkSession, spec: TableSpec, source: Source, root: str, options: Options, fmt: str
) -> list[DataFrame]:
    """The table in parts to be stored one after the other, of which each shuffles its share."""
    size = sum(snapshots.newest_bytes(spark, REGISTRY[u].path(root)) for u in spec.parted_by)
    n = min(MOST_PARTS, max(1, -(-size // PART_BYTES)))
    if n == 1:
        return [_compute(spark, spec, source, root, options, fmt)]
    inputs = {u: read_table(spark, root, u, internal=True, fmt=fmt) for u in spec.upstream}

    def part(i: int) -> DataFrame:
        own = {u: inputs[u].filter(F.pmod(F.xxhash64(c), F.lit(n)) == i)
               for u, c in spec.parted_by.items()}
        return spec.transform(inputs | own, options)

    return [part(i) for i in range(n)]


def _store(
    spark: SparkSession,
    tables: list[TableSpec],
    source: Source,
    root: str,
    options: Options,
    run_ts: datetime,
    fmt: str,
    **table_options,
) -> None:
    """Store the tables; those that do not need each other at the same time.

    A small table leaves most of a cluster idle, so the next ones start beside it. Shuffle files
    go with the job that wrote them, and large joins run in parts, so that disk holds the tables
    and little else.
    """
    clustered = table_options.get("cluster") or {}

    def store(spec: TableSpec) -> None:
        log.info("writing %s", spec.name)
        if spec.parted_by and snapshots.is_file_format(fmt) and spec.name not in clustered:
            computed, *more = _parts(spark, spec, source, root, options, fmt)
        else:
            computed, more = _compute(spark, spec, source, root, options, fmt), []
        run_table(spark, spec, computed, root, run_ts, fmt=fmt, more=more, **table_options)

    waiting = {spec.name: spec for spec in tables}
    with shuffles_dropped(spark), ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        while waiting:
            ready = [s for s in waiting.values() if not waiting.keys() & set(s.upstream)]
            for done in [pool.submit(store, spec) for spec in ready]:
                done.result()
            for spec in ready:
                del waiting[spec.name]


def publish(
    spark: SparkSession, name: str, root: str, options: Options = Options(), fmt: str = "parquet"
) -> DataFrame:
    """Publish an output from the stored tables, under its folder and its catalog name."""
    output = PUBLISHED[name]
    inputs = {u: read_table(spark, root, u, fmt=fmt) for u in output.upstream}
    made = output.make(inputs, options)
    name_of = (output.schema, output.table)
    published = spark.read.format(fmt).load(
        interface.publish(made, output.path(root), fmt, name_of)
    )
    log.info("%s.%s: %d rows", output.schema, output.table, published.count())
    return published


def run_published(
    spark: SparkSession,
    names: list[str],
    source: Source,
    root: str,
    options: Options = Options(),
    run_ts: datetime | None = None,
    fmt: str = "parquet",
    **table_options,
) -> dict[str, DataFrame]:
    """Store every table the named outputs need, each once, then publish the outputs."""
    run_ts = run_ts or datetime.now(timezone.utc)
    needed = dict.fromkeys(u for name in names for u in PUBLISHED[name].upstream)
    _store(spark, order_of(*needed), source, root, options, run_ts, fmt, **table_options)
    return {name: publish(spark, name, root, options, fmt) for name in names}


def run_finance(
    spark: SparkSession, source: Source, root: str, options: Options = Options(), **run_options
) -> DataFrame:
    """The whole finance pipeline: finance metrics and upstream, then the dashboard."""
    name = "finance_dashboard"
    return run_published(spark, [name], source, root, options, **run_options)[name]


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run the order-to-finance pipeline.")
    parser.add_argument(
        "target",
        nargs="?",
        default="finance",
        help="finance, all (every published output), a published output, or a table",
    )
    parser.add_argument("--root", required=True, help="where tables are stored")
    parser.add_argument("--source", choices=("jdbc", "parquet", "tbl", "sample"), default="jdbc")
    parser.add_argument("--directory", help="input folder of file sources")
    parser.add_argument("--num-partitions", type=int, help="parallel JDBC ranges per table")
    parser.add_argument(
        "--equal-rows", action="store_true", help="JDBC ranges of equal row counts, not widths"
    )
    parser.add_argument("--as-of", type=date.fromisoformat, help="day to age open orders to")
    parser.add_argument("--geo-key", default="n_regionkey")
    parser.add_argument("--part-only", action="store_true")
    parser.add_argument("--format", default="parquet", help="storage format of the tables")
    parser.add_argument("--keep", type=int, default=1, help="snapshots to keep per table")
    parser.add_argument(
        "--rebalance", action="store_true", help="even out the files of source tables"
    )
    parser.add_argument("--compact", action="store_true", help="rewrite into even files")
    parser.add_argument("--suites", help="folder of expectation suites, <table>.json each")
    parser.add_argument("--results", help="where the outcome of checks is kept")
    parser.add_argument("--input-gb", type=int, help="size partitions for this much input")
    args = parser.parse_args(argv)
    if args.source != "jdbc" and not args.directory:
        parser.error(f"--directory is required with --source {args.source}")

    logging.basicConfig(level=logging.INFO)
    spark = build_session(settings=sized_for(args.input_gb * 1024**3) if args.input_gb else None)
    if args.source == "jdbc":
        connection = jdbc.JdbcConnection.from_env()
        source = jdbc_source(spark, connection, args.num_partitions, args.equal_rows)
    else:
        make = {"parquet": parquet_source, "tbl": tbl_source, "sample": sample_source}
        source = make[args.source](spark, args.directory)
    options = Options(args.geo_key, args.part_only, args.as_of)
    storing = {"keep": args.keep, "rebalance": args.rebalance, "fmt": args.format}
    storing |= {"compact": args.compact, "results_path": args.results}
    if args.suites:
        storing["suites"] = quality.SUITES | quality.suites_from_folder(args.suites)
    outputs = {"finance": ["finance_dashboard"], "all": list(PUBLISHED)}
    outputs.update({name: [name] for name in PUBLISHED})
    if args.target in outputs:
        run_published(spark, outputs[args.target], source, args.root, options, **storing)
    else:
        run(spark, args.target, source, args.root, options, **storing)

