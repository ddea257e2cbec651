"""Extract and load jobs for the historic and the live feed.

``extract`` copies source tables into dated snapshots of the lake; ``load``
cleans the newest snapshots, joins them and writes the four warehouse tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailweave.functions import statistics
from retailweave.operators import entities
from retailweave.operators.joins import MAX_BROADCAST_BYTES, output_columns, star_join
from retailweave.plans.steps import CommittedTarget, FileTarget, Ledger, Steps, Target, UnknownTarget
from retailweave.plans.watermarks import Watermark, extract_new, pending
from retailweave.sinks.commits import read_commit, write_committed
from retailweave.sinks.deduplicated import LoadLedger, append_new
from retailweave.sinks.writers import Warehouse, spread, write_snapshot
from retailweave.sources.snapshots import feed_path, read_newest, run_date

Source = Callable[[SparkSession], DataFrame]

# Folder names of the lake and the save mode of every target.
ENTITIES = ("Customers", "Articles", "Transactions")
HISTORIC = "historic"
LIVE = "Live"
SNAPSHOT_MODES = {
    HISTORIC: {"Customers": "errorifexists", "Articles": "errorifexists", "Transactions": "overwrite"},
    LIVE: {"Customers": "overwrite", "Articles": "overwrite", "Transactions": "append"},
}
TABLE_MODES = {
    HISTORIC: {
        "warehouse": "append",
        "customers": "overwrite",
        "articles": "overwrite",
        "transactions": "overwrite",
    },
    LIVE: {
        "warehouse": "append",
        "customers": "overwrite",
        "articles": "overwrite",
        "transactions": "append",
    },
}


@dataclass(frozen=True)
class Jobs:
    """What the jobs need to know.

    ``sources`` maps each feed to a reader per entity. ``n_files`` and
    ``fact_partitions`` force a number of files per snapshot and of fact
    partitions before the join; left out, nothing is shuffled for them.
    ``join_strategy`` is that of ``star_join``, for both feeds: the rows are the
    same, and broadcasting what measures small saves shuffling the fact table.

    Off by default, as they change what a repeated run does:

    * ``commits``: snapshots have a manifest (``sinks/commits.py``);
    * ``watermarks``: by entity, what the live extracts have not taken yet is all that they take, and a load takes all that
      no load took (``plans/watermarks.py``). With commits only;
    * ``append_keys``: by table, the columns by whose values rows that are there already are left out of an append, and
      ``append_within``, one of them that limits what is read of the table (``sinks/deduplicated.py``);
    * ``ledger``: a folder for the records of finished steps and loads, by which a chain that broke off is taken up again
      (``plans/steps.py``).
    """

    lake: str
    warehouse: Warehouse
    sources: Mapping[str, Mapping[str, Source]] = field(default_factory=dict)
    n_files: int | None = None
    fact_partitions: int | None = None
    snapshot_scope: str = "write"
    join_strategy: str = "broadcast"
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES
    commits: bool = False
    watermarks: Mapping[str, Watermark] = field(default_factory=dict)
    append_keys: Mapping[str, Sequence[str]] = field(default_factory=dict)
    append_within: Mapping[str, str] = field(default_factory=dict)
    ledger: str | None = None

    def __post_init__(self):
        if self.watermarks and not (self.commits and self.ledger):
            raise ValueError("watermarks follow committed snapshots and a ledger of loads: set commits and ledger")


def extract(
    spark: SparkSession, jobs: Jobs, feed: str, entities: tuple[str, ...], date: str | None = None, steps: Steps | None = None
) -> None:
    """Copy the source tables of ``entities`` into the feed's snapshot of the day."""
    date, steps = run_date(spark, date), steps or Steps()
    for entity in entities:
        root, mode = feed_path(jobs.lake, entity, feed), SNAPSHOT_MODES[feed][entity]
        source, watermark = jobs.sources[feed][entity], jobs.watermarks.get(entity) if feed == LIVE else None
        if watermark is not None:
            target, write = CommittedTarget(spark, root, date, "append"), partial(extract_new, root=root, folder=date, watermark=watermark)
        elif jobs.commits:
            target, write = CommittedTarget(spark, root, date, mode), partial(write_committed, root=root, folder=date, mode=mode)
        else:
            target, write = FileTarget(spark, f"{root}/{date}", mode), partial(write_snapshot, path=f"{root}/{date}", mode=mode)
        steps.run(f"extract-{entity}", lambda: write(source(spark), n_files=jobs.n_files), target)


def extract_historic_dimensions(spark: SparkSession, jobs: Jobs, date: str | None = None, steps: Steps | None = None) -> None:
    extract(spark, jobs, HISTORIC, ("Customers", "Articles"), date, steps)


def extract_historic_transactions(spark: SparkSession, jobs: Jobs, date: str | None = None, steps: Steps | None = None) -> None:
    extract(spark, jobs, HISTORIC, ("Transactions",), date, steps)


def extract_live(spark: SparkSession, jobs: Jobs, date: str | None = None, steps: Steps | None = None) -> None:
    extract(spark, jobs, LIVE, ENTITIES, date, steps)


def clean_all(
    customers: DataFrame, articles: DataFrame, transactions: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three cleaned frames, for use more than once.

    The median age and the most frequent channel are fetched here, side by side
    in one query, so that no later use computes them again.
    """
    fills = (
        customers.sparkSession.range(1)
        .select(
            statistics.exact_quantile(customers, "age").scalar().alias("age"),
            statistics.mode(transactions, "sales_channel_id").scalar().alias("channel"),
        )
        .first()
    )
    return (
        entities.clean_customers(customers, F.lit(fills.age)),
        entities.clean_articles(articles),
        entities.clean_transactions(transactions, F.lit(fills.channel)),
    )


def load(spark: SparkSession, jobs: Jobs, feed: str, steps: Steps | None = None) -> None:
    """Clean and join the newest snapshots of a feed and write the warehouse tables.

    The cleaned dimensions are kept for their own table, the size check and the
    join. Their tables come first, so Spark knows their sizes when it plans the
    join. The fact table is not kept: its cleaning is a projection, and reading
    Parquet again is cheaper than holding all of it.
    """
    steps, modes = steps or Steps(), TABLE_MODES[feed]
    roots = {entity: feed_path(jobs.lake, entity, feed) for entity in ENTITIES}
    raw = {entity: read_newest(spark, root, jobs.snapshot_scope) for entity, root in roots.items()}
    customers, articles = entities.clean_customers(raw["Customers"]), entities.clean_articles(raw["Articles"])
    incremental = feed == LIVE and "Transactions" in jobs.watermarks
    dimensions = [(customers, "customer_id"), (articles, "article_id")]

    def joined(facts: DataFrame, clean: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Cleaned behind the join, so that the columns which cleaning adds are not shuffled for it."""
        keys, others = output_columns(clean(facts), dimensions)
        rows = star_join(spread(facts, jobs.fact_partitions), dimensions, jobs.join_strategy, jobs.max_broadcast_bytes)
        return clean(rows).select(*keys, *others)

    @cache
    def with_channel() -> Callable[[DataFrame], DataFrame]:
        """Cleans facts of the newest snapshot by its most frequent channel, which is fetched once, if a table is to be written that needs it."""
        found = statistics.mode(raw["Transactions"], "sales_channel_id").first()
        return partial(entities.clean_transactions, channel_mode=F.lit(found and found[0]))

    def append(table: str, made: Callable[[DataFrame, Callable[[DataFrame], DataFrame]], DataFrame]) -> None:
        """The rows of the facts, or of the snapshots of facts that no load took, one load for each."""
        if not incremental:
            _write(spark, jobs, made(raw["Transactions"], with_channel()), table, modes[table], None)
            return
        loads = LoadLedger(spark, f"{jobs.ledger}/loads")
        listed = loads.listed(table)
        for commit in pending(spark, roots["Transactions"], lambda number: listed(_load_id(feed, number))):
            rows = read_commit(spark, roots["Transactions"], commit)
            clean = partial(entities.clean_transactions, channel_mode=statistics.mode(rows, "sales_channel_id").scalar())
            _write(spark, jobs, made(rows, clean), table, modes[table], _load_id(feed, commit.number))

    with _kept(customers), _kept(articles):
        for name, frame in (("customers", customers), ("articles", articles)):
            steps.run(f"load-{name}", partial(_write, spark, jobs, frame, name, modes[name], None), _target(spark, jobs, name, modes[name]))
        # Where loads are listed one by one, each takes back its own rows.
        target = None if incremental else _target(spark, jobs, "warehouse", modes["warehouse"])
        steps.run("load-warehouse", lambda: append("warehouse", joined), target)
    target = None if incremental else _target(spark, jobs, "transactions", modes["transactions"])
    steps.run("load-transactions", lambda: append("transactions", lambda facts, clean: clean(facts)), target)


def _load_id(feed: str, commit: str) -> str:
    return f"{feed}-{commit}"


def _write(spark: SparkSession, jobs: Jobs, df: DataFrame, table: str, mode: str, load_id: str | None) -> None:
    """Writes a warehouse table; with a ``load_id``, once for that load."""
    keys = jobs.append_keys.get(table) if mode == "append" else None
    loads = LoadLedger(spark, f"{jobs.ledger}/loads") if load_id is not None else None
    if keys:
        append_new(jobs.warehouse, df, table, keys, jobs.append_within.get(table), loads, load_id)
    elif loads is None:
        jobs.warehouse.write(df, table, mode)
    else:
        Ledger(spark, f"{jobs.ledger}/appends/{table}/{load_id}").run("append", partial(jobs.warehouse.write, df, table, mode), _target(spark, jobs, table, mode))
        loads.finished(table, load_id)


def _target(spark: SparkSession, jobs: Jobs, table: str, mode: str) -> Target:
    repeatable = table in jobs.append_keys
    if jobs.warehouse.of_files():
        # What a broken append left is found again by its keys.
        return Target() if repeatable else FileTarget(spark, jobs.warehouse.path(table), mode)
    return UnknownTarget(table, mode, repeatable)


def load_historic(spark: SparkSession, jobs: Jobs, steps: Steps | None = None) -> None:
    load(spark, jobs, HISTORIC, steps)


def load_live(spark: SparkSession, jobs: Jobs, steps: Steps | None = None) -> None:
    load(spark, jobs, LIVE, steps)


def run_historic(spark: SparkSession, jobs: Jobs, date: str | None = None) -> None:
    """The historic chain: both extracts, then the load. With a ledger, a run of the date that broke off is taken up again."""
    date = run_date(spark, date)
    steps = _steps(spark, jobs, HISTORIC, date)
    extract_historic_dimensions(spark, jobs, date, steps)
    extract_historic_transactions(spark, jobs, date, steps)
    load_historic(spark, jobs, steps)
    steps.finish()


def run_live(spark: SparkSession, jobs: Jobs, date: str | None = None) -> None:
    """The live chain: extract, then load. With a ledger, a run of the date that broke off is taken up again."""
    date = run_date(spark, date)
    steps = _steps(spark, jobs, LIVE, date)
    extract_live(spark, jobs, date, steps)
    load_live(spark, jobs, steps)
    steps.finish()


def _steps(spark: SparkSession, jobs: Jobs, feed: str, date: str) -> Steps:
    return Steps() if jobs.ledger is None else Ledger(spark, f"{jobs.ledger.rstrip('/')}/chains/{feed}/{date}")


@contextmanager
def _kept(df: DataFrame):
    """``df`` persisted for the block."""
    df.persist()
    try:
        yield df
    finally:
        df.unpersist()
