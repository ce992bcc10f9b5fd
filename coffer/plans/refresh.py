"""Refresh of all produced tables, all clients in one job."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coffer.operators.blend import BLEND_COLUMNS, blend, blend_refresh
from coffer.operators.budget import budget_long, stage_budget
from coffer.operators.comments import ensure_comments, with_comments
from coffer.operators.lines import all_lines
from coffer.operators.pnl import daily_postings, postings_to_rows, profit_and_loss
from coffer.operators.profit import profit
from coffer.plans.checks import problems_of
from coffer.plans.staging import POSTING_FAULTS, STAGED, stage
from coffer.schemas import CLIENT
from coffer.sinks.snapshots import expire_snapshots, layer_path, read_snapshot, write_clients, write_snapshot
from coffer.sinks.views import register_views
from coffer.sources.ledger import by_client
from coffer.sources.sheet import MALFORMED

BLEND = "materialized_pl_budget_blend"
COMMENTS = "financial_comments"
COMMENTED = "pl_budget_with_comments"
PROFIT = "profit_by_month"
PROBLEMS = "client_problems"
REFRESHED = (BLEND, COMMENTED, PROFIT)


@dataclass(frozen=True)
class Refreshed:
    """Outcome of a refresh: version written, problems that held clients back, and the clients that were refreshed."""

    blend_version: int
    problems: DataFrame
    clients: tuple = ()


@dataclass(frozen=True)
class _Inputs:
    """What facts are built from, of the clients that go ahead."""

    postings: DataFrame
    accounts: DataFrame
    items: DataFrame
    budget: DataFrame


def _checked_inputs(ledger, sheet, output_root, start, n_months):
    """Inputs from the staged books without the clients that have problems; and these problems."""
    spark = ledger.spark
    path = layer_path(output_root, "staging", PROBLEMS)
    books = stage(ledger, output_root, sheet, start, n_months)
    write_snapshot(problems_of(books), path, partition_by=())
    problems = read_snapshot(spark, path)
    excluded = problems.select(CLIENT).distinct()

    def going(df):
        return by_client(df, excluded, "left_anti")

    postings = going(books.postings).filter("ref_id IS NOT NULL").drop(*POSTING_FAULTS)
    items = going(ledger.table("items"))
    return _Inputs(postings, going(books.accounts), items, going(books.budget).drop(MALFORMED)), problems


def _strict_inputs(ledger, sheet, start, n_months):
    """Inputs whose first bad value stops the refresh."""
    staged = stage_budget(ledger.in_scope(sheet), start, n_months, ledger.amount_type)
    return _Inputs(daily_postings(all_lines(ledger)), ledger.table("accounts"), ledger.table("items"), staged)


def refresh(
    ledger,
    sheet,
    output_root,
    mode="intended",
    start="2025-01",
    n_months=36,
    check_inputs=True,
    random_ids=False,
    keep=None,
):
    """Rebuild the blend of the clients in scope, and the tables made from it, as new versions.

    A client whose inputs fail the checks keeps its previous rows and is reported;
    the others go ahead.  Clients that are not part of this refresh (left out by
    ``ledger.clients``, or with neither accounts nor a sheet) keep theirs too: their
    files are neither read nor written.  A client with a sheet and no accounts has
    its budget without attributes.

    ``random_ids`` gives new rows random ids, which are stored before anything uses
    them.  ``keep`` deletes all but that many versions afterwards, never files that a
    kept version needs.
    """
    spark = ledger.spark
    blend_path = layer_path(output_root, "marts", BLEND)
    comments = ensure_comments(spark, layer_path(output_root, "marts", COMMENTS))
    previous = read_snapshot(spark, blend_path)

    if check_inputs:
        inputs, problems = _checked_inputs(ledger, sheet, output_root, start, n_months)
    else:
        inputs, problems = _strict_inputs(ledger, sheet, start, n_months), None
    names = inputs.accounts.select(CLIENT).union(inputs.budget.select(CLIENT)).distinct()
    # One name per tenant: the list that the stored version points to.
    clients = tuple(row[0] for row in names.collect())

    rows = postings_to_rows(inputs.postings, inputs.accounts, inputs.items)
    budget = budget_long(inputs.budget, inputs.accounts)
    if previous is None:
        result = blend(rows, budget, random_ids)
    else:
        ours = by_client(ledger.in_scope(previous), names, "left_semi")
        result = blend_refresh(ours, rows, budget, comments, mode, random_ids)
    if random_ids:
        # A task that runs again would draw other ids, so they are read back before they are used.
        settled = layer_path(output_root, "staging", "settled_blend")
        write_snapshot(result, settled)
        result = read_snapshot(spark, settled)
    version = write_clients(result.select(*BLEND_COLUMNS), blend_path, clients)
    refresh_marts(spark, output_root, clients)
    if keep is not None:
        for layer, tables in (("marts", REFRESHED), ("staging", STAGED)):
            for table in tables:
                expire_snapshots(spark, layer_path(output_root, layer, table), keep)
    return Refreshed(version, problems, clients)


def refresh_marts(spark, output_root, clients=None):
    """Commented facts from the stored blend, profit from the stored commented facts; of some clients or all.

    Each step is stored and read back by the next, so nothing reads the books again.
    To be called on its own after comments were added.
    """
    path = {table: layer_path(output_root, "marts", table) for table in REFRESHED}

    def of_clients(df):
        if clients is None:
            return df
        named = [c for c in clients if c is not None]
        missing = F.col(CLIENT).isNull() if None in clients else F.lit(False)
        return df.filter(F.col(CLIENT).isin(named) | missing if named else missing)

    def store(df, table):
        if clients is None:
            write_snapshot(df, path[table])
        else:
            write_clients(df, path[table], clients)
        return of_clients(read_snapshot(spark, path[table]))

    comments = ensure_comments(spark, layer_path(output_root, "marts", COMMENTS))
    facts = of_clients(read_snapshot(spark, path[BLEND]))
    commented = store(with_comments(facts, of_clients(comments)), COMMENTED)
    store(profit(commented, "date"), PROFIT)


def report_frames(ledger, sheet, output_root, start="2025-01", n_months=36):
    """The named tables and views a reader queries, lazily."""
    spark = ledger.spark
    accounts = ledger.table("accounts")
    staged = stage_budget(sheet, start, n_months, ledger.amount_type)
    frames = {
        "p_l_view": profit_and_loss(ledger),
        "stg_budget_template": staged,
        "budget_transformed": budget_long(staged, accounts),
        COMMENTS: ensure_comments(spark, layer_path(output_root, "marts", COMMENTS)),
    }
    stored = {table: read_snapshot(spark, layer_path(output_root, "marts", table)) for table in REFRESHED}
    if stored[BLEND] is not None:
        frames |= stored
        frames["profit_by_calendar_month"] = profit(stored[COMMENTED], "month")
    return frames


def register_report_views(ledger, sheet, output_root, client=None, **options):
    """Register the report frames as views, of one client if given."""
    frames = report_frames(ledger, sheet, output_root, **options)
    if client is not None:
        frames = {name: df.filter(F.col(CLIENT) == client) for name, df in frames.items()}
    return register_views(frames)
