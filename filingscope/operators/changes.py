"""What changed between a firm's consecutive filings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingscope.functions.metrics import drop_pct, drop_pct_integer
from filingscope.operators.history import with_previous
from filingscope.rules import TREND_MEAN_PCT, TREND_PERIODS
from filingscope.schemas import CHANGE, KEY, conform

COMPARED = ("filing_date", "raum", "client_count", "account_count", "disciplinary_disclosures", "cco_name")
NEEDED = ("sec_number", *COMPARED)


def filing_changes(
    history: DataFrame,
    pct_mode: str = "fractional",
    require_previous: bool = False,
    null_disclosures_as_zero: bool = False,
    owner_moves: DataFrame | None = None,
    carried: DataFrame | None = None,
) -> DataFrame:
    """Compare every filing with the firm's previous one.

    ``history`` holds one row per firm and date. The previous filing is looked up over the whole history
    and only then are filings without assets dropped; trend and age see the remaining rows only. All
    windows share one partitioning and one sort.

    ``pct_mode``: ``fractional``, or ``as_written`` for client and account percentages by integer division
    (whole multiples of 100, account growth negative). ``require_previous`` keeps the filings that have a
    previous one instead of those with assets. ``owner_moves`` optionally gives (key, owner_moves_12m).
    ``carried`` gives what :func:`firm_state` kept of each firm's earlier filings, which are then not needed.
    """
    measured = _measured(history, pct_mode, require_previous, null_disclosures_as_zero, carried)
    earlier = [f"earlier_{back}" for back in range(1, TREND_PERIODS)]
    changes = measured.selectExpr(
        *KEY,
        "ROUND(raum_drop, 2) AS raum_drop_pct",
        "ROUND(client_drop, 2) AS client_drop_pct",
        "ROUND(acct_drop, 2) AS acct_drop_pct",
        "new_disc_flag",
        "cco_changed",
        # the mean reaches the limit: compared as a sum, exact in decimals, before any rounding
        f"raum_drop + {' + '.join(earlier)} >= {TREND_MEAN_PCT * TREND_PERIODS} AS trend_down_flag",
        "0 AS owner_moves_12m",
        "YEAR(filing_date) - YEAR(first_date) AS adviser_age_years",
        "raum",
    )
    if owner_moves is not None:
        changes = (
            changes.drop("owner_moves_12m")
            .join(owner_moves.select(*KEY, "owner_moves_12m"), KEY, "left")
            .fillna(0, ["owner_moves_12m"])
        )
    return conform(changes, CHANGE)


def _measured(
    history: DataFrame,
    pct_mode: str = "fractional",
    require_previous: bool = False,
    null_disclosures_as_zero: bool = False,
    carried: DataFrame | None = None,
) -> DataFrame:
    """The filings that count with their unrounded drops, the drops before them and the firm's first date."""
    if pct_mode not in ("fractional", "as_written"):
        raise ValueError(f"unknown pct_mode {pct_mode!r}")
    w = "(PARTITION BY sec_number ORDER BY filing_date)"
    kept = []
    if carried is None:
        compared = with_previous(history.select(*NEEDED), COMPARED)
    else:
        kept = ["drops", "first_measured"]
        known = history.select(*NEEDED).join(carried.select("sec_number", "last", *kept), "sec_number", "left")
        compared = known.selectExpr(
            *NEEDED,
            *kept,
            *[f"IF(LAG(filing_date) OVER {w} IS NULL, last.{c}, LAG({c}) OVER {w}) AS prev_{c}" for c in COMPARED],
        )
    before = "COALESCE(prev_disciplinary_disclosures, 0)" if null_disclosures_as_zero else "prev_disciplinary_disclosures"
    measured = compared.where("prev_filing_date IS NOT NULL" if require_previous else "raum > 0").select(
        *KEY,
        "raum",
        drop_pct("prev_raum", "raum").alias("raum_drop"),
        _count_drop("client_count", pct_mode, growth_counts=False).alias("client_drop"),
        _count_drop("account_count", pct_mode, growth_counts=True).alias("acct_drop"),
        F.expr(f"COALESCE(disciplinary_disclosures > {before}, FALSE)").alias("new_disc_flag"),
        F.expr("COALESCE(cco_name <> prev_cco_name, FALSE)").alias("cco_changed"),
        *kept,
    )

    def earlier(back: int) -> str:
        seen = f"LAG(raum_drop, {back}) OVER {w}"
        if carried is not None:
            nth = f"ROW_NUMBER() OVER {w}"
            seen = f"IF({nth} > {back}, {seen}, GET(drops, INT({back} - {nth})))"
        return f"COALESCE({seen}, 0) AS earlier_{back}"

    # the running minimum in date order is the firm's first filing
    first = f"MIN(filing_date) OVER {w}"
    first = first if carried is None else f"COALESCE(first_measured, {first})"
    return measured.selectExpr(
        "*", *[earlier(back) for back in range(1, TREND_PERIODS)], f"{first} AS first_date"
    ).drop(*kept)


def firm_state(history: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """What later filings of a firm are compared with: its last filing, the last drops that count, newest first, and its
    first date that counts. One row per firm in ``history``; ``carried`` is the state before these filings."""
    last = history.groupBy("sec_number").agg(F.max_by(F.struct(*COMPARED), "filing_date").alias("last"))
    drops = F.array("raum_drop", *[F.col(f"earlier_{back}") for back in range(1, TREND_PERIODS - 1)])
    counted = (
        _measured(history, carried=carried)
        .groupBy("sec_number")
        .agg(F.max_by(drops, "filing_date").alias("drops"), F.min("first_date").alias("first_measured"))
    )
    state = last.join(counted, "sec_number", "left")
    if carried is None:
        return state
    before = carried.select("sec_number", F.col("drops").alias("old_drops"), F.col("first_measured").alias("old_first"))
    return state.join(before, "sec_number", "left").select(
        "sec_number",
        "last",
        F.coalesce("drops", "old_drops").alias("drops"),
        F.coalesce("first_measured", "old_first").alias("first_measured"),
    )


def _count_drop(column: str, pct_mode: str, growth_counts: bool) -> Column:
    if pct_mode == "as_written":
        return drop_pct_integer(f"prev_{column}", column, growth_counts)
    return drop_pct(f"prev_{column}", column)


def largest_drops(history: DataFrame, column: str, limit: int = 10, integer_division: bool = False) -> DataFrame:
    """The largest percentage drops of a count from one filing to the next."""
    drop = _count_drop(column, "as_written" if integer_division else "fractional", growth_counts=False)
    return (
        with_previous(history.select(*KEY, column), [column])
        .where(f"prev_{column} > 0 AND {column} < prev_{column}")
        .select(*KEY, column, f"prev_{column}", F.round(drop, 2).alias("drop_pct"))
        .orderBy(F.desc("drop_pct"), *KEY)
        .limit(limit)
    )


def population_report(changes: DataFrame) -> DataFrame:
    """Counts that follow a run of :func:`filing_changes`."""
    return changes.agg(
        F.count("*").alias("records"),
        F.count_if("new_disc_flag").alias("new_disclosures"),
        F.count_if("cco_changed").alias("officer_changes"),
        F.count_if(F.col("raum_drop_pct") >= 25).alias("large_raum_drops"),
    )
