"""Filing history per firm: one row per firm and date, previous and latest filings.

Skew: rows are first reduced to one per (firm, date), already before the shuffle, so a firm or even a
(firm, date) that holds a third of all rows costs no single task more than its distinct dates. After that a firm has at most one row per calendar day, which is what makes the per-firm windows safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from filingscope.schemas import KEY


def firm_window(firm: str = "sec_number") -> WindowSpec:
    return Window.partitionBy(firm).orderBy("filing_date")


def dedupe_filings(filings: DataFrame, tiebreak: str = "filing_key", key: Sequence[str] = tuple(KEY)) -> DataFrame:
    """Keep the row with the highest ``tiebreak`` per firm and date; equal ones are told apart by the other columns.

    Spark cuts each group to its first row in every map task before the shuffle (window group limit), so a
    repeated key costs one row per task, however often it is repeated.
    """
    return dedupe_by(filings, key, [tiebreak, *[c for c in filings.columns if c not in (*key, tiebreak)]])


def dedupe_by(df: DataFrame, key: Sequence[str], descending: Sequence[str]) -> DataFrame:
    """The first row per key in descending order of the given columns."""
    best_first = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in descending])
    return df.withColumn("nth", F.row_number().over(best_first)).where("nth = 1").drop("nth")


def duplicate_filings(filings: DataFrame, tiebreak: str = "filing_key") -> DataFrame:
    """The rows that :func:`dedupe_filings` drops: all but the first in the same order."""
    order = [tiebreak, *[c for c in filings.columns if c not in (*KEY, tiebreak)]]
    best_first = Window.partitionBy(*KEY).orderBy(*[F.desc(c) for c in order])
    return filings.withColumn("nth", F.row_number().over(best_first)).where("nth > 1").drop("nth")


def with_previous(history: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``prev_<column>`` from the firm's filing just before. Needs one row per firm and date."""
    w = "(PARTITION BY sec_number ORDER BY filing_date)"
    return history.selectExpr("*", *[f"LAG({c}) OVER {w} AS prev_{c}" for c in columns])


def asof_previous(filings: DataFrame, history: DataFrame, columns: Sequence[str], tiebreak: str = "filing_key") -> DataFrame:
    """Left as-of join: the nearest strictly earlier filing of the same firm; of several on that date the one with the
    highest ``tiebreak``, then the highest other columns.

    Both sides go into one frame and through one exchange on the firm. A window over the dates before each filing keeps
    the greatest (date, tiebreak, columns) so far, so neither side needs one row per date and nothing is joined.
    """
    looked_up = ["filing_date", *[c for c in columns if c != "filing_date"]]
    asked = filings.select(*KEY, F.struct(*filings.columns).alias("filing"))
    known = history.select(*KEY, F.struct("filing_date", tiebreak, *[c for c in looked_up if c not in ("filing_date", tiebreak)]).alias("seen"))
    both = asked.unionByName(known, allowMissingColumns=True)
    before = Window.partitionBy("sec_number").orderBy(F.unix_date("filing_date")).rangeBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("previous", F.max("seen").over(before)).where("filing IS NOT NULL")
    return found.select("filing.*", *[F.col(f"previous.{c}").alias(f"prev_{c}") for c in looked_up])


def latest_per_firm(filings: DataFrame, tiebreak: str | None = None, firm: str = "sec_number") -> DataFrame:
    """Each firm's newest filing; ``tiebreak``, then the other columns decide between filings of one date.

    As in :func:`dedupe_filings`, each map task keeps one row per firm before the shuffle.
    """
    lead = ["filing_date", *([tiebreak] if tiebreak else [])]
    return dedupe_by(filings, [firm], [*lead, *[c for c in filings.columns if c not in (firm, *lead)]])


def latest_per_firm_ties(filings: DataFrame, firm: str = "sec_number") -> DataFrame:
    """Each firm's newest filings, all of them if several share that date."""
    newest_first = Window.partitionBy(firm).orderBy(F.desc("filing_date"))
    return filings.withColumn("nth", F.rank().over(newest_first)).where("nth = 1").drop("nth")


def only_keys(filings: DataFrame, few: DataFrame) -> DataFrame:
    """The filings whose key is among ``few``. If Spark measures ``few`` as small it sends them to the filings, which
    are then filtered where they are read; else this is one more shuffle on the key that the next join reuses."""
    return filings.join(few.select(*KEY), KEY, "left_semi")


def latest_date(filings: DataFrame) -> Column:
    """The newest date in the data, as a scalar subquery."""
    return filings.agg(F.max("filing_date")).scalar()


def since(filings: DataFrame, days: int, as_of: Column | None = None) -> DataFrame:
    """Filings of the ``days`` before ``as_of`` (default: the newest date in the data)."""
    anchor = latest_date(filings) if as_of is None else as_of
    return filings.where(F.col("filing_date") >= F.date_sub(anchor, days))
