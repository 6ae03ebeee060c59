"""The star schema: cleaned tables around the school dimension."""

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chalkline.functions.dates import date_text, date_value
from chalkline.functions.identifiers import school_id
from chalkline.functions.text import quoted
from chalkline.operators.lineage import date_kept
from chalkline.plans import cleaners

SCHOOL = "dim_school"
ATTENDANCE = "fact_attendance"
PROCUREMENT = "fact_mdm_procurement"
INFRA_HISTORY = "fact_infrastructure_history"
INFRA_CURRENT = "dim_infrastructure_current"
SCORES = "fact_test_scores"
SUMMARY = "agg_school_month"
TABLES = (SCHOOL, ATTENDANCE, PROCUREMENT, INFRA_HISTORY, INFRA_CURRENT, SCORES)

FACTS = (ATTENDANCE, PROCUREMENT, SCORES)


# From a school's id and a date to what rows are gathered by, and from there to a step on a frame.
Place = Callable[[Column, Column], Column]
Gather = Callable[[DataFrame], DataFrame]


PLACE = "__place"
_DEAL = "__deal"


def _gathered(df: DataFrame, place: Column) -> DataFrame:
    """AQE gathers the rows of each place into partitions of a good size, and deals a large place to several."""
    return df.withColumn(PLACE, place).hint("rebalance", PLACE).drop(PLACE)


def _as_it_is(df: DataFrame) -> DataFrame:
    return df


def _dealt(raw: DataFrame, place: Place) -> DataFrame:
    """Raw rows dealt by ranges of their place and, within a place, of a hash of the whole row.

    Copies of a row share a range, so they can be counted where they arrive. Ranges are of like size: a large place is
    dealt to several, and AQE joins neighbours where they are small. The dates go along, as they cost more to read than to move.
    """
    # Kinds of values that a hash does not take, or tells apart where a group does not, are left to the others.
    sure = [f.name for f in raw.schema if not {"map", "collate"} & set(re.findall(r"\w+", f.dataType.simpleString()))]
    row = F.hash(*map(quoted, sure))
    date = date_value(date_text("date"))
    dealt = raw.withColumns({date_kept("date"): date, PLACE: place(school_id("school_id"), date), _DEAL: row})
    return dealt.repartitionByRange(PLACE, _DEAL)


def _in_place(rows: DataFrame) -> DataFrame:
    """Rows sorted by place while they are narrow, for a write that needs them so."""
    return rows.sortWithinPartitions(PLACE)


class Star:
    """Lazy frames of the governed tables, each built when it is first asked for.

    `narrow` has tables whose raw rows can be moved before the columns of their lineage are added: it takes a step on
    the raw rows and one on the distinct ones.
    """

    def __init__(
        self, builders: Mapping[str, Callable[["Star"], DataFrame]],
        narrow: Mapping[str, Callable[[Gather, Gather], DataFrame]] | None = None,
    ):
        self._builders, self._narrow = builders, narrow or {}
        self._frames: dict[str, DataFrame] = {}

    def gathered(self, name: str, place: Place) -> DataFrame:
        """A table with its rows gathered for a write.

        Cleaned rows are some three times as wide as raw ones and follow from them, so where it can be the
        raw rows are shuffled, once their copies are counted, and cleaned where they arrive.
        """
        if name not in self._narrow:
            return _gathered(self.table(name), place(F.col("school_id"), F.col("date")))
        raw_place = place(school_id("school_id"), date_value(date_text("date")))
        return self._narrow[name](_as_it_is, lambda rows: _gathered(rows, raw_place))

    def in_order(self, name: str, place: Place) -> DataFrame:
        """A table with its rows gathered by a last column `PLACE`, and in its order where the raw rows can be moved.

        The shuffle that brings copies together is then the one that gathers the rows, and what is sorted for the write
        are distinct raw rows instead of cleaned ones.
        """
        if name not in self._narrow:
            return self.table(name).withColumn(PLACE, place(F.col("school_id"), F.col("date"))).hint("rebalance", PLACE)
        return self._narrow[name](lambda raw: _dealt(raw, place), _in_place).drop(_DEAL, date_kept("date"))

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._builders[name](self)
        return self._frames[name]

    @property
    def school(self) -> DataFrame:
        return self.table(SCHOOL)

    @property
    def attendance(self) -> DataFrame:
        return self.table(ATTENDANCE)

    @property
    def procurement(self) -> DataFrame:
        return self.table(PROCUREMENT)

    @property
    def infra_history(self) -> DataFrame:
        return self.table(INFRA_HISTORY)

    @property
    def infra_current(self) -> DataFrame:
        return self.table(INFRA_CURRENT)

    @property
    def scores(self) -> DataFrame:
        return self.table(SCORES)

    @property
    def summary(self) -> DataFrame | None:
        """The stored summary of the facts, where there is one."""
        return self.table(SUMMARY) if SUMMARY in self._builders else None

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLES}


def star_from_raw(raw: Callable[[str], DataFrame]) -> Star:
    """The star as lazy plans over raw frames, given by dataset name; nothing is written."""
    return Star({
        SCHOOL: lambda _: cleaners.clean_school_master(raw("school_master")),
        ATTENDANCE: lambda _: cleaners.clean_attendance(raw("student_attendance")),
        PROCUREMENT: lambda _: cleaners.clean_procurement(raw("mdm_procurement")),
        INFRA_HISTORY: lambda _: cleaners.clean_infrastructure(raw("school_infrastructure")),
        INFRA_CURRENT: lambda star: cleaners.current_infrastructure(star.infra_history),
        SCORES: lambda _: cleaners.clean_scores(raw("test_scores")),
    }, {
        ATTENDANCE: lambda deal, gather: cleaners.clean_attendance(deal(raw("student_attendance")), gather),
        PROCUREMENT: lambda deal, gather: cleaners.clean_procurement(deal(raw("mdm_procurement")), gather=gather),
        INFRA_HISTORY: lambda deal, gather: cleaners.clean_infrastructure(deal(raw("school_infrastructure")), gather),
        SCORES: lambda deal, gather: cleaners.clean_scores(deal(raw("test_scores")), gather),
    })
