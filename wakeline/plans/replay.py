"""Batch replay: an ordered feed becomes detail, rejected and minute rows."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions import rules as R
from wakeline.functions.timetext import clock_ms, iso_ms
from wakeline.operators.dedup import accepted_positions, mark_first
from wakeline.operators.eventtime import with_watermark_column
from wakeline.operators.minutes import counted, minute_aggregate
from wakeline.schema import CLEAN_RECORD, DETAIL, REJECTED
from wakeline.settings import Rules
from wakeline.sources.staging import staged


def detail_columns(rows: DataFrame) -> DataFrame:
    return rows.withColumnRenamed("proc_time", "ingest_time").select(*DETAIL.fieldNames())


def rejected_columns(rows: DataFrame) -> DataFrame:
    return rows.withColumnRenamed("proc_time", "ingest_time").select(*REJECTED.fieldNames())


def clean_records(rows: DataFrame) -> DataFrame:
    """Reduced record of the JSON sink, times as text."""
    texts = {
        "event_time": iso_ms(F.col("event_time")),
        "ingest_time": iso_ms(F.col("proc_time")),
        "watermark": clock_ms(F.col("watermark")),
    }
    return rows.withColumns(texts).select(*CLEAN_RECORD)


class Replay:
    """Plans over one feed. Each attribute is a DataFrame built when first used.

    The feed needs the arrival columns and a unique integer ``order`` along
    which ``proc_time`` never falls. Rules are applied in stream order: defects
    and lateness first, then the first copy, then the minute.

    ``tagged`` and ``clean`` are plain plans over whole rows. What needs the first
    copies goes through ``judged``, a narrow written table: whole readings are then
    shuffled once, to meet what was decided about them.
    """

    def __init__(self, feed: DataFrame, rules: Rules = Rules(), order: str = "arrival_seq"):
        self.feed = feed
        self.rules = rules
        self.order = order

    @cached_property
    def tagged(self) -> DataFrame:
        # Defects are told before the rows are ordered: what only needs to know
        # whether a row is clean then shuffles one column for them.
        told = self.feed.withColumn("_defects", R.field_defects())
        seen = with_watermark_column(told, self.order, self.rules)
        tagged = R.tag(seen, F.col("watermark"), self.rules, F.col("_defects"))
        return tagged.drop("_defects")

    @cached_property
    def clean(self) -> DataFrame:
        return self.tagged.where(F.col("reject_reason").isNull())

    @cached_property
    def judged(self) -> DataFrame:
        """Position, id, arrival, watermark and flags of every row, written once."""
        narrow = (self.order, "event_id", "proc_time", "watermark", "late", "overheat", "reject_reason")
        return staged(self.tagged.select(*narrow), "judged")

    @cached_property
    def decided(self) -> DataFrame:
        """``judged`` with the final reason of every row; NULL for accepted rows."""
        clean = self.judged.where(F.col("reject_reason").isNull())
        accepted = accepted_positions(clean, order=self.order, rules=self.rules)
        marked = mark_first(self.judged, accepted, self.order)
        later = F.when(~F.col("is_first"), R.DUPLICATE)
        return marked.withColumn("reason", F.coalesce("reject_reason", later))

    def _whole(self, decided: DataFrame) -> DataFrame:
        told = decided.drop("event_id", "proc_time")
        return self.feed.join(told, self.order)

    @cached_property
    def accepted(self) -> DataFrame:
        """Rows of ``decided`` that are kept."""
        return self.decided.where("is_first")

    @cached_property
    def repeated(self) -> DataFrame:
        """Rows of ``decided`` that are later copies."""
        return self.decided.where(F.col("reason") == R.DUPLICATE)

    @cached_property
    def first(self) -> DataFrame:
        return self._whole(self.accepted)

    @cached_property
    def marked(self) -> DataFrame:
        """Every row with its final reason."""
        return self._whole(self.decided)

    @cached_property
    def detail(self) -> DataFrame:
        return detail_columns(self.first)

    @cached_property
    def rejected(self) -> DataFrame:
        return rejected_columns(self._whole(self.decided.where(F.col("reason").isNotNull())))

    @cached_property
    def post_close(self) -> DataFrame:
        """Accepted rows whose minute was final before they arrived."""
        return self.first.where(~counted(F.col("watermark"), self.rules))

    @cached_property
    def minutes(self) -> DataFrame:
        """Closed minutes only: the watermark has reached their end."""
        entered = self.first.where(counted(F.col("watermark"), self.rules))
        reached = self.judged.agg(F.max("watermark")).scalar()
        return minute_aggregate(entered, self.rules).where(F.col("window_end") <= reached)
