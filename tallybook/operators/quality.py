"""Quality gate: every raw line either passes or carries the reason it does not."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.calendar import date_key
from tallybook.functions.coerce import col, is_blank, starts_with_c, to_moment, to_number
from tallybook.functions.money import ratio
from tallybook.operators.ordering import in_turns
from tallybook.schemas import BROKEN_RECORD, MAX_PRICE, MAX_QUANTITY, RAW_COLUMNS, REJECT_COLUMNS, SOURCE_COLUMNS
from tallybook.staging import freeing

REASON, _REJECTED, _DAY = "rejection_reason", "_rejected", "_day"

# Reason codes in order of precedence.
REASONS = [
    "NULL_OR_EMPTY_INVOICE_NO",
    "NULL_OR_EMPTY_STOCK_CODE",
    "INVALID_OR_ZERO_UNIT_PRICE",
    "INVALID_OR_ZERO_QUANTITY",
    "INVALID_INVOICE_DATE_FORMAT",
]


#: Reason of our own for records that a quoted line break cut; only CSV sources have them.
BROKEN_REASON = "BROKEN_CSV_RECORD"


def reasons_of(df: DataFrame) -> list[str]:
    """Reasons that lines of a source can have, in order of precedence."""
    return [*([BROKEN_REASON] if BROKEN_RECORD in df.columns else []), *REASONS]


def rejection_reason(broken: Column | None = None) -> Column:
    """Reason of the first rule a line breaks, null for a clean line; ``broken`` is the text of a record cut in two."""
    price, quantity = to_number("UnitPrice"), to_number("Quantity")
    # Only a cancellation may carry a negative quantity.
    size = F.when(starts_with_c("InvoiceNo"), F.abs(quantity)).otherwise(quantity)
    good = [
        ~is_blank("InvoiceNo"),
        ~is_blank("StockCode"),
        (price > 0) & (price <= MAX_PRICE),
        (size > 0) & (size <= MAX_QUANTITY),
        to_moment("InvoiceDate").isNotNull(),
    ]
    chain = F if broken is None else F.when(broken.isNotNull(), BROKEN_REASON)
    for passed, reason in zip(good, REASONS):
        chain = chain.when(~F.coalesce(passed, F.lit(False)), reason)
    return chain.otherwise(None)


def gate(raw: DataFrame) -> DataFrame:
    return raw.withColumn(REASON, rejection_reason(F.col(BROKEN_RECORD) if BROKEN_RECORD in raw.columns else None))


def clean_lines(raw: DataFrame) -> DataFrame:
    kept = [c for c in raw.columns if c in RAW_COLUMNS or c in SOURCE_COLUMNS]
    return gate(raw).filter(col(REASON).isNull()).select(*kept)


def rejected_lines(raw: DataFrame, batch_id: Column | str, logged_at: Column) -> DataFrame:
    return rejected_of(gate(raw), batch_id, logged_at)


def rejected_of(gated: DataFrame, batch_id: Column | str, logged_at: Column) -> DataFrame:
    tagged = gated.filter(col(REASON).isNotNull())
    batch = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    return tagged.withColumns({"batch_id": batch, "logged_at": logged_at}).select(*REJECT_COLUMNS)


def summary_of(gated: DataFrame, batch_id: str) -> DataFrame:
    """One row: totals, pass rate and the count of each reason."""
    valid = F.count_if(col(REASON).isNull())
    total = F.count("*")
    counted = gated.agg(
        total.alias("total_records"),
        valid.alias("valid_records"),
        *[F.count_if(col(REASON) == r).alias(r.lower()) for r in reasons_of(gated)],
    )
    return counted.select(
        F.lit(batch_id).alias("batch_id"),
        "total_records",
        "valid_records",
        (col("total_records") - col("valid_records")).alias("rejected_records"),
        ratio(col("valid_records") * 100, "total_records", 2).alias("pass_rate_pct"),
        *[r.lower() for r in reasons_of(gated)],
    )


class Gated(NamedTuple):
    """Gated lines as stored, clean ones and rejected ones apart, and the counts taken while they were written."""

    lines: DataFrame
    totals: dict[str, int]

    @property
    def clean(self) -> DataFrame:
        return self._plain(self.lines.filter(~col(_REJECTED)))

    def clean_in_turns(self) -> list[DataFrame]:
        """Clean lines in frames that follow one another by day; lines of a day are in one frame."""
        return [self._plain(df) for df in in_turns(self.lines.filter(~col(_REJECTED)), _DAY)]

    @staticmethod
    def _plain(df: DataFrame) -> DataFrame:
        return df.select(*[c for c in df.columns if c in RAW_COLUMNS or c in SOURCE_COLUMNS])

    def rejected(self, batch_id: Column | str, logged_at: Column) -> DataFrame:
        return rejected_of(self.lines.filter(col(_REJECTED)).drop(_REJECTED), batch_id, logged_at)

    @property
    def pass_rate_pct(self) -> Decimal:
        total, valid = self.totals["total_records"], self.totals["valid_records"]
        share = Decimal(valid * 100) / total if total else Decimal(0)
        return share.quantize(Decimal("0.01"), ROUND_HALF_UP)


def gate_once(raw: DataFrame, path: str) -> Gated:
    """Gate a source in one pass: its lines are stored below ``path`` in two folders and counted by reason on the way.

    The counts are observed in the tasks that write, so a task that runs again counts once.
    """
    seen, found = Observation(), reasons_of(raw)
    valid = F.count_if(col(REASON).isNull())
    gated = gate(raw).observe(
        seen, F.count(F.lit(1)).alias("total_records"), valid.alias("valid_records"),
        *[F.count_if(col(REASON) == r).alias(r.lower()) for r in found])
    marked = gated.withColumns({_DAY: date_key(to_moment("InvoiceDate")), _REJECTED: col(REASON).isNotNull()})
    with freeing(raw.sparkSession):
        marked.write.partitionBy(_REJECTED).parquet(path)
    schema = T.StructType([*marked.schema.fields[:-1], T.StructField(_REJECTED, T.BooleanType())])
    totals = seen.get
    totals["rejected_records"] = totals["total_records"] - totals["valid_records"]
    return Gated(raw.sparkSession.read.schema(schema).parquet(path), totals)


def validate_batch(raw: DataFrame, batch_id: str, logged_at: Column | None = None):
    """(clean, rejected, summary) of a batch; three lazy plans over the same scan."""
    logged_at = F.current_timestamp().cast("timestamp_ntz") if logged_at is None else logged_at
    return clean_lines(raw), rejected_lines(raw, batch_id, logged_at), summary_of(gate(raw), batch_id)


def rejection_audit(rejected: DataFrame) -> DataFrame:
    """Count and share of each reason over all quarantined lines."""
    counts = rejected.groupBy(REASON).agg(F.count("*").alias("count"))
    return counts.withColumn("_total", F.sum("count").over(W.partitionBy())).select(
        REASON, "count", ratio(col("count") * 100, "_total", 2).alias("pct"))


def rejections_per_batch(rejected: DataFrame) -> DataFrame:
    counted = rejected.groupBy("batch_id", REASON).agg(F.count("*").alias("rejected_record_count"))
    return counted.orderBy(F.desc("rejected_record_count"), "batch_id", REASON)


def rejections_per_reason(rejected: DataFrame) -> DataFrame:
    counted = rejected.groupBy(REASON).agg(F.count("*").alias("rejection_count"))
    return counted.orderBy(F.desc("rejection_count"), REASON)
