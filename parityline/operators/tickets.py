"""Migration tickets: target selection and funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the ticket export.
DONE = "Done"
WONT_DO = "Won't Do"
UNKNOWN = "not_updated"
STATIC = "static"

_NAME = "eds_equivalent_table"
_REPLACED = "is_table_replaced"


def done_tickets(tickets: DataFrame) -> DataFrame:
    """Finished tickets, with missing names and flags spelled out."""
    return tickets.fillna(UNKNOWN, [_REPLACED, _NAME]).where(F.col("status") == DONE)


def _is_target() -> Column:
    return (
        F.col(_REPLACED).isin("No", UNKNOWN)
        & (F.col(_NAME) != UNKNOWN)
        & ~F.contains(F.col(_NAME), F.lit(STATIC))
    )


def target_tickets(tickets: DataFrame) -> DataFrame:
    """Finished tickets that are named, not replaced and not static."""
    return done_tickets(tickets).where(_is_target())


def status_counts(tickets: DataFrame) -> DataFrame:
    """Tickets per status; a null status is a group."""
    return tickets.groupBy("status").agg(F.count("*").alias("tickets"))


def replaced_counts(tickets: DataFrame) -> DataFrame:
    """Finished and named tickets per replacement flag."""
    named = done_tickets(tickets).where(F.col(_NAME) != UNKNOWN)
    return named.groupBy(_REPLACED).agg(F.count("*").alias("tickets"))


def ticket_funnel(tickets: DataFrame) -> DataFrame:
    """All funnel numbers in one pass, as one row."""
    filled = tickets.fillna(UNKNOWN, [_REPLACED, _NAME])
    done = F.col("status") == DONE
    named = done & (F.col(_NAME) != UNKNOWN)
    return filled.agg(
        F.count("*").alias("total"),
        F.count_if(done).alias("done"),
        F.count_if(F.col("status") == WONT_DO).alias("wont_do"),
        F.count_if(done & (F.col(_NAME) == UNKNOWN)).alias("name_missing"),
        F.count_if(named).alias("name_present"),
        F.count_if(named & (F.col(_REPLACED) == "Yes")).alias("replaced"),
        F.count_if(named & (F.col(_REPLACED) == "No")).alias("not_replaced"),
        F.count_if(named & (F.col(_REPLACED) == UNKNOWN)).alias("replaced_unknown"),
        F.count_if(done & _is_target()).alias("target"),
    )


def nonstandard_names(tickets: DataFrame) -> DataFrame:
    """Tickets whose name does not start like the production catalog's."""
    return tickets.where(F.col(_NAME).rlike("^[^p]"))
