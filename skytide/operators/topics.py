"""Which service a topic belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytide.naming import DEFAULT_NAMING, HIDDEN_TOPICS, SERVICES, TRANSFER_PREFIX, XMATCH_PREFIX, Naming


def service_of(topic: Column | str, naming: Naming = DEFAULT_NAMING) -> Column:
    """Service class of a topic; null for broker-internal topics."""
    t = F.col(topic) if isinstance(topic, str) else topic
    return (
        F.when(t.isin(*HIDDEN_TOPICS), F.lit(None).cast("string"))
        .when(t.startswith(TRANSFER_PREFIX), "datatransfer")
        .when(t.startswith(XMATCH_PREFIX), "xmatch")
        .when(t.startswith(naming.stats_prefix), "stats")
        .otherwise("livestream")
    )


def topic_catalogue(log: DataFrame, service: str | None = None, naming: Naming = DEFAULT_NAMING) -> DataFrame:
    """Distinct topics with their service, hidden ones left out."""
    if service is not None and service not in SERVICES:
        raise ValueError(f"{service!r} is not a valid service, expected one of {', '.join(SERVICES)}")
    found = log.select("topic").distinct().withColumn("service", service_of("topic", naming))
    found = found.filter(F.col("service").isNotNull())
    return found if service is None else found.filter(F.col("service") == service)


def check_transfer_topic(topic: str) -> None:
    if not topic.startswith((TRANSFER_PREFIX, XMATCH_PREFIX)):
        raise ValueError(f"{topic!r} is not a bulk topic: it must start with {TRANSFER_PREFIX} or {XMATCH_PREFIX}")
