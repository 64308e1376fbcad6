"""Names a broker deployment fixes: topic classes, id columns, time columns.

A deployment puts its own name in front of its topics and class column, so the
name is a parameter (``namespace``) and never a constant of this library.
"""

from __future__ import annotations

from dataclasses import dataclass

# Topic prefixes of the two bulk services and the hidden topic.
TRANSFER_PREFIX = "ftransfer_"
XMATCH_PREFIX = "fxmatch_"
HIDDEN_TOPICS = ("__consumer_offsets",)
SCHEMA_TOPIC_SUFFIX = "_schema"
REPLAYED_SUFFIX = "_replayed"
SERVICES = ("livestream", "datatransfer", "xmatch", "stats")

# Multi-messenger topics, without the namespace in front.
MMA_STREAMS = ("grb_bronze", "grb_silver", "grb_gold", "gw_bronze")

SURVEYS = ("ztf", "lsst")


@dataclass(frozen=True)
class Naming:
    namespace: str = "broker"
    portal_host: str = "portal.example.org"

    @property
    def mma_topics(self) -> tuple[str, ...]:
        return tuple(f"{self.namespace}_{name}" for name in MMA_STREAMS)

    @property
    def stats_prefix(self) -> str:
        return f"{self.namespace}_ztf_"

    @property
    def class_column(self) -> str:
        """Column, and partition strategy, holding the broker's own classification."""
        return f"{self.namespace}class"

    def schema_file(self, version: str, survey: str = "ztf") -> str:
        return f"distribution_schema_{self.namespace}_{survey}_{version}.avsc"


DEFAULT_NAMING = Naming()


@dataclass(frozen=True)
class SurveyLayout:
    """Where one survey keeps its measurements."""

    current: str
    history: str
    time: str
    time_format: str
    photometry: tuple[str, ...]
    key: tuple[str, ...]


# Field names of the two alert shapes.
LAYOUTS = {
    "ztf": SurveyLayout(
        current="candidate",
        history="prv_candidates",
        time="jd",
        time_format="jd",
        photometry=("magpsf", "sigmapsf", "diffmaglim", "fid", "jd"),
        key=("objectId", "candid"),
    ),
    "lsst": SurveyLayout(
        current="diaSource",
        history="prvDiaSources",
        time="midpointMjdTai",
        time_format="mjd",
        photometry=("psfFlux", "psfFluxErr", "band", "midpointMjdTai"),
        key=("diaSourceId",),
    ),
}


def layout(survey: str) -> SurveyLayout:
    if survey not in LAYOUTS:
        raise ValueError(f"unknown survey {survey!r}, expected one of {', '.join(SURVEYS)}")
    return LAYOUTS[survey]
