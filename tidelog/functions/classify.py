"""What a line is, by the first rule that matches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions import tags
from tidelog.functions.codes import EventType


@dataclass(frozen=True)
class EventRule:
    pattern: str
    etype: int


@dataclass(frozen=True)
class ProtocolRule:
    """An empty pattern matches every line; with ``driver`` the line's driver has to match too."""

    protocol: str
    pattern: str = ""
    codec: str = "none"
    driver: str = ""


# fixed values: which message is what
EVENT_RULES = (
    EventRule(r"35=8(\D|$)|ExecutionReport", int(EventType.EXECUTION)),
    EventRule(r"35=[DFG](\D|$)|NewOrderSingle|OrderCancel(Request|Replace)", int(EventType.ORDER)),
    EventRule(r"35=X(\D|$)|MarketDataIncrementalRefresh", int(EventType.BOOK_SIDE)),
    EventRule(r"35=W(\D|$)|MarketDataSnapshot", int(EventType.BOOK)),
    EventRule(r"35=[SR](\D|$)|Quote(Request)?\b", int(EventType.QUOTE)),
    EventRule(r"35=d(\D|$)|SecurityDefinition", int(EventType.INSTRUMENT)),
)
PROTOCOL_RULES = (
    ProtocolRule("UL", tags.BRIDGE_WIRE, "ul"),
    ProtocolRule("FIX", tags.BEGIN, "fix"),
    ProtocolRule("UL", tags.BRIDGE, "ul"),
    ProtocolRule("OTHER"),
)


def event_type(message: Column, rules: tuple[EventRule, ...] = EVENT_RULES) -> Column:
    out = F.lit(0)
    for r in reversed(rules):
        out = F.when(message.rlike(r.pattern.replace("$", r"\z")), r.etype).otherwise(out)
    return out.cast("int")


def protocol(message: Column, driver: Column | None = None, rules: tuple[ProtocolRule, ...] = PROTOCOL_RULES) -> Column:
    """A rule for a driver is skipped where no driver column is given."""
    out = F.lit("OTHER")
    for r in reversed(rules):
        if r.driver and driver is None:
            continue
        hit = message.rlike(r.pattern) if r.pattern else F.lit(True)
        if r.driver:
            hit = hit & F.coalesce(driver.rlike(r.driver), F.lit(False))
        out = F.when(hit, r.protocol).otherwise(out)
    return out
