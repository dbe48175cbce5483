"""Banded codes: an int whose hundreds are its band, so that predicates are ranges that reach the scan."""

from __future__ import annotations

from enum import IntEnum

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: of each kind its members, their codes, and the wire's character where there is one
_TABLES: dict[str, dict[str, tuple[int, str | None]]] = {
    "State": {
        "PENDING": (100, None), "PENDING_NEW": (110, "A"), "OPEN": (200, None), "NEW": (210, "0"), "ACCEPTED": (220, "D"),
        "PENDING_REPLACE": (230, "E"), "PENDING_CANCEL": (240, "6"), "SUSPENDED": (250, "9"), "STOPPED": (260, "7"), "PARTIAL": (300, None),
        "PARTIALLY_FILLED": (310, "1"), "DONE": (400, None), "FILLED": (410, "2"), "DONE_FOR_DAY": (420, "3"), "CALCULATED": (430, "B"),
        "CLOSED": (500, None), "CANCELLED": (510, "4"), "REPLACED": (520, "5"), "EXPIRED": (530, "C"), "FAILED": (600, None), "REJECTED": (610, "8"),
    },
    "Side": {
        "BUY": (100, "1"), "BUY_MINUS": (110, "3"), "BORROW": (120, "G"), "SUBSCRIBE": (130, "D"), "SELL": (200, "2"), "SELL_PLUS": (210, "4"),
        "SELL_SHORT": (220, "5"), "SELL_SHORT_EXEMPT": (230, "6"), "LEND": (240, "F"), "REDEEM": (250, "E"), "CROSS": (300, "8"),
        "CROSS_SHORT": (310, "9"), "CROSS_SHORT_EXEMPT": (320, "A"), "AS_DEFINED": (330, "B"), "OPPOSITE": (340, "C"), "UNDISCLOSED": (350, "7"),
    },
    "TimeInForce": {
        "IMMEDIATE": (100, None), "IOC": (110, "3"), "FOK": (120, "4"), "SESSION": (200, None), "DAY": (210, "0"), "AT_OPEN": (220, "2"),
        "AT_CLOSE": (230, "7"), "GTX": (240, "5"), "RESTING": (300, None), "GTC": (310, "1"), "GTD": (320, "6"),
    },
    "OrderKind": {
        "MARKET": (100, None), "MARKET_ORDER": (110, "1"), "MARKET_IF_TOUCHED": (120, "J"), "MARKET_TO_LIMIT": (130, "K"), "LIMIT": (200, None),
        "LIMIT_ORDER": (210, "2"), "LIMIT_ON_CLOSE": (220, "B"), "LIMIT_OR_BETTER": (230, "7"), "STOP": (300, None), "STOP_ORDER": (310, "3"),
        "STOP_LIMIT": (320, "4"), "PEGGED": (400, None), "PEGGED_ORDER": (410, "P"), "PREVIOUSLY_QUOTED": (420, "D"),
        "PREVIOUSLY_INDICATED": (430, "E"),
    },
    "ExecKind": {
        "STATUS": (100, None), "ACK": (110, "0"), "PENDING_NEW": (120, "A"), "PENDING_CANCEL": (130, "6"), "PENDING_REPLACE": (140, "E"),
        "ORDER_STATUS": (150, "I"), "RESTATED": (160, "D"), "CALCULATED": (170, "B"), "DONE_FOR_DAY": (180, "3"), "LIFECYCLE": (200, None),
        "CANCELLED": (210, "4"), "REPLACED": (220, "5"), "REJECTED": (230, "8"), "EXPIRED": (240, "C"), "SUSPENDED": (250, "9"),
        "STOPPED": (260, "7"), "TRADE": (300, None), "TRADED": (310, "F"), "PARTIAL_FILL": (320, "1"), "FILL": (330, "2"), "AMEND": (400, None),
        "TRADE_CORRECT": (410, "G"), "TRADE_CANCEL": (420, "H"),
    },
    "UpdateAction": {
        "APPLY": (100, None), "NEW": (110, "0"), "CHANGE": (120, "1"), "OVERLAY": (130, "5"), "REMOVE": (200, None), "DELETE": (210, "2"),
        "DELETE_THRU": (220, "3"), "DELETE_FROM": (230, "4"),
    },
    "AssetKind": {
        "CASH": (100, None), "EQUITY": (110, "E"), "DEBT": (120, "D"), "FUND": (130, "C"), "CURRENCY": (140, "T"), "COMMODITY": (150, "J"),
        "INDEX": (160, "M"), "DERIVATIVE": (200, None), "FUTURE": (210, "F"), "OPTION": (220, "O"), "SWAP": (230, "S"), "WARRANT": (240, "R"),
        "FORWARD": (250, None), "STRUCTURED": (300, None), "SPREAD": (310, None), "MULTILEG": (320, None), "BASKET": (330, None),
        "FINANCING": (400, None), "REPO": (410, None), "LOAN": (420, None),
    },
    "IdSource": {
        "REGISTERED": (100, None), "ISIN": (110, "4"), "CUSIP": (120, "1"), "SEDOL": (130, "2"), "COMMON": (140, "G"), "VENDOR": (200, None),
        "RIC": (210, "5"), "BLOOMBERG": (220, "A"), "LOCAL": (300, None), "WERTPAPIER": (310, "B"), "DUTCH": (320, "C"), "VALOREN": (330, "D"),
        "SICOVAM": (340, "E"), "BELGIAN": (350, "F"), "QUIK": (360, "3"), "VENUE": (400, None), "EXCHANGE": (410, "8"), "CTA": (420, "9"),
        "OPRA": (430, "J"), "CLEARING": (440, "H"), "MARKETPLACE": (450, "M"), "OTHER": (500, None), "CURRENCY": (510, "6"), "COUNTRY": (520, "7"),
        "ISDA_SPEC": (530, "I"), "ISDA_URL": (540, "K"), "CREDIT_LETTER": (550, "L"),
    },
    "OptionKind": {
        "PUT": (100, "0"), "CALL": (200, "1"),
    },
    "EventType": {
        "INTENT": (100, None), "ORDER": (110, None), "QUOTE": (120, None), "FACT": (200, None), "EXECUTION": (210, None), "STATE": (300, None),
        "BOOK_SIDE": (310, None), "BOOK": (320, None), "REFERENCE": (400, None), "INSTRUMENT": (410, None),
    },
}

# fixed values: what a security type settles as
SECURITY_TYPES: dict[str, tuple[str, ...]] = {
    "EQUITY": ("CS", "PS"),
    "FUND": ("MF",),
    "FUTURE": ("FUT",),
    "OPTION": ("OPT", "OOF", "OOP", "OOC"),
    "WARRANT": ("WAR",),
    "MULTILEG": ("MLEG",),
    "SWAP": ("CDS", "IRS", "FXSWAP"),
    "CURRENCY": ("FXSPOT", "CASH"),
    "FORWARD": ("FXFWD", "FXNDF", "FORWARD"),
    "REPO": ("REPO", "BUYSELL"),
    "LOAN": ("SECLOAN", "SECPLEDGE", "TERM", "RVLV", "RVLVTRM", "BRIDGE", "SWING"),
    "DEBT": ("CORP", "CB", "TBOND", "TNOTE", "TBILL", "TIPS", "MUNI", "GO", "REV", "MTN", "CP", "CD", "ABS", "MBS", "CMO", "FRN", "EUCORP", "EUSOV", "BRADY"),
}

UNKNOWN, PRIVATE = 0, 9000


class Banded(IntEnum):
    @property
    def band(self) -> int:
        return int(self) // 100 * 100

    @property
    def wire(self) -> str | None:
        return WIRE[type(self).__name__].get(int(self))

    @classmethod
    def of_wire(cls, char: str | None) -> int:
        """The code of a wire character, case-sensitive; 0 if there is none."""
        return next((c for c, w in WIRE[cls.__name__].items() if w == char), UNKNOWN) if char else UNKNOWN

    @classmethod
    def of_code(cls, code: int) -> int:
        """The code itself if it is known or private, else its band, else 0."""
        known = {int(m) for m in cls}
        return code if code in known or code >= PRIVATE else code // 100 * 100 if code // 100 * 100 in known else UNKNOWN


WIRE: dict[str, dict[int, str]] = {}


def _build(name: str) -> type[Banded]:
    members = _TABLES[name]
    WIRE[name] = {code: wire for code, wire in members.values() if wire is not None}
    return Banded(name, {"UNKNOWN": 0} | {member: code for member, (code, _) in members.items()}, module=__name__)


State, Side, TimeInForce, OrderKind, ExecKind = map(_build, ("State", "Side", "TimeInForce", "OrderKind", "ExecKind"))
UpdateAction, AssetKind, IdSource, OptionKind, EventType = map(_build, ("UpdateAction", "AssetKind", "IdSource", "OptionKind", "EventType"))


def of_wire(kind: type[Banded], char: Column) -> Column:
    """The code of a wire character, 0 for null and anything unknown."""
    pairs = [F.lit(x) for code, w in WIRE[kind.__name__].items() for x in (w, code)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), char), F.lit(UNKNOWN)).cast("int")


def to_wire(kind: type[Banded], code: Column) -> Column:
    pairs = [F.lit(x) for c, w in WIRE[kind.__name__].items() for x in (c, w)]
    return F.try_element_at(F.create_map(*pairs), code.cast("int"))


def of_code(kind: type[Banded], code: Column) -> Column:
    known = [int(m) for m in kind]
    band = F.floor(code / 100).cast("int") * 100
    return F.when(code.isin(known) | (code >= PRIVATE), code).when(band.isin(known), band).otherwise(UNKNOWN).cast("int")


def band(code: Column) -> Column:
    return (F.floor(code / 100) * 100).cast("int")


def in_band(code: Column, low: int) -> Column:
    """A range, which is pushed to the scan where a computed band would not be."""
    return (code >= low) & (code < low + 100)


def is_live(state: Column) -> Column:
    return (state >= 200) & (state < 400)


def is_terminal(state: Column) -> Column:
    return state >= 400


def moves_shares(kind: Column) -> Column:
    """Trades, and corrections and cancellations of trades as well."""
    return kind >= 300


def removes(action: Column) -> Column:
    return action >= 200


def rests(tif: Column) -> Column:
    return tif >= 200


def is_derivative(asset: Column) -> Column:
    return asset >= 200


def is_snapshot(etype: Column) -> Column:
    return etype >= 300


def is_registered(source: Column) -> Column:
    return in_band(source, 100)


def sign(side: Column) -> Column:
    """1 for the buying band, -1 for the selling one, 0 for the rest."""
    return F.when(in_band(side, 100), 1).when(in_band(side, 200), -1).otherwise(0)


def opposite(side: Column) -> Column:
    return F.when(in_band(side, 100), int(Side.SELL)).when(in_band(side, 200), int(Side.BUY)).otherwise(UNKNOWN)


def update_action(before: Column, after: Column) -> Column:
    return F.when(after <= 0, int(UpdateAction.DELETE)).when(before > 0, int(UpdateAction.CHANGE)).otherwise(int(UpdateAction.NEW))


def asset_kind(cfi: Column, security_type: Column) -> Column:
    """By the first letter of the CFI code, else by the security type, else 0."""
    pairs = [F.lit(x) for kind, names in SECURITY_TYPES.items() for n in names for x in (n, int(AssetKind[kind]))]
    by_type = F.try_element_at(F.create_map(*pairs), F.upper(F.trim(security_type)))
    by_cfi = of_wire(AssetKind, F.substring(cfi, 1, 1))
    return F.coalesce(F.when(by_cfi != 0, by_cfi), by_type, F.lit(UNKNOWN)).cast("int")
