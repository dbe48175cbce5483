"""Physical lines of several programs into one record per entry.

A line starts an entry if it bears one of the timestamp headers below; the lines up to the next start belong to it. Files
are cut into blocks of ``BLOCK`` line numbers, so that one huge file is spread over many tasks: each block finds its own
starts, and only the last start of each block travels to the blocks behind it. Entries are then put together by file and
first line, and their fields are read by an ordered cascade of patterns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 8192

#: Stands between the groups of a header; a private character that no log has.
_CUT = "\ue0f1"

# fixed values: printed severities and what they count as
LEVELS = {
    "DEBUG": ("TRACE", "TRC", "FINEST", "FINER", "FINE", "CONFIG", "VERBOSE", "DEBUG", "DBG", "7"),
    "INFO": ("INFO", "INF", "INFORMATION", "NOTICE", "NTC", "6", "5"),
    "WARNING": ("WARNING", "WARN", "WRN", "4"),
    "ERROR": ("ERROR", "ERR", "SEVERE", "3"),
    "FATAL": ("FATAL", "FTL", "CRITICAL", "CRIT", "CRT", "ALERT", "EMERGENCY", "EMERG", "PANIC", "2", "1", "0"),
}

_DIGITS = "0123456789"
_WORDS = "|".join(w for words in LEVELS.values() for w in words if not w.isdigit())


@dataclass(frozen=True)
class Layout:
    """``start`` tells a first line and has its fields as groups, named here by position (Java has no underscores in names); such a line begins with one
    of ``lead``, after a blank at most."""

    name: str
    lead: str
    start: str
    groups: tuple[str, ...]


#: In the order in which they are tried.
LAYOUTS = (
    Layout("bracket", _DIGITS, r"(?s)^[ \t]?(\d{4}-\d\d-\d\d[ T]\d\d:\d\d:\d\d[.,]\d{3}(?:[._,]?\d{3})?) \[([^\]]*)\] \[([^\]]*)\](?: \((?i:(" + _WORDS + r"))\))?(?: (.*))?\z", ("stamp", "thread", "driver", "level", "message")),
    Layout("angle", _DIGITS, r"(?s)^(\d{4}-\d\d-\d\d[ T]\d\d:\d\d:\d\d(?:[.,]\d{1,9})?(?:Z|[+-]\d\d:?\d\d)?) +([A-Za-z]+) +(\S+) +<([^>]*)> -(?: (.*))?\z", ("stamp", "level", "driver", "thread", "message")),
    Layout("syslog", "<", r"(?s)^<(\d{1,3})>\d{1,2} (\S+) \S+ (\S+) (\S+) \S+ (?:-|\[.*?\])(?: (.*))?\z", ("priority", "stamp", "driver", "thread", "message")),
    Layout("json", "{", r"(?s)^[ \t]?(\{\s*\".*\})\s*\z", ("body",)),
    Layout("julian", "ADFJMNOS", r"(?s)^([A-Z][a-z]{2} \d{1,2}, \d{4} \d{1,2}:\d\d:\d\d [AP]M) (\S+)(?: \S+)?\s*\z", ("stamp", "driver")),
    Layout("pairs", "t", r"(?s)^time=(\"[^\"]*\"|\S+)((?: .*)?)\z", ("stamp", "rest")),
)


def level_of(printed: Column) -> Column:
    """The canonical level of a printed word or digit of severity, '' for anything else."""
    out = F.lit("")
    for level, words in LEVELS.items():
        out = F.when(F.upper(F.trim(printed)).isin(*words), level).otherwise(out)
    return F.when(printed.isNull(), "").otherwise(out)


def stripped(text: Column) -> Column:
    """``text`` without white space at either end, Unicode blanks and separators included."""
    return F.regexp_replace(text, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def instant_nanos(stamp: Column) -> Column:
    """An ISO-like stamp (date, blank or T, time, fraction in one or two groups, zone or none: UTC) as nanoseconds, null if it is none."""
    whole = r"^(\d{4}-\d\d-\d\d)[ T](\d\d:\d\d:\d\d)(?:[.,](\d{1,9})(?:[._,](\d{3}))?)?(Z|z|[+-]\d\d:?\d\d)?$"
    part = lambda i: F.regexp_extract(stamp, whole, i)
    seconds = F.unix_seconds(F.try_to_timestamp(F.concat(part(1), F.lit(" "), part(2), F.lit("+00:00")), F.lit("yyyy-MM-dd HH:mm:ssXXX")))
    fraction = F.rpad(F.concat(part(3), part(4)), 9, "0").cast("long")
    zone = F.regexp_replace(part(5), ":", "")
    off = F.when(F.length(zone) == 5, (F.substring(zone, 2, 2).cast("int") * 3600 + F.substring(zone, 4, 2).cast("int") * 60) * F.when(F.substring(zone, 1, 1) == "-", -1).otherwise(1)).otherwise(0)
    # a bare number counts seconds, or as many thousandths, millionths or billionths as its length tells
    digits, more = (F.regexp_extract(stamp, r"^(\d{9,19})(?:\.(\d{1,9}))?$", i) for i in (1, 2))
    scale = F.when(F.length(digits) <= 11, 9).when(F.length(digits) <= 14, 6).when(F.length(digits) <= 17, 3).otherwise(0)
    epoch = F.concat(digits, F.substring(F.rpad(more, 9, "0"), F.lit(1), scale)).try_cast("long")
    return F.when(part(1) != "", (seconds - off) * 1_000_000_000 + fraction).when(digits != "", epoch)


def _first(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(text, pattern, group)


def entries_of(lines: DataFrame, block: int = BLOCK) -> DataFrame:
    """``url, line_no, last_line_no, layout, head, tail`` per entry of ``lines`` (``url, line_no, text``).

    ``tail`` is the further lines joined by newlines, null if there are none. A null text is an empty line; lines
    without a ``url`` or ``line_no`` have no place and give nothing, as do lines before the first entry of a file.
    """
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"\r+\z", "")
    layout = F.lit(None).cast("string")
    lead = F.when(F.substring("t", 1, 1).isin(" ", "\t"), F.substring("t", 2, 1)).otherwise(F.substring("t", 1, 1))
    for known in reversed(LAYOUTS):
        hit = lead.isin(*known.lead) & F.col("t").rlike(known.start)
        if known.name == "json":
            hit = hit & F.get_json_object("t", "$.ts").isNotNull()
        layout = F.when(hit, known.name).otherwise(layout)
    rows = (
        lines.where(F.col("url").isNotNull() & F.col("line_no").isNotNull())
        .select("url", "line_no", text.alias("t")).withColumn("layout", layout)
        .withColumn("block", F.floor(F.col("line_no") / block))
    )
    here = Window.partitionBy("url", "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("start", F.max(F.when(F.col("layout").isNotNull(), F.col("line_no"))).over(here))
    before = Window.partitionBy("url").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy("url", "block").agg(F.max("start").alias("last")).select("url", "block", F.max("last").over(before).alias("carried"))
    rows = rows.join(carried, ["url", "block"]).withColumn("start", F.coalesce("start", "carried")).where(F.col("start").isNotNull())
    further = F.transform(F.array_sort(F.collect_list(F.when(F.col("layout").isNull(), F.struct("line_no", "t")))), lambda x: x["t"])
    return (
        rows.groupBy("url", "start")
        .agg(F.max("line_no").alias("last_line_no"), F.max("layout").alias("layout"), F.max(F.when(F.col("layout").isNotNull(), F.col("t"))).alias("head"), further.alias("further"))
        .select("url", F.col("start").alias("line_no"), "last_line_no", "layout", "head", F.when(F.size("further") > 0, F.array_join("further", "\n")).alias("tail"))
    )


def _unquoted(value: Column) -> Column:
    """A pair's value without its quotes, backslash escapes undone."""
    inner = F.regexp_extract(value, r'(?s)^"(.*)"$', 1)
    marked = F.replace(inner, F.lit("\\\\"), F.lit("\x00"))
    for mark, sign in (('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t")):
        marked = F.replace(marked, F.lit(mark), F.lit(sign))
    return F.when(value.startswith('"'), F.replace(marked, F.lit("\x00"), F.lit("\\"))).otherwise(value)


def records(lines: DataFrame, block: int = BLOCK) -> DataFrame:
    """One record per entry: ``url, line_no, last_line_no, unix, level, driver_name, thread_name, message``.

    ``unix`` is null where a header's stamp is no instant; absent fields are ''. See :func:`entries_of` for lines
    that give nothing.
    """
    found = entries_of(lines, block)
    by = {x.name: x for x in LAYOUTS}
    # all groups of a header by one pass of its pattern; the last group may hold anything
    cut = F.lit(None).cast("array<string>")
    for x in LAYOUTS:
        groups = F.regexp_replace("head", x.start, _CUT.join(f"${i + 1}" for i in range(len(x.groups))))
        cut = F.when(F.col("layout") == x.name, F.split(groups, _CUT, len(x.groups))).otherwise(cut)
    found = found.withColumn("cut", cut)

    def group(layout: str, name: str) -> Column:
        return F.get("cut", F.lit(by[layout].groups.index(name)))

    def pick(**of: Column) -> Column:
        out = F.lit(None).cast("string")
        for layout, value in of.items():
            out = F.when(F.col("layout") == layout, value).otherwise(out)
        return out

    found = found.withColumn("pairs", F.when(F.col("layout") == "pairs", F.regexp_extract_all(group("pairs", "rest"), F.lit(r' [^\s=]+=(?:"(?:[^"\\]|\\.)*"|\S*)'), F.lit(0))))
    pair = lambda name: _unquoted(F.substring(F.get(F.filter("pairs", lambda t: F.startswith(t, F.lit(f" {name}="))), F.lit(0)), F.lit(len(name) + 3), F.lit(1 << 30)))
    body = F.from_json(group("json", "body"), "ts string, level string, logger string, thread string, msg string")
    severity = F.pmod(group("syslog", "priority").try_cast("int"), F.lit(8)).cast("string")
    said = r"(?s)^([A-Za-z]+):(?: |$|\n)?"
    dash = lambda c: F.when(c == "-", "").otherwise(c)
    julian_stamp = F.unix_seconds(F.try_to_timestamp(group("julian", "stamp"), F.lit("MMM d, yyyy h:mm:ss a"))) * 1_000_000_000
    rows = found.withColumn("body", F.when(F.col("layout") == "json", body)).withColumn("said", F.when(F.col("layout") == "julian", _first("tail", said)))
    stamp = pick(bracket=group("bracket", "stamp"), angle=group("angle", "stamp"), syslog=group("syslog", "stamp"), json=F.col("body.ts"), pairs=_unquoted(group("pairs", "stamp")))
    level = pick(bracket=group("bracket", "level"), angle=group("angle", "level"), syslog=severity, json=F.col("body.level"), julian=F.col("said"), pairs=pair("level"))
    driver = pick(bracket=group("bracket", "driver"), angle=group("angle", "driver"), syslog=dash(group("syslog", "driver")), json=F.col("body.logger"), julian=group("julian", "driver"), pairs=pair("component"))
    thread = pick(bracket=group("bracket", "thread"), angle=group("angle", "thread"), syslog=dash(group("syslog", "thread")), json=F.col("body.thread"), pairs=pair("thread"))
    message = pick(bracket=group("bracket", "message"), angle=group("angle", "message"), syslog=group("syslog", "message"), json=F.col("body.msg"), pairs=pair("msg"))
    known = level_of(F.col("said")) != ""
    tail = F.when((F.col("layout") == "julian") & known, F.regexp_replace("tail", r"(?s)^[A-Za-z]+:[ ]?", "")).otherwise(F.col("tail"))
    whole = F.when(F.col("layout") == "julian", F.coalesce(tail, F.lit(""))).otherwise(F.concat_ws("\n", F.coalesce(message, F.lit("")), tail))
    return rows.select(
        "url", "line_no", "last_line_no",
        F.when(F.col("layout") == "julian", julian_stamp).otherwise(instant_nanos(stamp)).alias("unix"),
        level_of(level).alias("level"), F.coalesce(driver, F.lit("")).alias("driver_name"), F.coalesce(thread, F.lit("")).alias("thread_name"),
        stripped(whole).alias("message"),
    )
