"""Tag dictionaries: from JSON per version, from specification XML, or the tags this library knows; lookup and ranked search."""

from __future__ import annotations

import json
import zipfile
from pathlib import Path
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import tags

SCHEMA = "version string, tag int, name string, type string, description string, required boolean, symbols map<string,string>"


def builtin() -> list[tuple]:
    lifted = {t: n for t, n, _ in tags.LIFTED}
    kinds = {t: k for t, _, k in tags.LIFTED}
    words = {"S": "String", "L": "int", "D": "float", "B": "Boolean", "X": "data", "N": "UTCTimestamp"}
    names = {t: n for n, t in tags.TAG_OF.items()}
    return [("builtin", t, names.get(t, lifted.get(t, str(t)).replace("_", "")), words[kinds.get(t, "S")], lifted.get(t), None, None) for t in sorted({*lifted, *names})]


def from_xml(text: str) -> list[tuple]:
    """Fields of a specification with their enumerations; those in the header or trailer know whether they are required."""
    root = ElementTree.fromstring(text)
    version = f"{root.get('type', 'FIX')}.{root.get('major')}.{root.get('minor')}"
    session = {f.get("name"): f.get("required") == "Y" for part in ("header", "trailer") for f in root.findall(f"./{part}/field")}
    return [
        (version, int(f.get("number")), f.get("name"), f.get("type"), None, session.get(f.get("name")), {v.get("enum"): v.get("description") for v in f.findall("value")} or None)
        for f in root.findall("./fields/field")
    ]


def from_folder(path: str) -> list[tuple]:
    """JSON documents by version (``<version>.json``: a list of fields) in a folder or a zip archive."""
    p = Path(path)
    if p.suffix == ".zip":
        with zipfile.ZipFile(p) as z:
            docs = {Path(n).stem: z.read(n).decode() for n in z.namelist() if n.endswith(".json")}
    else:
        docs = {f.stem: f.read_text() for f in sorted(p.glob("*.json"))}
    return [(v, int(f["tag"]), f["name"], f.get("type"), f.get("description"), f.get("required"), f.get("values")) for v, text in docs.items() for f in json.loads(text)]


def dictionary(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """Some thousand rows at most, given by the documents."""
    return spark.createDataFrame(rows if rows is not None else builtin(), SCHEMA)


def lookup(d: DataFrame, key: int | str) -> DataFrame:
    """By tag or by name in any case, the newest version first."""
    hit = F.col("tag") == int(key) if str(key).isdigit() else F.lower("name") == str(key).lower()
    return d.where(hit).orderBy(F.desc("version"))


def search(d: DataFrame, text: str, limit: int = 20, fuzzy: int = 2) -> DataFrame:
    """Ranked: the tag or whole name, a name's beginning, a part of it, a part of the description, a name at most ``fuzzy`` letters off."""
    low = text.lower()
    name = F.lower("name")
    near = F.levenshtein(name, F.lit(low), fuzzy)
    rank = (
        F.when((F.col("tag").cast("string") == low) | (name == low), 0).when(F.startswith(name, F.lit(low)), 1).when(F.contains(name, F.lit(low)), 2)
        .when(F.contains(F.lower(F.coalesce("description", F.lit(""))), F.lit(low)), 3).when(near >= 0, 4 + near)
    )
    return d.withColumn("rank", rank).where(F.col("rank").isNotNull()).orderBy("rank", F.desc("version"), "tag").limit(limit)
