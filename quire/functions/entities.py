"""Character references of HTML as ``Column → Column``."""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
REPLACED = "�"


def named_references() -> dict[str, str]:
    """Names with their characters, from Python's own table, and the numbers 128 to 159, which mean Windows characters."""
    out = {name.removesuffix(";"): chars for name, chars in html.entities.html5.items() if name.endswith(";")}
    for n in range(128, 160):
        out[f"#{n}"] = bytes([n]).decode("cp1252", "replace")
    return out


def character(code: Column) -> Column:
    """The character of a code point; those that no document may hold become the replacement character."""
    fine = ((code >= 32) | code.isin(9, 10, 13)) & ~code.between(127, 159) & ~code.between(0xD800, 0xDFFF) & (code <= 0x10FFFF) & ~code.isin(0xFFFE, 0xFFFF)
    return F.when(fine, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit(REPLACED))


def _decoded(reference: Column) -> Column:
    body = F.substring(reference, 2, 1 << 20)
    name = F.regexp_extract(reference, "&([^;]*);", 1)
    code = F.when(body.startswith("#x") | body.startswith("#X"), F.conv(F.substring(name, 3, 8), 16, 10)).when(body.startswith("#"), F.substring(name, 2, 8)).cast("bigint")
    table = F.from_json(F.lit(json.dumps(named_references())), "map<string,string>")
    # the frequent ones need no search in the table
    common = F.when(name == "amp", "&").when(name == "lt", "<").when(name == "gt", ">").when(name == "quot", '"').when(name == "nbsp", "\xa0")
    windows = F.try_element_at(table, F.concat(F.lit("#"), code.cast("string")))
    return (
        common.when(code.between(128, 159), windows).when(code.isNotNull(), character(code)).otherwise(F.coalesce(F.try_element_at(table, name), reference))
    )


def html_unescape(c: Column) -> Column:
    """Decode numeric and named references once; an unknown name or a missing semicolon stays."""

    def scanned(t):
        parts = F.struct(F.split(t, REFERENCE, -1).alias("pieces"), F.regexp_extract_all(t, F.lit(REFERENCE), 0).alias("found"))
        return let(parts, lambda p: F.array_join(F.transform(p["pieces"], lambda x, i: F.concat(x, F.coalesce(let(F.get(p["found"], i), _decoded), F.lit("")))), ""))

    return let(c, lambda t: F.when(t.rlike(REFERENCE), scanned(t)).otherwise(t))
