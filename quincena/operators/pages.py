"""Portal pages → option lists and the published data version."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quincena.fixed import PLACEHOLDER, VERSION_PATTERN
from quincena.functions.columns import parse_report_datetime


def select_block(selector_id: str) -> str:
    """Container pattern of a ``<select id=...>`` drop-down: tag and attribute
    names in any case, the id in either quote or none."""
    sid = rf"\Q{selector_id}\E"
    return rf"""(?is)<select\s(?:[^>]*\s)?id\s*=\s*(?:"{sid}"|'{sid}'|{sid}(?:\s|>))(?:[^>]*>)?(.*?)</select>"""


OPTION_ITEM = r"(?is)<option[^>]*>(.*?)</option>"

# A character reference, a run of other text, or a lone ampersand.
_TEXT_PARTS = r"(?s)&#?[A-Za-z0-9]+;|[^&]+|&"


def _character(part: Column) -> Column:
    """The character that a reference names; any other text as it is."""
    names = F.create_map(*[F.lit(x) for name, code in name2codepoint.items() for x in (name, chr(code))])
    named = F.try_element_at(names, F.regexp_extract(part, "^&([A-Za-z0-9]+);$", 1))
    decimal = F.nullif(F.regexp_extract(part, "^&#([0-9]{1,7});$", 1), F.lit(""))
    hexadecimal = F.nullif(F.regexp_extract(part, "^&#[xX]([0-9a-fA-F]{1,6});$", 1), F.lit(""))
    code = F.coalesce(decimal, F.conv(hexadecimal, 16, 10)).cast("int")
    is_character = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    numbered = F.when(is_character, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    return F.coalesce(named, numbered, part)


def element_text(html: Column) -> Column:
    """Text of an element as a reader sees it: comments and tags gone,
    character references decoded, blank space trimmed."""
    plain = F.regexp_replace(html, r"(?s)<!--.*?-->|<[^>]*>", "")
    text = F.array_join(F.transform(F.regexp_extract_all(plain, F.lit(_TEXT_PARTS), 0), _character), "")
    return F.regexp_replace(text, r"^[\s\xA0]+|[\s\xA0]+$", "")


def page_options(pages: DataFrame, container_pattern: str, item_pattern: str = OPTION_ITEM) -> DataFrame:
    """Texts of the items inside the first container matched on each page,
    with their position in the list; blank and placeholder entries dropped."""
    block = F.regexp_extract("html", container_pattern, 1)
    items = F.regexp_extract_all(block, F.lit(item_pattern), 1)
    exploded = pages.select("page_id", F.posexplode(items).alias("option_no", "raw"))
    return (exploded.select("page_id", "option_no", element_text(F.col("raw")).alias("option"))
            .where((F.length("option") > 0) & ~F.col("option").contains(PLACEHOLDER)))


def page_version(pages: DataFrame) -> DataFrame:
    """Data version stated on each page (NULL when the line is missing)."""
    text = F.regexp_extract("html", VERSION_PATTERN, 1)
    return pages.select("page_id", parse_report_datetime(F.nullif(text, F.lit(""))).alias("data_version"))
