"""Fields of HTML pages as Column expressions (inside the JVM).

`elements` finds whole elements however they nest: the page is cut into tags and texts, and one pass keeps the stack of open
elements. As in common lenient parsers, a closing tag ends the nearest open element of its name and all that are open within it; one
without an opening tag is passed over; what is never closed ends with the page.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse_whitespace, strip

# Entities that text extraction resolves; the ampersand last, so nothing is resolved twice.
ENTITIES = {
    "&nbsp;": " ",
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&amp;": "&",
}

# Attributes may hold > inside quotes.
_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_MARKUP = rf"(?is)<!--.*?-->|</?[a-z]{_ATTRIBUTES}>|<[!?][^>]*+>"


def tag_with_class(tag: str, css_class: str) -> str:
    """Pattern of an opening tag carrying a class among its classes."""
    return rf"""<{tag}\b[^>]*(?<![\w-])class\s*=\s*["'](?:[^"']*\s)?{css_class}(?:\s[^"']*)?["'][^>]*>"""


def unescape(text: Column) -> Column:
    for entity, character in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def inner_text(html: Column, separator: str = "") -> Column:
    """Text between the tags, entities resolved; tags turn into `separator`."""
    return unescape(F.regexp_replace(html, _MARKUP, separator))


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """Capture group of the first match, NULL (not an empty string) without a match."""
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(0))


def all_groups(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


# ---- elements --------------------------------------------------------------------------------------

# Elements that have no closing tag.
VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")

# The content of scripts and styles is no markup.
_TOKEN = (
    rf"(?is)<!--.*?-->|<(script|style)\b{_ATTRIBUTES}>.*?</\1\s*>|<[!?][^>]*+>"
    rf"|</?[a-z]{_ATTRIBUTES}>|<|[^<]++"
)
_NO_CONTENT = r"(?i)^<(?:[!?]|(?:script|style)\b)"
_TAG = r"^</?[A-Za-z]"
_TAG_NAME = r"^</?([A-Za-z][^\s/>]*)"
_STACK = "array<struct<name:string,label:string,place:int>>"
_FOUND = "array<struct<place:int,end:int,label:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def elements(html: Column, wanted: Mapping[str, str | tuple[str, ...]]) -> Column:
    """Array of structs (label, tag, inner HTML) of the wanted elements, nested ones too, in the order of their opening tags.

    `wanted` names, per label, the patterns that an opening tag has to meet; the first label that fits counts. Comments, scripts and
    styles are no part of the inner HTML. NULL gives NULL, an empty page an empty array.
    """
    patterns = {label: (p,) if isinstance(p, str) else p for label, p in wanted.items()}

    def label_of(token: Column) -> Column:
        fits = [(label, [token.rlike(p) for p in group]) for label, group in patterns.items()]
        return F.coalesce(*(F.when(reduce(and_, tests), F.lit(label)) for label, tests in fits))

    def tag_of(found: Column) -> Column:
        token, place = found["token"], found["place"]
        name = F.lower(F.regexp_extract(token, _TAG_NAME, 1))
        closing = token.startswith("</")
        return F.struct(
            name.alias("name"),
            place.alias("place"),
            closing.alias("closing"),
            (name.isin(*VOID_TAGS) | token.endswith("/>")).alias("empty"),
            F.when(~closing, label_of(token)).alias("label"),
        )

    def step(state: Column, tag: Column) -> Column:
        stack, found = state["stack"], state["found"]
        depth = F.array_position(stack.getField("name"), tag["name"]).cast("int")
        popped = F.filter(F.slice(stack, F.lit(1), depth), lambda e: e["label"].isNotNull())
        ended = F.transform(popped, lambda e: F.struct(e["place"], tag["place"].alias("end"), e["label"]))
        own = F.array(F.struct(tag["place"], tag["place"].alias("end"), tag["label"]))
        opened = F.array(F.struct(tag["name"], tag["label"], tag["place"]))
        return F.struct(
            F.when(~tag["closing"] & ~tag["empty"], F.concat(opened, stack))
            .when(tag["closing"] & (depth > 0), F.slice(stack, depth + 1, F.size(stack)))
            .otherwise(stack)
            .alias("stack"),
            F.when(tag["closing"] & (depth > 0) & F.exists(F.slice(stack, F.lit(1), depth), lambda e: e["label"].isNotNull()), F.concat(found, ended))
            .when(~tag["closing"] & tag["empty"] & tag["label"].isNotNull(), F.concat(found, own))
            .otherwise(found)
            .alias("found"),
        )

    def spans(tokens: Column) -> Column:
        placed = F.transform(tokens, lambda token, place: F.struct(token.alias("token"), place.alias("place")))
        tags = F.transform(F.filter(placed, lambda t: t["token"].rlike(_TAG)), tag_of)
        start = F.struct(F.array().cast(_STACK).alias("stack"), F.array().cast(_FOUND).alias("found"))
        unclosed = lambda s: F.transform(
            F.filter(s["stack"], lambda e: e["label"].isNotNull()),
            lambda e: F.struct(e["place"], F.size(tokens).alias("end"), e["label"]),
        )
        return F.aggregate(tags, start, step, lambda s: F.sort_array(F.concat(s["found"], unclosed(s))))

    def cut(tokens: Column) -> Column:
        return F.transform(
            spans(tokens),
            lambda f: F.struct(
                f["label"].alias("label"),
                F.get(tokens, f["place"]).alias("tag"),
                F.array_join(F.slice(tokens, f["place"] + 2, F.greatest(f["end"] - f["place"] - 1, F.lit(0))), "").alias("inner"),
            ),
        )

    tokens = F.filter(F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0)), lambda t: ~t.rlike(_NO_CONTENT))
    return _let(tokens, cut)


def inners(found: Column, label: str) -> Column:
    """Array with the inner HTML of the elements of a label."""
    return F.transform(F.filter(found, lambda e: e["label"] == label), lambda e: e["inner"])


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of an opening tag, entities resolved; NULL without it."""
    return unescape(first_group(tag, rf"""(?is)(?<![\w-]){name}\s*=\s*(?=["'])["']([^"']*)["']"""))


# ---- listing pages ---------------------------------------------------------------------------------

# The parts of a listing page.
LISTING_BLOCK = ("(?i)" + tag_with_class("div", "spost"), "(?i)" + tag_with_class("div", "clearfix"))
_SMALL = "(?i)" + tag_with_class("div", "small")
_DECISION_LINK = r"""(?is)<a\b[^>]*\bhref\s*=\s*["'][^"']*/direktori/putusan/"""
_BADGE_LINE = "(?i)" + tag_with_class("p", "card-text")
_BADGE = r"""(?is)<span\b[^>]*\bclass\s*=\s*["']badge badge-secondary["']"""


def listing_blocks(html: Column) -> Column:
    """Array with the HTML of each entry of a listing page."""
    return inners(elements(html, {"entry": LISTING_BLOCK}), "entry")


def entry_parts(block: Column) -> Column:
    """The elements of an entry that its fields are read from."""
    return elements(block, {"small": _SMALL, "link": _DECISION_LINK})


def listing_date(parts: Column) -> Column:
    """Decision date of an entry: the first small line reading `Putus : dd-mm-yyyy`."""
    lines = F.transform(inners(parts, "small"), lambda x: collapse_whitespace(inner_text(x, " ")))
    dated = F.filter(lines, lambda x: x.rlike(r"Putus\s*:\s*\d{2}-\d{2}-\d{4}"))
    return F.try_to_date(F.regexp_extract(F.get(dated, F.lit(0)), r"Putus\s*:\s*(\d{2}-\d{2}-\d{4})", 1), "dd-MM-yyyy")


def _first_link(parts: Column) -> Column:
    return F.get(F.filter(parts, lambda e: e["label"] == "link"), F.lit(0))


def listing_link(parts: Column) -> Column:
    return strip(attribute(_first_link(parts)["tag"], "href"))


def listing_number(parts: Column) -> Column:
    """Decision number: what follows `Nomor` in the link text, or the whole link text."""
    text = strip(inner_text(_first_link(parts)["inner"]))
    return F.coalesce(strip(first_group(text, r"Nomor\s+(.+)")), text)


def badge_lines(html: Column) -> Column:
    """Array of structs (label text, declared total or NULL) of the card lines of a listing page."""
    return F.transform(
        inners(elements(html, {"line": _BADGE_LINE}), "line"),
        lambda x: F.struct(
            collapse_whitespace(inner_text(x, " ")).alias("label"),
            strip(inner_text(F.get(inners(elements(x, {"badge": _BADGE}), "badge"), F.lit(0)))).try_cast("bigint").alias("total"),
        ),
    )


# ---- detail pages ----------------------------------------------------------------------------------

# The block with the parties, the defendant in it, the card with the documents.
_PARTIES = r"""(?is)<span\b[^>]*\bid\s*=\s*["']title_pihak["']"""
_DEFENDANT = r"(?i)Terdakwa:<br/?>\s*([^<]+)"
_CARD = r"""(?is)<div\b[^>]*\bclass\s*=\s*["']card-body bg-white["']"""
_CELL = r"(?i)<td\b"
_LINK = r"(?i)<a\b"


def detail_parts(html: Column) -> Column:
    """The elements of a detail page that its fields are read from."""
    return elements(html, {"parties": _PARTIES, "card": _CARD, "cell": _CELL})


def table_cells(parts: Column) -> Column:
    """Array with the inner HTML of every table cell, in page order."""
    return inners(parts, "cell")


def text_after(texts: str, labels: str, label: str) -> Column:
    """The cell text following the first cell labelled `label`; NULL without one.

    `texts` and `labels` name array columns with the text of every cell, as it is and stripped.
    """
    position = F.array_position(labels, label)
    return F.when(position > 0, F.get(texts, position.cast("int")))


def party_name(parts: Column) -> Column:
    """Defendant in the page title blocks."""
    return strip(unescape(first_group(F.array_join(inners(parts, "parties"), ""), _DEFENDANT)))


def pdf_link(parts: Column) -> Column:
    """Target of the second link of the first document card, or `no_pdf_file`."""
    card = F.get(inners(parts, "card"), F.lit(0))
    second = F.get(elements(card, {"link": _LINK}), F.lit(1))
    return F.coalesce(attribute(second["tag"], "href"), F.lit("no_pdf_file"))


def hrefs(html: Column) -> Column:
    """Array with the target of every link on a page."""
    return all_groups(html, r"""(?i)<a\s[^>]*href="([^"]*)\"""")
