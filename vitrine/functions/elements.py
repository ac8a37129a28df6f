"""Elements of a page with their text, by a state machine over its tags, in native expressions.

One pass finds the tags that matter (those of the wanted element and of the elements that bound it), another cuts the page at them. An `aggregate` then goes
through the tags in order and keeps a stack of what is open. As in a parser, an end tag closes its own element
and all that is open inside, one without a start tag is ignored, some elements end where their next sibling or their container's
end begins, and what is still open ends with the page. Comments, scripts and styles are taken out first.

A step costs a few searches in a short text: the stack is written as ',name@tag number' for what is open, innermost first. Texts are not
touched until it is known which pieces are whose.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions import text

# Possessive runs up to the next character that could end them: no place is tried twice.
_HIDDEN = r"(?is)<!--(?:[^-]++|-(?!->))*+(?:-->)?|<(script|style)\b[^>]*+>(?:[^<]++|<(?!/\1\s*>))*+(?:</\1\s*>)?"
_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_ANY_DEPTH = 1 << 30

LISTS = ("ul", "ol", "menu")
SECTIONS = ("article", "aside", "body", "div", "footer", "header", "main", "nav", "section", "table", "td")
BLOCKS = ("address", "article", "aside", "blockquote", "body", "div", "footer", "form", "header", "main", "nav", "ol", "section", "table", "td", "th", "ul", "li")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often it stands there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def elements(html: Column, tag: str, containers: Sequence[str] = (), siblings_end: bool = False, containers_end: bool = False, apart: Sequence[str] = ()) -> Column:
    """All `tag` elements of a page in order, as structs of their start tag (`open`) and the markup inside (`text`, inner tags that don't matter included).

    containers: elements whose end closes a `tag` open inside and whose start hides one open outside. siblings_end: a start tag closes
    an element of the same kind in the same container, as for `li` and `p`. containers_end: so does the start of a container, as for `p`.
    apart: elements whose text is not part of what they stand in; `tag` itself is one of them, if there are any.
    """
    if apart and tag not in apart:
        raise ValueError("an element without the text of others is without that of its own kind")
    tags = rf"(?is)</?(?:{'|'.join([tag, *(c for c in containers if c != tag)])})(?=[\s/>]){_ATTRIBUTES}"

    def event(t: Column, i: Column) -> Column:
        """What a tag does: its entry on the stack, and what it closes (`needle`) if that is among the innermost `depth` characters."""
        name = F.translate(F.regexp_extract(t, r"^</?([A-Za-z0-9]+)", 1), ascii_uppercase, ascii_lowercase)
        end = F.startswith(t, F.lit("</"))
        ends_top = [name == tag] * siblings_end + [name != tag] * containers_end
        needle = F.when(end, F.concat(F.lit(","), name, F.lit("@")))
        for case in ends_top:
            needle = needle.when(case, F.lit(f",{tag}@"))
        deep = end & ((name != tag) | F.lit(tag in containers))  # else what it closes must be on top
        entry = F.when(~end, F.concat(F.lit(","), name, F.lit("@"), i.cast("string")))
        return F.struct(needle.alias("needle"), F.when(deep, F.lit(_ANY_DEPTH)).otherwise(F.lit(1)).alias("depth"), entry.alias("entry"))

    def step(state: Column, e: Column, note: Callable[[Column, Column, Column], Column]) -> Column:
        place = F.position(e["needle"], state["stack"])

        def moved(after: Column) -> Column:
            """The state with the stack cut at a place."""
            rest = F.concat(F.coalesce(e["entry"], F.lit("")), F.substring(state["stack"], after, F.lit(_ANY_DEPTH)))
            return F.struct(rest.alias("stack"), (state["n"] + 1).alias("n"), note(state, after, rest).alias("notes"))

        end_of_closed = F.position(F.lit(","), state["stack"], place + 1)
        return _bound(F.when(place.between(F.lit(1), e["depth"]), end_of_closed).otherwise(F.lit(1)), moved)

    def run(found: Column, kind: str, note: Callable[[Column, Column, Column], Column], finish: Callable[[Column], Column]) -> Column:
        start = F.expr(f"named_struct('stack', ',', 'n', 0, 'notes', cast(array() as array<{kind}>))")
        return F.aggregate(F.transform(found, event), start, lambda state, e: step(state, e, note), finish)

    def between(found: Column, pieces: Column) -> Column:
        """Texts from a start tag to where it is closed."""
        def closed(gone: Column, n: Column) -> Column:
            return F.transform(F.regexp_extract_all(gone, F.lit(rf",{tag}@(\d+)"), F.lit(1)), lambda at: F.struct(at.cast("int").alias("at"), n.alias("end")))

        def note(state: Column, after: Column, _: Column) -> Column:
            gone = F.substring(state["stack"], F.lit(1), after - 1)
            return F.when(F.contains(gone, F.lit(f",{tag}@")), F.concat(state["notes"], closed(gone, state["n"]))).otherwise(state["notes"])

        spans_ = run(found, "struct<at:int,end:int>", note, lambda state: F.concat(state["notes"], closed(state["stack"], state["n"])))
        return F.transform(F.sort_array(spans_), lambda s: F.struct(F.get(found, s["at"]).alias("open"), F.array_join(F.slice(pieces, s["at"] + 2, s["end"] - s["at"]), " ").alias("text")))

    def own(found: Column, pieces: Column) -> Column:
        """Texts of which a `tag` is the innermost of the elements that stand apart."""
        others = "|".join(a for a in apart if a != tag)
        innermost = (rf",(?:{others})@|" if others else "") + rf",{tag}@(\d+)"
        owners = run(found, "string", lambda state, _, rest: F.concat(state["notes"], F.array(F.regexp_extract(rest, innermost, 1))), lambda state: state["notes"])
        placed = F.transform(owners, lambda o, i: F.when(o != "", F.struct(o.cast("int").alias("of"), i.alias("at"), F.get(pieces, i + 1).alias("text"))))
        # No piece holds a start tag, so the texts are cut at one again.
        mark = f"<{tag}>"
        joined = F.array_join(F.transform(F.sort_array(F.filter(placed, lambda p: p.isNotNull())), lambda p: F.concat(F.when(p["of"] == p["at"], F.lit(mark)).otherwise(F.lit(" ")), p["text"])), "")
        texts = F.slice(F.split(joined, mark, -1), F.lit(2), F.lit(_ANY_DEPTH))
        opens = F.filter(found, lambda t: F.regexp_like(t, F.lit(rf"(?i)^<{tag}(?=[\s/>])")))
        return F.zip_with(opens, texts, lambda o, t: F.struct(o.alias("open"), t.alias("text")))

    def cut(page: Column) -> Column:
        found = F.regexp_extract_all(page, F.lit(tags), F.lit(0))
        return _bound(F.struct(found.alias("found"), F.split(page, tags, -1).alias("pieces")), lambda c: (own if apart else between)(c["found"], c["pieces"]))

    return _bound(F.regexp_replace(html, _HIDDEN, " "), cut)


def attribute(start_tag: Column, name: str) -> Column:
    """Value of an attribute of a start tag, references resolved; null without it."""
    written = F.nullif(F.regexp_extract(start_tag, rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1), F.lit(""))
    return _bound(F.regexp_replace(written, r"""(?s)^(["'])(.*)\1$""", "$2"), text.unescape_entities)


def spans(html: Column) -> Column:
    """(open, text) of every span; one left open ends with the paragraph, item or section it stands in."""
    return elements(html, "span", ("p", "li", *SECTIONS))


def list_items(html: Column) -> Column:
    """The text of every list item without the lists inside it; items end at the next one or with their list."""
    return _texts(elements(html, "li", (*LISTS, *SECTIONS), siblings_end=True, apart=(*LISTS, "li")))


def paragraphs(html: Column) -> Column:
    """The text of every paragraph; a paragraph ends at the next block."""
    return _texts(elements(html, "p", BLOCKS, siblings_end=True, containers_end=True))


def links(html: Column) -> Column:
    """(href, text) of every link; a link ends at the next one."""
    return F.transform(elements(html, "a", siblings_end=True), lambda a: F.struct(attribute(a["open"], "href").alias("href"), shown(a).alias("text")))


def shown(element: Column) -> Column:
    """The visible text of an element."""
    return _bound(F.regexp_replace(element["text"], text.TAG, " "), text.plain_text)


def _texts(found: Column) -> Column:
    return F.transform(found, shown)
