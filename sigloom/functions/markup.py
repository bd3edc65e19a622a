"""Markup as columns: entities, HTML and wiki text to plain text, links, titles, namespaces."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from html.entities import name2codepoint
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from sigloom.functions.text import let


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _code_point(number: Column) -> Column:
    """The character of a code point; null outside the Unicode range."""
    valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))


# A character reference behind its '&': hexadecimal or decimal without leading zeros, or a name.  A number with more
# digits than the largest code point is no reference.
_REFERENCE = (
    r"^(?:#[xX]0*([0-9a-fA-F]{1,6})(?![0-9a-fA-F])"
    r"|#0*([0-9]{1,7})(?![0-9])"
    r"|([a-zA-Z][a-zA-Z0-9]*));?"
)


def decode_entities(text: Column | str) -> Column:
    """Replace decimal, hexadecimal and named HTML character references; unknown ones stay as they are."""
    names = {**name2codepoint, "apos": ord("'")}
    named = F.create_map(*[F.lit(x) for name, code in sorted(names.items()) for x in (name, chr(code))])

    def character(part: Column) -> Column:
        hexadecimal = F.conv(F.nullif(F.regexp_extract(part, _REFERENCE, 1), F.lit("")), 16, 10).cast("bigint")
        decimal = F.nullif(F.regexp_extract(part, _REFERENCE, 2), F.lit("")).cast("bigint")
        name = F.element_at(named, F.rtrim(part, F.lit(";")))
        return F.when(part.startswith("#"), F.coalesce(_code_point(hexadecimal), _code_point(decimal))).otherwise(name)

    def one(part: Column) -> Column:
        # The part begins right behind an '&'; only the reference itself is taken apart, the rest may be long.
        def put(reference: Column) -> Column:
            rest = F.substr(part, F.length(reference) + 1)
            return F.coalesce(F.concat(character(reference), rest), F.concat(F.lit("&"), part))

        return let(F.regexp_extract(part, _REFERENCE, 0), put)

    def decoded(whole: Column) -> Column:
        parts = F.transform(F.split(whole, "&"), lambda part, i: F.when(i == 0, part).otherwise(one(part)))
        return F.when(F.instr(whole, "&") == 0, whole).otherwise(F.array_join(parts, ""))

    return let(_col(text), decoded)


def _replace_all(text: Column, steps: list[tuple[str, ...]]) -> Column:
    """Replace one pattern after the other; a step may name a string that every match holds, and texts without it skip the step."""
    for pattern, replacement, *held in steps:
        if held:
            text = let(text, _replacing(pattern, replacement, held[0]))
        else:
            text = F.regexp_replace(text, pattern, replacement)
    return text


def _replacing(pattern: str, replacement: str, held: str) -> Callable[[Column], Column]:
    return lambda text: F.when(text.contains(held), F.regexp_replace(text, pattern, replacement)).otherwise(text)


# Elements of a page that hold no prose.
_HTML_SKIPPED = ["script", "style", "head", "nav", "footer", "table", "ul", "ol"]


def html_to_text(html: Column | str) -> Column:
    """Prose paragraphs of an HTML page: comments, scripts, tables and lists go, block ends become blank lines."""
    steps = [(r"(?s)<!--.*?-->", "")]
    steps += [(rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>", "") for tag in _HTML_SKIPPED]
    steps += [
        (r"(?i)<br\s*/?>", "\n"),
        (r"(?i)</?(?:p|div|article|h[1-6])(?:\s[^>]*)?>", "\n\n"),
        (r"<[^>]*>", ""),
    ]
    return _trim_blank_lines(decode_entities(_replace_all(_col(html), steps)))


def _trim_blank_lines(text: Column) -> Column:
    """No blanks next to line ends, and at most one blank line in a row."""

    def trimmed(lines: Column) -> Column:
        def one(line: Column, i: Column) -> Column:
            left = F.when(i == 0, line).otherwise(F.ltrim(line, F.lit(" \t")))
            return F.when(i == F.size(lines) - 1, left).otherwise(F.rtrim(left, F.lit(" \t")))

        return F.array_join(F.transform(lines, one), "\n")

    def stripped(whole: Column) -> Column:
        beside = reduce(or_, [whole.contains(blank) for blank in (" \n", "\t\n", "\n ", "\n\t")])
        return F.when(beside, let(F.split(whole, "\n"), trimmed)).otherwise(whole)

    def opened(whole: Column) -> Column:
        # A line end that the text begins with becomes a blank line.
        single = whole.startswith("\n") & ~whole.startswith("\n\n")
        return F.when(single, F.concat(F.lit("\n"), whole)).otherwise(whole)

    return let(_replace_all(let(text, stripped), [(r"\n\n\n+", "\n\n", "\n\n\n")]), opened)


# Extensions of wiki text that hold no prose.
_WIKI_SKIPPED = ["ref", "references", "imagemap", "gallery", "math", "hr", "timeline", "poem", "hiero"]


def _inside_out(text: Column, opener: str, closer: str, steps: list[tuple[str, ...]]) -> Column:
    """Apply ``steps`` to the innermost pairs first, as often as the pairs of this text are nested; a step changes pairs only."""

    def depth(marks: Column) -> Column:
        start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("top"))

        def step(state: Column, mark: Column) -> Column:
            now = F.when(mark == opener, state["now"] + 1).otherwise(F.greatest(state["now"] - 1, F.lit(0)))
            return F.struct(now.alias("now"), F.greatest(state["top"], now).alias("top"))

        return F.aggregate(marks, start, step, lambda state: state["top"])

    def held(whole: Column) -> Column:
        return whole.contains(opener) & whole.contains(closer)

    def strip(whole: Column) -> Column:
        def passes() -> Column:
            marks = F.regexp_extract_all(whole, F.lit(rf"\Q{opener}\E|\Q{closer}\E"), F.lit(0))
            return let(marks, lambda found: F.least(depth(found), F.size(F.filter(found, lambda mark: mark == closer))))

        def further(once: Column) -> Column:
            # Only a text that still holds both marks after the first pass can change in another one.
            def again(n: Column) -> Column:
                return F.when(n > 1, F.aggregate(F.sequence(F.lit(2), n), once, lambda text, _: _replace_all(text, steps))).otherwise(once)

            return F.when(held(once), let(passes(), again)).otherwise(once)

        return F.when(held(whole), let(_replace_all(whole, steps), further)).otherwise(whole)

    return let(text, strip)


def wiki_to_text(wikitext: Column | str, markup: bool = False, link_mark: str = "") -> Column:
    """Plain text of a wiki page.

    Templates, references, tables, galleries and formulas go, however deeply
    they are nested; links keep their anchor text, links with ':' in the target
    go.  Without ``markup`` list lines and emphasis marks go too; with it
    bullets become '-', numbered items '1.', bold '*', italics '/' and underline '_'.
    ``link_mark`` is put before each link.
    """
    shown = link_mark.replace("\\", r"\\").replace("$", r"\$") + "$1"
    steps = [(r"(?s)<!--.*?-->", "", "-->")]
    tags = "|".join(_WIKI_SKIPPED)
    steps += [(rf"(?i)<(?:{tags})(?:\s[^>]*)?/>", "", "/>"), (rf"(?is)<({tags})(?:\s[^>/]*)?>.*?</\1\s*>", "", "</")]
    text = _replace_all(_col(wikitext), steps)
    text = _inside_out(text, "{{", "}}", [(r"\{\{(?:\{[^{}]*+\}\}\}|[^{}]*+\}\})", "")])
    text = _inside_out(text, "{|", "|}", [(r"\{\|[^{}]*\|\}", "")])
    text = _inside_out(
        text,
        "[[",
        "]]",
        [
            (r"\[\[[^\[\]|]*:[^\[\]]*\]\]", "", ":"),
            (r"\[\[[^\[\]|]*\|([^\[\]|]*)(?:\|[^\[\]]*)?\]\]", shown, "|"),
            (r"\[\[([^\[\]|]*)\]\]", shown),
        ],
    )
    steps = [
        (r"\[[a-z]+://[^\s\]]*\s+([^\]]*)\]", "$1", "://"),
        (r"\[[a-z]+://[^\s\]]*\]", "", "://"),
        (r"(?m)^=+ *([^=\n]*?) *=+ *$", "\n$1\n", "="),
    ]
    if markup:
        steps += [
            (r"(?m)^\*\*\*+ *", "--- ", "***"),
            (r"(?m)^\*\* *", "-- ", "**"),
            (r"(?m)^\* *", "- ", "*"),
            (r"'''", "*", "'''"),
            (r"''", "/", "''"),
            (r"(?i)</?u>", "_", "<"),
            (r"(?i)</?(?:b|strong)>", "*", "<"),
            (r"(?i)</?(?:i|em)>", "/", "<"),
        ]
    else:
        steps += [(r"'''?", "", "''"), (r"(?m)^[*#:;].*$", "")]
    steps += [(r"</?[a-zA-Z][^>]*>", "", "<")]
    text = _replace_all(text, steps)
    if markup:
        text = let(text, _number_items)
    return _trim_blank_lines(decode_entities(text))


def _number_items(text: Column) -> Column:
    """Number the '#' lines of each list: 1., 2., ... restarting after any other line."""

    def block(part: Column) -> Column:
        # A part begins with its '#' lines, so the place of a line is its number.
        lines = F.transform(
            F.split(part, "\n"),
            lambda line, i: F.when(
                line.startswith("#"), F.concat((i + 1).cast("string"), F.lit(". "), F.regexp_replace(line, "^#+ *", ""))
            ).otherwise(line),
        )
        return F.array_join(lines, "\n")

    # A mark goes before every '#' line that follows another kind of line.
    marked = F.regexp_replace(text, r"(?m)^(?!#)(.*)\n#", "$1\n\x01#")
    numbered = F.array_join(F.transform(F.split(marked, "\x01"), block), "")
    # Pages without such lines skip the walk over their lines.
    return F.when(text.rlike(r"(?m)^#"), numbered).otherwise(text)


# Namespace numbers by title prefix, in English and German.
NAMESPACES = {"CATEGORY": -8, "KATEGORIE": -8, "IMAGE": 6, "BILD": 6, "TEMPLATE": 11, "VORLAGE": 11}
# A page of another language has a prefix of up to three bytes, or this one.
OTHER_LANGUAGE = -9
LONG_LANGUAGE = "SIMPLE"


def page_namespace(title: Column | str) -> Column:
    """Number of the namespace that the prefix of a title names; 0 without a known prefix."""
    numbers = F.create_map(*[F.lit(x) for pair in NAMESPACES.items() for x in pair])

    def number(prefix: Column) -> Column:
        foreign = F.octet_length(prefix).between(1, 3) | (prefix == LONG_LANGUAGE)
        return F.coalesce(F.element_at(numbers, prefix), F.when(foreign, OTHER_LANGUAGE), F.lit(0))

    return let(F.trim(F.upper(F.regexp_extract(_col(title), "^([^:]*):", 1))), number)


# A redirect page: the keyword, and a link whose page ends at a pipe.
_REDIRECT = r"(?i)^\s*#redirect\s*:?\s*\[\[\s*([^\[\]|\n]+?)\s*(?:[|][^\[\]\n]*)?\]\]"


def redirect_target(text: Column | str) -> Column:
    """Title that a redirect page such as ``#REDIRECT [[title]]`` points to, null for other pages."""
    return let(
        F.nullif(F.regexp_extract(_col(text), _REDIRECT, 1), F.lit("")),
        lambda page: F.concat(F.upper(F.left(page, F.lit(1))), F.substr(page, F.lit(2))),
    )


def wiki_links(wikitext: Column | str) -> Column:
    """Internal links as an array of (target, anchor); a letter trail behind the link belongs to the anchor."""
    pattern = r"\[\[([^\[\]|]+)(?:\|([^\[\]|]*))?(?:\|[^\[\]]*)?\]\]([a-zA-Z]*)"
    found = F.regexp_extract_all(_col(wikitext), F.lit(pattern), F.lit(0))

    def one(link: Column) -> Column:
        target = F.regexp_extract(link, pattern, 1)
        part = F.regexp_extract(link, pattern, 2)
        anchor = F.concat(F.when(part == "", target).otherwise(part), F.regexp_extract(link, pattern, 3))
        return F.struct(F.trim(target).alias("target"), anchor.alias("anchor"))

    return F.transform(found, one)


def html_links(html: Column | str) -> Column:
    """Links of an HTML page as an array of (target, anchor)."""
    pattern = r"<a href=\"([^\"]*)\"[^>]*>([^<]*)</a>"
    found = F.regexp_extract_all(_col(html), F.lit(pattern), F.lit(0))
    return F.transform(
        found,
        lambda a: F.struct(
            F.regexp_extract(a, pattern, 1).alias("target"), F.regexp_extract(a, pattern, 2).alias("anchor")
        ),
    )


def ranked_title(line: Column | str) -> Column:
    """Article title of a ranking line that begins with ``<td><a href=".../wiki/TITLE"``, null for other lines."""
    raw = F.regexp_extract(_col(line), r'^<td><a href="[^"]*/wiki/([^"]+)"', 1)
    # url_decode turns '+' into a space, which titles do not want; a stray '%' stays as it is.
    guarded = F.regexp_replace(raw, r"%(?![0-9a-fA-F]{2})", "%25")
    decoded = F.url_decode(F.replace(guarded, F.lit("+"), F.lit("%2B")))
    return F.when(raw != "", F.translate(decoded, "_", " "))


def title_slug(title: Column | str) -> Column:
    """File-name-safe title: '_' for spaces and percent encoding of all but letters, digits and '_.-'."""
    encoded = F.url_encode(F.translate(_col(title), " ", "_"))
    # url_encode leaves '*' and encodes '~' the same way on all sides.
    return F.replace(encoded, F.lit("*"), F.lit("%2A"))
