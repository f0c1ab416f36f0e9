"""Text scalars: cleaning, counting, normalising, splitting.

Each function takes and returns Columns and is made of built-in expressions,
so a chain of them stays in one code-generated stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliograph import constants as K

WS = f"[{K.SPACE_CLASS}]"
NOT_WS = f"[^{K.SPACE_CLASS}]"
INLINE_WS = f"[{K.INLINE_SPACE_CLASS}]"
LINE_BREAK = f"\r\n|[{K.LINE_BREAK_CLASS}]"
# Most text has no whitespace but blanks and line feeds. One cheap look for any
# other kind lets every pattern below use a two-character class instead. A class
# that takes whole runs is many times faster than one sought at each character,
# so patterns on whole texts name what they keep.
PLAIN = r"\A[\n -~]*+\z"
PLAIN_BREAKS = r"\A[\n -~\xa0-\u2027]*+\z"
RARE_SPACE = f"[{K.RARE_SPACE_CLASS}]"


class Spaces:
    """Character classes for text with or without rare whitespace."""

    def __init__(self, rare: bool):
        self.ws = WS if rare else "[ \n]"
        self.not_ws = NOT_WS if rare else "[^ \n]"
        self.inline = INLINE_WS if rare else " "
        self.rare = rare


def by_spaces(x: Column, body: Callable[[Column, Spaces], Column]) -> Column:
    rare = ~x.rlike(PLAIN) & x.rlike(RARE_SPACE)
    return F.when(rare, body(x, Spaces(True))).otherwise(body(x, Spaces(False)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Name an intermediate value inside one expression.

    A fold over nothing: its end sees the value as it is, where the result of a
    ``transform`` would be copied whole, arrays and all, once for every name.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda held, _: held, body)


def text_or_empty(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(K.SPACE_CHARS))


def rstrip(x: Column) -> Column:
    return F.rtrim(x, F.lit(K.SPACE_CHARS))


def blank_to_null(x: Column) -> Column:
    return F.nullif(strip(x), F.lit(""))


def first_nonempty(*cols: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols])


def normalise_newlines(x: Column) -> Column:
    return F.regexp_replace(text_or_empty(x), "\r\n?", "\n")


def squeeze(x: Column) -> Column:
    """Runs of two or more whitespace characters become one space."""
    return by_spaces(x, _squeeze)


def _squeeze(x: Column, s: Spaces) -> Column:
    return F.regexp_replace(x, f"{s.ws}{{2,}}", " ")


def word_count(x: Column) -> Column:
    return F.coalesce(by_spaces(x, lambda t, s: F.regexp_count(t, F.lit(f"{s.not_ws}+"))), F.lit(0))


def words(x: Column) -> Column:
    return by_spaces(
        text_or_empty(x), lambda t, s: F.regexp_extract_all(t, F.lit(f"{s.not_ws}+"), F.lit(0))
    )


def approx_tokens(x: Column) -> Column:
    n = F.length(text_or_empty(x))
    return F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(n / 4).cast("int")))


def norm_token(x: Column) -> Column:
    return F.array_join(F.regexp_extract_all(F.lower(text_or_empty(x)), F.lit(r"[0-9A-Za-z\-.%]+"), F.lit(0)), " ")


def token_list(x: Column) -> Column:
    """Distinct normalised tokens of a text, in first-seen order."""
    return F.array_distinct(
        F.filter(F.transform(words(x), norm_token), lambda t: t != "")
    )


def more_words_than(x: Column, n: int) -> Column:
    """Whether a text has more than ``n`` words; reads no further than needed."""
    return F.coalesce(
        by_spaces(x, lambda t, s: t.rlike(f"\\A(?:{s.ws}*+{s.not_ws}++){{{n + 1}}}")), F.lit(False)
    )


def alnum_words(x: Column) -> Column:
    return F.regexp_extract_all(text_or_empty(x), F.lit("[0-9A-Za-z]+"), F.lit(0))


def compact_key(x: Column) -> Column:
    return F.lower(F.regexp_replace(text_or_empty(x), "[^0-9a-zA-Z]+", ""))


def dedup_key(x: Column) -> Column:
    """Lower-cased text with only word characters, spaces and currency marks left."""
    low = F.regexp_replace(F.lower(text_or_empty(x)), f"{WS}+", " ")
    return strip(F.regexp_replace(low, rf"[^\p{{L}}\p{{N}}_{K.SPACE_CLASS}₹$€%.\-]", ""))


def unit_key(x: Column) -> Column:
    """Identity of a text unit: lower-cased word characters only."""
    bare = F.regexp_replace(F.lower(text_or_empty(x)), rf"[^\p{{L}}\p{{N}}_{K.SPACE_CLASS}]", "")
    # a single blank stays as it is, and most are
    single = lambda t, s: F.regexp_replace(t, f"{WS}+" if s.rare else "[ \n]{2,}|\n", " ")
    return let(bare, lambda b: strip(by_spaces(b, single)))


def has_digits_or_symbols(x: Column) -> Column:
    return text_or_empty(x).rlike("[0-9%₹$€:+/#]")


def strip_fences(x: Column) -> Column:
    return strip(F.regexp_replace(text_or_empty(x), r"(?im)^\s*```(?:json)?\s*$|```(?:json)?", ""))


def title_case(x: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the rest."""
    marked = F.regexp_replace(x, r"([^\p{L} ])(\p{L})", "$1\x01 $2")
    return F.regexp_replace(F.initcap(marked), "\x01 ", "")


def key_label(x: Column) -> Column:
    return title_case(F.regexp_replace(x, "_", " "))


def collapse_repeated_lines(x: Column) -> Column:
    return F.regexp_replace(x, r"(?md)^(.++)\n\1\n+", "$1\n")


def nonblank_lines(x: Column) -> Column:
    # A blank line between \r and \n goes with the others. Line feeds alone are sought without a pattern.
    breaks = F.when(x.rlike(PLAIN_BREAKS), "\n").otherwise(f"[{K.LINE_BREAK_CLASS}]")
    parts = F.split(text_or_empty(x), breaks)
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def has_line(x: Column) -> Column:
    """Whether :func:`nonblank_lines` finds any; reads to the first character that is not a space."""
    return F.coalesce(x.rlike(NOT_WS), F.lit(False))


def _tidy_punctuation(x: Column, s: Spaces) -> Column:
    tight = F.regexp_replace(x, f"{s.ws}+([.,;:!?])", "$1")
    return F.regexp_replace(tight, f"([.,;:!?])({s.not_ws})", "$1 $2")


def _keep_number_punctuation(x: Column, s: Spaces) -> Column:
    """As :func:`_tidy_punctuation`, but ``1,234.5`` and ``10:30`` stay whole."""
    tight = F.regexp_replace(x, f"{s.ws}+([.,;:!?])", "$1")
    return F.regexp_replace(tight, rf"([.,;:!?])(?!(?<=\d.)\d)({s.not_ws})", "$1 $2")


def tidy_punctuation(x: Column) -> Column:
    return by_spaces(x, _tidy_punctuation)


def _drop_lines(x: Column, s: Spaces) -> Column:
    """Blank out lone markers, page counters and one- or two-letter lines."""
    one_break = F.regexp_replace(x, LINE_BREAK, "\n") if s.rare else x
    return F.regexp_replace(
        one_break,
        rf"(?imd)^{s.inline}*(?:{K.LONE_MARKERS}|page{s.inline}*\p{{Nd}}+|\p{{L}}{{1,2}}){s.inline}*$",
        "",
    )


def clean_text(x: Column, preserve_numbers: bool = False) -> Column:
    """Flow a raw text into one line.

    Repeated lines collapse; lone markers, page counters and one- or two-letter
    lines go; the rest is joined by spaces and its punctuation spacing fixed.
    """
    tidy = _keep_number_punctuation if preserve_numbers else _tidy_punctuation

    def flow(t: Column, s: Spaces) -> Column:
        lines = _drop_lines(collapse_repeated_lines(t), s)
        joined = strip(_squeeze(F.replace(lines, F.lit("\n"), F.lit(" ")), s))
        return strip(tidy(joined, s))

    return by_spaces(text_or_empty(x), flow)


def is_numeric_token(x: Column) -> Column:
    return F.regexp_replace(x, ",", "").rlike(r"^[\-\d.,]+$")


def is_number_like(x: Column) -> Column:
    """A signed decimal, commas and spaces ignored, with an optional percent sign."""
    bare = F.regexp_replace(strip(text_or_empty(x)), "[, ]", "")
    return bare.rlike(r"^[+-]?\d+(\.\d+)?%?$")


def is_currency_number(x: Column) -> Column:
    bare = F.regexp_replace(text_or_empty(x), ",|₹|Rs", "")
    return strip(bare).rlike(r"^[\-\d.]+$")


def mostly_numeric(x: Column, numbers: Column) -> Column:
    """Half the tokens are numbers and most of those occur in ``numbers``."""
    return let(words(x), lambda toks: mostly_numeric_words(toks, numbers))


def mostly_numeric_words(toks: Column, numbers: Column) -> Column:
    """As :func:`mostly_numeric`, from the words of the text; bind them with ``let`` first."""
    some = F.filter(toks, lambda t: t.rlike(r"^,*[\-\d.][\-\d.,]*$"))

    def judge(ns: Column) -> Column:
        hit = F.filter(
            ns, lambda t: F.array_contains(numbers, t) | F.array_contains(numbers, norm_token(t))
        )
        need = F.greatest(F.lit(1), F.floor(F.size(ns) * 6 / 10).cast("int"))
        return (F.size(toks) > 0) & (F.size(ns) * 2 >= F.size(toks)) & (F.size(hit) >= need)

    return let(F.transform(some, lambda t: F.regexp_replace(t, ",", "")), judge)


def ends_sentence(x: Column) -> Column:
    return strip(text_or_empty(x)).rlike(r"[.!?][\"']?$")


def looks_like_overflow(x: Column) -> Column:
    return ~ends_sentence(x) & (word_count(x) >= K.OVERFLOW_MIN_WORDS)


def strip_prefix_head(x: Column) -> Column:
    """Drop a leading ``a > b`` breadcrumb that ends with a blank line."""
    return strip(F.regexp_replace(text_or_empty(x), f"(?s)\\A{WS}*.+?>.*?\n\n", ""))


def is_lone_marker(x: Column) -> Column:
    return x.rlike(rf"(?i)^{WS}*(?:{K.LONE_MARKERS}){WS}*$")


def is_page_counter(x: Column) -> Column:
    return x.rlike(rf"(?i)^{WS}*page{WS}*\p{{Nd}}+{WS}*$")


def is_too_small(n_words: Column, forced: Column) -> Column:
    return ~F.coalesce(forced, F.lit(False)) & (n_words < K.MIN_CHUNK_WORDS)


def is_all_caps(x: Column) -> Column:
    return x.rlike(r"\p{Lu}") & ~x.rlike(r"[\p{Ll}\p{Lt}\p{Lm}\p{Lo}]")


def starts_noise(x: Column) -> Column:
    return F.ltrim(x, F.lit(K.SPACE_CHARS)).rlike(r"^[:.\-–—%\p{Nd}]")


def is_trivial_heading(x: Column) -> Column:
    """A short label without digits, symbols or a sentence end."""

    def judge(t: Column) -> Column:
        toks = alnum_words(t)
        small = F.size(F.filter(toks, lambda w: F.lower(w).isin(K.STOPWORDS) | (F.length(w) <= 3)))
        letters = F.length(F.array_join(toks, ""))
        return (
            F.when(t.rlike(r"\A(?:[^0-9A-Za-z]*+[0-9A-Za-z]++){6}"), False)
            .when(t == "", True)
            .when(t.rlike(rf"[.!?][\"')\]]?{WS}*$"), False)
            .when(F.size(toks) == 0, True)
            .when(has_digits_or_symbols(t), False)
            .when(~t.rlike("[A-Z]"), True)
            .otherwise((small * 10 >= F.size(toks) * 6) | (letters <= F.size(toks) * 6))
        )

    return let(strip(text_or_empty(x)), judge)


def is_term_candidate(x: Column) -> Column:
    """A short, mostly upper-case or capitalised line such as a glossary term."""
    letters = F.regexp_count(x, F.lit(r"\p{L}"))
    uppers = F.regexp_count(x, F.lit(r"\p{Lu}"))
    n = word_count(x)
    same_upper = F.upper(x) == x
    return (n <= 8) & (
        ((letters > 0) & (uppers * 10 >= letters * 6))
        | (x.rlike(rf"^[A-Z0-9/&\-{K.SPACE_CLASS}.()]{{1,30}}$") & same_upper)
        | (
            (n <= 3)
            & (F.length(x) < 40)
            & ~x.rlike("[.:;]")
            & (same_upper | x.rlike(r"^\p{Lu}"))
        )
    )


def bold_ratio(spans: Column) -> Column:
    n = F.size(spans)
    bold = F.size(F.filter(spans, lambda s: F.coalesce(s["bold"], F.lit(False))))
    return F.when(n > 0, bold / n).otherwise(F.lit(0.0))


def word_windows(x: Column, size: int = K.WINDOW_WORDS) -> Column:
    """Consecutive windows of ``size`` words, joined by single spaces."""

    def cut(t: Column, s: Spaces) -> Column:
        window = f"{s.not_ws}++(?:{s.ws}++{s.not_ws}++){{0,{size - 1}}}"
        return F.transform(
            F.regexp_extract_all(t, F.lit(window), F.lit(0)),
            lambda w: F.regexp_replace(w, f"{s.ws}+", " "),
        )

    return by_spaces(text_or_empty(x), cut)


_MARKER = r"[•\-–]|\p{Nd}{1,2}[.)]|[A-Za-z][.)]|[o○◦]"
_LEADING_MARKER = rf"\A(?:{_MARKER})[ \t]+(?=\P{{Z}})"


def _bullet_units(x: Column) -> Column:
    """Lines grouped by top-level bullets; each unit joined by spaces."""
    line_pat = rf"^[ \t]{{0,20}}(?:{_MARKER})[ \t]+(.+?){WS}*$"
    top_pat = rf"^ {{0,3}}(?:[•\-–]|\p{{Nd}}{{1,2}}[.)]|[A-Za-z][.)])[ \t]+.+$"

    def piece(ln: Column) -> Column:
        body = F.when(ln.rlike(line_pat), strip(F.regexp_extract(ln, line_pat, 1))).otherwise(strip(ln))
        return F.when(ln.rlike(top_pat), F.concat(F.lit("\x01"), body)).otherwise(body)

    lines = F.filter(F.split(normalise_newlines(x), "\n"), lambda s: strip(s) != "")
    flat = F.array_join(F.transform(F.transform(lines, rstrip), piece), " ")
    units = F.transform(F.split(flat, "\x01"), strip)
    return F.filter(units, lambda u: u != "")


def glue_short_units(units: Column, min_words: int = K.UNIT_MIN_WORDS) -> Column:
    """Append following units until each holds ``min_words`` words.

    Words of units joined by a space add up, so the fold carries a number.
    """
    from foliograph.functions.scan import group_starts, groups

    starts = lambda us: group_starts(
        F.transform(us, word_count),
        F.lit(None).cast("int"),
        lambda held, n: held.isNull() | (held >= min_words),
        lambda held, n, opens: F.when(opens, n).otherwise(held + n).cast("int"),
    )
    glued = lambda us: F.when(F.size(us) > 1, strip(F.array_join(us, " "))).otherwise(F.get(us, F.lit(0)))
    return let(units, lambda us: groups(us, starts(us), glued))


def dedup_units(units: Column) -> Column:
    """Keep the first unit for each identity; drop units without word characters.

    Identities are sorted with their positions, so the first of each is the one
    that differs from its neighbour before it.
    """

    def firsts(us: Column, keys: Column) -> Column:
        new = F.filter(
            keys, lambda k, j: (k["key"] != "") & ((j == 0) | (k["key"] != F.coalesce(F.get(keys, j - 1)["key"], F.lit(""))))
        )
        return F.transform(F.sort_array(F.transform(new, lambda k: k["i"])), lambda i: F.get(us, i))

    keyed = lambda us: F.array_sort(F.transform(us, lambda u, i: F.struct(unit_key(u).alias("key"), i.alias("i"))))
    return let(units, lambda us: let(keyed(us), lambda keys: firsts(us, keys)))


def split_points(
    x: Column, min_unit_words: int = K.UNIT_MIN_WORDS, hard_max_words: int = K.UNIT_MAX_WORDS
) -> Column:
    """Bullet units, glued, deduplicated and cut into bounded word windows."""

    def cut(u: Column) -> Column:
        return F.when(more_words_than(u, hard_max_words), word_windows(u, hard_max_words)).otherwise(F.array(u))

    def build(x: Column) -> Column:
        many = F.flatten(F.transform(dedup_units(glue_short_units(_bullet_units(x), min_unit_words)), cut))
        # A flowed text is one line: it loses a leading marker and is cut, no more.
        lone = F.regexp_replace(strip(x), _LEADING_MARKER, "")
        single = F.when(x.rlike(r"[\p{L}\p{N}_]"), let(lone, cut)).otherwise(F.array().cast("array<string>"))
        return F.when(x.contains("\n") | x.contains("\r"), many).otherwise(single)

    return let(x, build)


def split_long(x: Column, limit: int = K.CHUNK_CHAR_LIMIT) -> Column:
    """Cut at the last space after 60% of ``limit`` characters, else hard."""
    low = int(limit * 0.6)
    pattern = rf"(?s).{{1,{limit}}}\z|.{{{low},{limit - 1}}}(?= )|.{{{limit}}}"
    cut = F.filter(
        F.transform(F.regexp_extract_all(x, F.lit(pattern), F.lit(0)), strip), lambda s: s != ""
    )
    return F.when(F.length(x) <= limit, F.array(x)).otherwise(cut)


def chunk_prefix(
    stem: Column,
    page_title: Column,
    page_subtitle: Column,
    published_month: Column,
    published_date: Column,
    topic: Column | None = None,
    subtopic: Column | None = None,
) -> Column:
    """``stem > title subtitle > published_… > topic`` and a blank line."""

    def pair(a: Column, b: Column) -> Column:
        return F.when(blank_to_null(a).isNotNull(), F.concat_ws(" ", blank_to_null(a), blank_to_null(b)))

    null = F.lit(None).cast("string")
    trail = F.concat_ws(
        " > ",
        F.nullif(stem, F.lit("")),
        pair(page_title, page_subtitle),
        F.coalesce(
            F.concat(F.lit("published_month: "), F.nullif(published_month, F.lit(""))),
            F.concat(F.lit("published_date: "), F.nullif(published_date, F.lit(""))),
        ),
        pair(topic if topic is not None else null, subtopic if subtopic is not None else null),
    )
    return F.when(trail == "", "").otherwise(F.concat(trail, F.lit("\n\n")))
