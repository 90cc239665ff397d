"""Text columns of reviewed reports: flags, tags, headlines, summaries."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\u000b\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"
BLANKS = " \t\n\r\x0b\x0c\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"

# Strings read as true.
TRUE_WORDS = ("1", "true", "yes", "y")

# Headlines that carry no information, on input and on display.
GENERIC_INPUT_HEADLINES = ("", "news", "report", "artikel")
GENERIC_HEADLINES = ("news", "report", "laporan", "article")

# Two of these make a text that claims to be Indonesian an English one.
ENGLISH_MARKERS = (
    " flood ",
    " flooding ",
    " disrupted ",
    " disruption ",
    " mobility ",
    " update ",
    " january ",
    " february ",
    " march ",
    " april ",
    " may ",
    " june ",
    " july ",
    " august ",
    " september ",
    " october ",
    " november ",
    " december ",
    " key road ",
    " links ",
    " during ",
    " review window ",
)

# Headline length limits.
HEADLINE_MAX = 92
HEADLINE_CUT = 89

# A text's first characters that are looked at for its first sentence, and how many of them must
# be left without runs of white space to tell a headline whatever follows.
HEADLINE_START, HEADLINE_SURE = 1000, 200


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value used several times, so that the expression tree stays small."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(value: Column) -> Column:
    """Trim all white space; null becomes empty."""
    return F.btrim(F.coalesce(value, F.lit("")), F.lit(BLANKS))


def or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def lowered(value: Column) -> Column:
    return F.lower(strip(value))


def parse_bool(value: Column) -> Column:
    return lowered(value).isin(*TRUE_WORDS)


def normalize_tags(value: Column) -> Column:
    """Split on ``|``, ``,`` or ``;``, trimmed, blanks dropped."""
    parts = F.transform(F.split(or_empty(value), r"[|,;]"), strip)
    return F.filter(parts, lambda t: t != "")


def squeeze(value: Column) -> Column:
    return strip(F.regexp_replace(or_empty(value), f"{SPACE}+", " "))


def comparable(value: Column) -> Column:
    """Lower case without punctuation, single spaces."""
    return squeeze(F.translate(F.lower(or_empty(value)), '.,!?;:"', ""))


def humanize_claim(value: Column, translations: Mapping[str, str] | None = None) -> Column:
    """Claim token to a label: the translation when there is one, else its words."""
    token = F.regexp_replace(F.translate(lowered(value), "-", "_"), f"{SPACE}+", "_")
    label = F.translate(token, "_", " ")
    if translations:
        pairs = [F.lit(x) for kv in translations.items() for x in kv]
        label = F.coalesce(F.create_map(*pairs)[token], label)
    return label


def clean_tags(tags: Column, translations: Mapping[str, str] | None = None) -> Column:
    """Drop blanks and date-shaped tags, humanise, keep the first of equal labels."""
    kept = F.filter(
        F.transform(F.coalesce(tags, F.array().cast("array<string>")), strip),
        lambda t: (t != "") & ~t.rlike(r"^\d{4}-\d{2}(-\d{2})?$"),
    )
    labels = F.filter(F.transform(kept, lambda t: humanize_claim(t, translations)), lambda t: t != "")
    seen = F.transform(labels, F.lower)
    return F.filter(labels, lambda t, i: F.array_position(seen, F.lower(t)) == i + 1)


def consistent_language(value: Column, language: str) -> Column:
    """False for empty text and for Indonesian text with two or more English markers."""
    text = lowered(value)
    if language != "id":
        return text != ""
    markers = F.array(*(F.lit(m) for m in ENGLISH_MARKERS))
    return let(
        F.concat(F.lit(" "), text, F.lit(" ")),
        lambda p: (p != "  ") & (F.size(F.filter(markers, lambda m: F.contains(p, m))) < 2),
    )


def summary_for_language(summary_id: Column, summary_en: Column, language: str) -> Column:
    source = summary_id if language == "id" else F.coalesce(F.nullif(summary_en, F.lit("")), summary_id)
    return let(
        strip(source),
        lambda s: F.when(consistent_language(s, language), s).otherwise(F.lit("")),
    )


def is_generic_headline(value: Column) -> Column:
    return lowered(value).isin(*GENERIC_HEADLINES)


def headline_from_summary(value: Column) -> Column:
    """First sentence, cut with an ellipsis when too long."""

    def shorten(first: Column) -> Column:
        head = F.regexp_replace(F.substring(first, 1, HEADLINE_CUT), f"{SPACE}+$", "")
        return F.when(F.length(first) <= HEADLINE_MAX, first).otherwise(F.concat(head, F.lit("...")))

    def sentence(start: Column) -> Column:
        # the pattern stops at a next-line sign, which isn't among the blanks, anywhere in the text
        sure = (F.length(start) >= HEADLINE_SURE) & ~F.contains(value, F.lit("\u0085"))
        return F.regexp_replace(F.when(sure, start).otherwise(squeeze(value)), r"^(.*?[.!?]) .*$", "$1")

    return let(let(squeeze(F.substring(value, 1, HEADLINE_START)), sentence), shorten)


def _starts_with(summary: Column, headline: Column) -> Column:
    return (summary != "") & (headline != "") & F.startswith(summary, headline)


def _comparable_headline(headline: Column) -> Column:
    return comparable(F.regexp_replace(or_empty(headline), r"\.\.\.$", ""))


def summary_matches_headline(summary: Column, headline: Column) -> Column:
    both = F.struct(comparable(summary).alias("s"), _comparable_headline(headline).alias("h"))
    return let(both, lambda v: _starts_with(v["s"], v["h"]))


def preferred_headline(
    summary_id: Column,
    summary_en: Column,
    headline: Column,
    location: Column,
    selection: Column,
    event_id: Column,
    language: str,
) -> Column:
    """Headline by language: a place for Indonesian; for others the summary's first
    sentence, then an informative headline, then the place."""
    blank = F.lit("")
    place = strip(
        F.coalesce(F.nullif(location, blank), F.nullif(selection, blank), F.nullif(event_id, blank))
    )
    if language == "id":
        return place
    from_summary = headline_from_summary(summary_for_language(summary_id, summary_en, language))
    primary = let(
        strip(headline), lambda h: F.when(~is_generic_headline(h), F.nullif(h, blank))
    )
    return F.coalesce(F.nullif(from_summary, blank), primary, place)


def show_headline(headline: Column, location: Column) -> Column:
    return (or_empty(headline) != "") & (comparable(headline) != comparable(location))


def show_summary(summary: Column, headline: Column, location: Column) -> Column:
    all_ = F.struct(comparable(summary).alias("s"), _comparable_headline(headline).alias("h"), comparable(location).alias("l"))
    return (or_empty(summary) != "") & let(all_, lambda v: ~_starts_with(v["s"], v["h"]) & (v["s"] != v["l"]))


def state_label_key(state: Column) -> Column:
    return F.when(or_empty(state) == "", F.lit("")).otherwise(
        F.concat(F.lit("qualitative.state."), state)
    )


def state_note_key(state: Column) -> Column:
    return F.when(or_empty(state) == "", F.lit("")).otherwise(
        F.concat(F.lit("qualitative.state_note."), state)
    )


def empty_message_key(state: Column) -> Column:
    known = state.isin("not_reviewed_yet", "reviewed_but_no_publishable_report")
    return F.concat(
        F.lit("qualitative.empty."), F.when(known, state).otherwise(F.lit("none_available"))
    )
