"""Text clean-up, counts and readability as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fixed

# All Unicode white space, plus the separators U+001C..U+001F.
ANY_SPACE = r"[\s\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# A run that is not already one plain blank: it begins with another kind, or a blank has more behind it.
# Visible ASCII is told first, by one range; the long class would be tried on every letter.
UNEVEN_SPACE = f"(?:[[^ -~]&&{ANY_SPACE}]| [[^!-~]&&{ANY_SPACE}]){ANY_SPACE}*"
ASCII_SPACE = r"[\t\n\f\r ]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_space(c: Column | str) -> Column:
    """Trim Unicode white space at both ends."""
    return F.regexp_replace(_col(c), f"^{ANY_SPACE}+|{ANY_SPACE}+\\z", "")


def collapse_space(c: Column | str) -> Column:
    """One blank for each run of Unicode white space, none at the ends."""
    return F.trim(F.regexp_replace(_col(c), UNEVEN_SPACE, " "))


def fix_encoding(c: Column | str, pairs: Sequence[tuple[str, str]] = fixed.MOJIBAKE) -> Column:
    """Repair broken UTF-8 and collapse white space; NULL becomes the empty string.

    Each repair reads the whole text, so texts without any character that a broken one begins with skip them all.
    The text is used several times; one that is dear to build should be a column by then.
    """
    start = F.coalesce(_col(c), F.lit(""))
    repaired = reduce(lambda acc, p: F.replace(acc, F.lit(p[0]), F.lit(p[1])), pairs, start)
    broken = reduce(lambda acc, lead: acc | F.contains(start, F.lit(lead)), sorted({p[0][0] for p in pairs}), F.lit(False))
    return collapse_space(F.when(broken, repaired).otherwise(start))


def article_number(c: Column | str) -> Column:
    """``Art. 2-bis.`` to ``2-bis``: first ``Art`` plus one character, blanks and one last dot go."""
    without_word = F.regexp_replace(_col(c), r"(?s)^(.*?)Art[^\n]", "$1")
    without_space = F.regexp_replace(without_word, f"{ANY_SPACE}+", "")
    return F.regexp_replace(without_space, r"\.\z", "")


def target_article(number: Column | str, target: Column | str) -> Column:
    """Article an amendment is aimed at: the part of its number before the first dot."""
    source = F.nullif(F.coalesce(F.nullif(_col(number), F.lit("")), _col(target)), F.lit(""))
    bare = strip_space(F.replace(source, F.lit(fixed.AMENDMENT_PREFIX), F.lit("")))
    return F.substring_index(bare, ".", 1)


def target_paragraph(text: Column | str) -> Column:
    """Number after the first ``comma`` in the text, NULL without one."""
    return F.nullif(F.regexp_extract(_col(text), r"(?i)comma\s+(\d+)", 1), F.lit(""))


def word_count(c: Column | str) -> Column:
    """Pieces of a split at white space: a leading blank adds one, the empty string counts 1."""
    return F.size(F.split(_col(c), f"{ASCII_SPACE}+", -1))


def char_count(c: Column | str) -> Column:
    return F.char_length(_col(c))


def full_name(*parts: Column | str) -> Column:
    """Parts joined by a blank; NULL and empty ones are left out, NULL when none is left."""
    kept = [F.nullif(_col(p), F.lit("")) for p in parts]
    return F.nullif(F.concat_ws(" ", *kept), F.lit(""))


def first_word(c: Column | str) -> Column:
    """Text before the first blank."""
    return F.nullif(F.substring_index(_col(c), " ", 1), F.lit(""))


def after_first_word(c: Column | str) -> Column:
    """Text after the first blank, NULL without a blank."""
    return F.when(F.contains(_col(c), F.lit(" ")), F.element_at(F.split(_col(c), " ", 2), 2))


def gender_of_role(label: Column | str) -> Column:
    return F.when(F.contains(_col(label), F.lit("Senatrice")), "F").otherwise("M")


def drop_repeated_number(text: Column | str, num: Column | str) -> Column:
    """Remove a paragraph number that the text repeats at its start."""
    text, num = _col(text), _col(num)
    repeated = (F.length(num) > 0) & F.startswith(text, num)
    return F.when(repeated, strip_space(F.substr(text, F.length(num) + 1))).otherwise(text)


def join_texts(texts: Column | str, field: str | None = None) -> Column:
    """Array of text (or of structs holding ``field``) as one text, a line each."""
    items = _col(texts)
    if field is not None:
        items = F.transform(items, lambda x: F.coalesce(x[field], F.lit("")))
    return F.array_join(items, "\n")


def is_digits(c: Column | str) -> Column:
    return F.rlike(_col(c), F.lit(r"^[0-9]+\z"))


def contains_any(c: Column | str, words: Sequence[str]) -> Column:
    """Case-insensitive: does any of the words occur?"""
    low = F.lower(_col(c))
    return reduce(lambda acc, w: acc | F.contains(low, F.lit(w)), words[1:], F.contains(low, F.lit(words[0])))


def or_default(c: Column | str, default: str) -> Column:
    return F.coalesce(_col(c), F.lit(default))


def is_government_bill(natura: Column | str, initiative: Column | str, literal: bool = True) -> Column:
    """Government bill flag.

    ``literal=True`` keeps the rule as specified: ``natura`` contains ``DL``, so every
    ``DDL`` matches as well. ``literal=False`` wants a ``DL`` that no ``D`` precedes.
    """
    natura = _col(natura)
    by_kind = F.contains(natura, F.lit("DL")) if literal else F.rlike(natura, F.lit("(^|[^D])DL"))
    return F.coalesce(by_kind, F.lit(False)) | _col(initiative).eqNullSafe("Governativa")


def shorten_namespaces(c: Column | str, prefixes: dict[str, str] = fixed.NAMESPACES) -> Column:
    return reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), prefixes.items(), _col(c))


# ---- measures -------------------------------------------------------------


def letters(c: Column | str) -> Column:
    return F.char_length(F.regexp_replace(_col(c), r"\P{L}+", ""))


def words(c: Column | str) -> Column:
    """Runs of non-blank characters: the pieces of a split without the empty ones at the ends."""
    text = _col(c)
    blank_ends = [F.rlike(text, F.lit(p)).cast("int") for p in (f"^{ASCII_SPACE}", f"{ASCII_SPACE}\\z")]
    return F.when(text == "", 0).otherwise(word_count(text) - blank_ends[0] - blank_ends[1])


def sentences(c: Column | str) -> Column:
    """Runs of closing punctuation; a text without any still is one sentence when it has words."""
    runs = F.regexp_count(_col(c), F.lit(r"[.!?]+"))
    return F.when(runs > 0, runs).when(words(c) > 0, 1).otherwise(0)


def gulpease(n_letters: Column, n_words: Column, n_sentences: Column) -> Column:
    """89 - 10 letters/words + 300 sentences/words; NULL without words."""
    n_letters, n_words, n_sentences = (_col(c).cast("double") for c in (n_letters, n_words, n_sentences))
    return F.lit(89.0) + F.try_divide(F.lit(300.0) * n_sentences - F.lit(10.0) * n_letters, n_words)


def gulpease_band(score: Column | str) -> Column:
    score = _col(score)
    return (
        F.when(score < 40, "incomprensibile")
        .when(score < 60, "difficile")
        .when(score <= 80, "normale")
        .when(score > 80, "semplice")
    )


def norm_references(c: Column | str, patterns: Sequence[str] = fixed.NORM_REFERENCES) -> Column:
    """How often the text cites another norm, over all patterns."""
    low = F.lower(_col(c))
    counts = [F.regexp_count(low, F.lit(p)) for p in patterns]
    return reduce(lambda a, b: a + b, counts)


def amendment_type(
    text: Column | str,
    rules: Sequence[tuple[str, str]] = (
        ("soppressione", r"^\W*(soppri|all'articolo [^,]*,\s*soppri)"),
        ("modifica", r"^\W*(sostitui|all'articolo [^,]*,\s*sostitui)"),
        ("aggiunta", r"^\W*(aggiung|inseri|dopo )"),
    ),
    default: str = "altro",
) -> Column:
    """Kind of change an amendment asks for, by its opening words; the first rule that fits wins."""
    low = F.lower(strip_space(text))
    expr = None
    for label, pattern in rules:
        hit = F.rlike(low, F.lit(pattern))
        expr = F.when(hit, label) if expr is None else expr.when(hit, label)
    return F.when(_col(text).isNotNull(), expr.otherwise(default))


def fingerprint(c: Column | str) -> Column:
    """Same for texts that differ in white space only."""
    return F.sha2(collapse_space(c), 256)
