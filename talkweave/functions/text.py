"""Text expressions, Column to Column: stripping, words, languages, punctuation, placeholders, payloads.

Everything stays in the JVM. Regular expressions that must know Unicode classes ask for them with ``(?U)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import let

#: Letters and digits of words (Latin, Russian, Kazakh), and the classes that tell languages apart.
WORD = "[A-Za-zА-Яа-яЁёӘәІіҢңҒғҮүҰұҚқӨөҺһ0-9]+"
KAZAKH = "[ӘәІіҢңҒғҮүҰұҚқӨөҺһ]"
CYRILLIC = "[А-Яа-яЁё]"
LATIN = "[A-Za-z]"
PUNCTUATION = ".,!?;:-()[]{}\"'"
PLACEHOLDERS = {"NAME": "[ИМЯ]", "PHONE": "[ТЕЛЕФОН]", "ID": "[ID]", "ADDRESS": "[АДРЕС]", "EMAIL": "[EMAIL]"}
PHONE = r"(?U)\b\+?\d[\d\s\-()]{6,}\b"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
LONG_NUMBER = r"(?U)\b\d{8,}\b"

_SPACE = "[\\s\\x1c-\\x1f]"


def strip(text: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(text, f"(?U)^{_SPACE}+|{_SPACE}+$", "")


def collapse(text: Column) -> Column:
    """Stripped, each run of white space one space."""
    return F.regexp_replace(strip(text), f"(?U){_SPACE}+", " ")


def normalise(text: Column) -> Column:
    return F.lower(collapse(text))


def raw_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def words(text: Column) -> Column:
    return F.transform(raw_words(text), F.lower)


def drifted(source: Column, candidate: Column) -> Column:
    """Whether the word sequences differ."""
    return words(source) != words(candidate)


def token_language(token: Column) -> Column:
    has = lambda p: F.rlike(token, F.lit(p))
    return F.when(has(KAZAKH), "kk").when(has(CYRILLIC) & has(LATIN), "mixed").when(has(CYRILLIC), "ru").when(has(LATIN), "lat").otherwise("other")


def labels(tokens: Column) -> Column:
    """Languages of the tokens, without ``other``."""
    return F.filter(F.transform(tokens, token_language), lambda x: x != "other")


def space_tokens(text: Column) -> Column:
    return F.filter(F.split(collapse(text), " "), lambda x: x != "")


def _switches(found: Column) -> Column:
    return F.size(F.filter(found, lambda x, i: (i > 0) & (x != F.coalesce(F.get(found, i - 1), x))))


def code_switched(text: Column) -> Column:
    return let(labels(space_tokens(text)), _switches) > 0


def dominant_language(text: Column) -> Column:
    """The commonest label of the white-space tokens; ties go to ru, kk, lat, mixed in this order."""
    order = ("ru", "kk", "lat", "mixed")

    def of_labels(found: Column) -> Column:
        return F.struct(*[F.size(F.filter(found, _is(x))).alias(x) for x in order])

    def of_counts(n: Column) -> Column:
        most, out = F.greatest(*[n[x] for x in order]), F.lit("mixed")
        for x in ("lat", "kk", "ru"):
            out = F.when(n[x] == most, x).otherwise(out)
        return F.when(most == 0, "unknown").otherwise(out)

    return let(let(labels(space_tokens(text)), of_labels), of_counts)


def _is(label: str):
    return lambda x: x == label


def switching_ratio(texts: Column) -> Column:
    """Language changes between neighbouring words of all texts in order, per possible change."""
    ratio = lambda found: F.when(F.size(found) < 2, F.lit(0.0)).otherwise(_switches(found) / F.greatest(F.lit(1), F.size(found) - 1))
    return let(labels(F.flatten(F.transform(texts, raw_words))), ratio)


def n_punctuation(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, PUNCTUATION, ""))


def punctuation_density(texts: Column) -> Column:
    density = lambda t: F.when(t == "", F.lit(0.0)).otherwise(n_punctuation(t) / F.greatest(F.lit(1), F.length(t)))
    return let(F.array_join(F.filter(texts, lambda t: t != ""), " "), density)


def light_enhance(text: Column) -> Column:
    """Collapsed, with a capital where the first character is a letter."""
    capital = lambda t: F.when(F.rlike(t, F.lit("^\\p{L}")), F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, F.lit(2), F.length(t)))).otherwise(t)
    return let(collapse(text), capital)


def count_of(text: Column, literal: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(literal), F.lit("")))) / F.lit(len(literal))


def placeholder_counts(text: Column) -> Column:
    """Map of entity to the number of its placeholders, without zeros."""
    pairs = [x for k, p in PLACEHOLDERS.items() for x in (F.lit(k), count_of(text, p).cast("bigint"))]
    return F.map_filter(F.create_map(*pairs), lambda _, n: n > 0)


def pii_candidate(text: Column) -> Column:
    return F.rlike(text, F.lit(PHONE)) | F.rlike(text, F.lit(EMAIL)) | F.rlike(text, F.lit(LONG_NUMBER))


def seg_payload(texts: Column) -> Column:
    """Texts as numbered elements, one a line; markup in a text is escaped, so that it can't end its element."""
    clean = lambda t: F.replace(F.replace(strip(F.translate(t, "\n", " ")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return F.array_join(F.transform(texts, lambda t, i: F.concat(F.lit('<SEG id="'), i.cast("string"), F.lit('">'), clean(t), F.lit("</SEG>"))), "\n")


#: Fixed value: how an element of a payload is written.
SEG = r"(?is)<SEG\s+id=['\"]?(\d+)['\"]?>(.*?)</SEG>"


def seg_parse(payload: Column, expected: Column) -> Column:
    """The texts 0 to expected - 1; of repeated ids the last counts; empty if any is missing. Ids beyond a long are nobody's."""
    part = lambda i: F.regexp_extract_all(payload, F.lit(SEG), F.lit(i))
    entry = F.arrays_zip(part(1).alias("i"), part(2).alias("t"))
    found = F.filter(F.transform(entry, lambda x, k: F.struct(x["i"].try_cast("bigint").alias("i"), k.alias("k"), x["t"].alias("t"))), lambda x: x["i"].isNotNull())
    none = F.array().cast("array<string>")

    def last_of(s: Column) -> Column:
        last = F.filter(s, lambda x, k: F.coalesce(F.get(s, k + 1)["i"] != x["i"], F.lit(True)))
        return F.map_from_entries(F.transform(last, lambda x: F.struct(x["i"], x["t"])))

    def texts_of(m: Column) -> Column:
        unescaped = lambda t: F.replace(F.replace(strip(t), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))
        places = F.sequence(F.lit(0).cast("bigint"), F.greatest(expected, F.lit(1)).cast("bigint") - 1)
        return F.when(expected > 0, F.transform(places, lambda k: unescaped(F.try_element_at(m, k)))).otherwise(none)

    texts = let(let(F.sort_array(found), last_of), texts_of)
    return let(texts, lambda t: F.when(F.exists(t, lambda x: x.isNull()), none).otherwise(t))
