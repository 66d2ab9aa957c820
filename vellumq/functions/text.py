"""Column functions over words, lines and texts. All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

W = r"[\p{L}\p{N}_]"
#: A word: letters, digits and underscores, with inner apostrophes.
WORD = rf"{W}+(?:['’]{W}+)*"
#: Lookaround-free ends of a sentence: a stop, then closing quotes and brackets, then white space or the end.
SENTENCE_END = r"""([.!?][”’"'\)\]]*)(\s+|$)"""

#: Words whose wrong use an edition's scorer looks for first.
SMALL = tuple(
    """a an the and or of to in on at by for from with not no nor but if is it its be he
    him his her she they them then than that this these those there their we us our you ye your
    was were are am has had have do did doth hath shall should will would may might can could must
    so as all any one who whom which what when where while yet""".split()
)
#: Words that may stand twice.
FINE_DOUBLED = ("that", "had", "is", "do", "very")
#: Names of biblical books, as an edition abbreviates them.
BOOKS = tuple(
    """Gen Genesis Exod Exo Ex Lev Num Deut Deu Josh Judg Ruth Sam Kings Kgs Chron
    Chr Ezra Neh Esth Job Psa Psalm Psalms Ps Prov Pro Eccl Eccles Ecc Song Cant Isa Isaiah Jer
    Lam Ezek Eze Dan Hos Joel Amos Obad Jonah Jon Mic Micah Nah Hab Habak Zeph Hag Zech Mal Matt
    Mat Mark Luke John Acts Act Rom Cor Gal Eph Phil Col Thess Thes Tim Titus Tit Philem Heb
    James Jas Pet Jude Rev""".split()
)


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def spaced_words(text: Column) -> Column:
    """Runs of anything but white space."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\S+"), F.lit(0))


#: Letters whose capitals are several letters (as of ß: SS); signs of private use that keep them from that; and the one letter that is the capital of each, or itself.
_SEVERAL = "".join(c for c in map(chr, [*range(0xD800), *range(0xE000, 0x10000)]) if len(c.upper()) > 1)
_HELD = "".join(chr(0xF0000 + i) for i in range(len(_SEVERAL)))
_CAPITALS = "".join("ẞ" if c == "ß" else c.title() if len(c.title()) == 1 else c for c in _SEVERAL)


def capitals(text: Column) -> Column:
    """Upper case, letter by letter, as SQL has it: a text keeps its length."""
    return F.translate(F.upper(F.translate(text, _SEVERAL, _HELD)), _HELD, _CAPITALS)


def small_letters(text: Column) -> Column:
    """Lower case, letter by letter, whatever stands around it."""
    return F.lower(F.translate(text, "İΣ", "iσ"))


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def collapsed(text: Column) -> Column:
    """White space as single spaces."""
    return F.regexp_replace(text, r"\s+", " ")


def ends_marked(text: Column) -> Column:
    """The text with a sign after each word that ends a sentence."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SENTENCE_END, "$1\u0001")


def sentences(text: Column) -> Column:
    """The text cut after each word that ends a sentence; empty pieces left out."""
    return F.filter(F.split(ends_marked(text), "\u0001"), lambda x: F.trim(x) != "")


def _pairs(word: Column) -> Column:
    return F.regexp_replace(word, r"(.)\1", "$1")


def _final_e(word: Column) -> Column:
    # one pattern rather than a condition: a condition would hold the word's whole expression several times
    return F.regexp_replace(word, "^(.{3,})e$", "$1")


def loose_key(word: Column) -> Column:
    """What two printings share: v as u, j and y as i, each pair of a letter as one, no final e."""
    w = F.regexp_replace(F.regexp_replace(F.lower(word), "ſ", "s"), "[^a-z]", "")
    return _final_e(_pairs(F.translate(w, "vjy", "uii")))


def ocr_key(word: Column) -> Column:
    """What two readings of one print share: as loose_key, also f as s, w as uu, whole runs of a letter as one."""
    w = F.regexp_replace(F.regexp_replace(F.lower(word), "[ſf]", "s"), "[^a-z]", "")
    w = F.regexp_replace(F.translate(w, "vjy", "uii"), "w", "uu")
    return _final_e(F.regexp_replace(w, r"(.)\1+", "$1"))


def crop_key(word: Column) -> Column:
    """Letters and digits only, pairs as one, f as s."""
    return _pairs(F.regexp_replace(F.regexp_replace(F.lower(word), "[ſf]", "s"), "[^a-z0-9]", ""))


def typography_key(text: Column) -> Column:
    """Curly quotes and dashes as plain ones."""
    return F.translate(text, "’‘“”—–‐ʼ", "''\"\"---'")


def paragraph_key(text: Column, k: int = 12) -> Column:
    """A paragraph's first k words in a form that two printings share."""
    t = F.translate(F.regexp_replace(F.lower(F.regexp_replace(text, r"#\w+\[|[\]\\]", " ")), "ſ", "s"), "vj", "ui")
    found = F.regexp_extract_all(t, F.lit("[a-z]+"), F.lit(0))
    return F.array_join(F.slice(F.transform(found, _final_e), 1, k), " ")


def uv_rule(word: Column) -> Column:
    """Initial v before a consonant is u; u between vowels is v."""
    w = F.regexp_replace(word, "^v(?=[bcdfghjklmnpqrstwxz])", "u")
    return F.regexp_replace(w, "(?<=[aeiouy])u(?=[aeiouy])", "v")


def ij_rule(word: Column) -> Column:
    return F.regexp_replace(word, "^i(?=[aeou])", "j")


def suffix_rule(word: Column) -> Column:
    """-sse to -ss, -ie to -y, in words of five letters and of four or more."""
    return F.regexp_replace(F.regexp_replace(word, "^(.{2,}ss)e$", "$1"), "^(.{2,})ie$", "$1y")


def letterforms(word: Column) -> Column:
    """The unambiguous letterform rules, on a lower-case word."""
    return suffix_rule(ij_rule(uv_rule(word)))


def case_pattern(original: Column, modern: Column) -> Column:
    """The capitals of the original word on another: all, the first, or none."""
    first = F.substring(original, 1, 1)
    upper = (F.upper(original) == original) & (F.lower(original) != original) & (F.length(original) > 1)
    titled = (F.upper(first) == first) & (F.lower(first) != first)
    return F.when(upper, F.upper(modern)).when(titled, F.concat(F.upper(F.substring(modern, 1, 1)), F.substring(modern, F.lit(2), F.length(modern)))).otherwise(modern)


def _cut(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def silent_e_forms(word: Column) -> Column:
    """Modern forms that an early spelling may stand for, the likeliest first."""
    n = F.length(word)

    def at(back: int) -> Column:
        return F.substring(word, n - back + 1, F.lit(1))

    e, es = word.endswith("e"), word.endswith("es")
    doubled = F.substring(word, n - 1, F.lit(2)).isin("ll", "ff", "mm", "nn", "pp", "tt", "rr", "ss")
    return F.array_compact(F.array(
        F.when(e & (n > 3), _cut(word, 1)), F.when(e & (n > 4) & (at(2) == at(3)), _cut(word, 2)),
        F.when(es & (n > 4), F.concat(_cut(word, 2), F.lit("s"))), F.when(es & (n > 5) & (at(3) == at(4)), F.concat(_cut(word, 3), F.lit("s"))),
        F.when(doubled & (n > 4), _cut(word, 1)), F.when(word.endswith("nes") & (n > 4), F.concat(word, F.lit("s"))),
        F.when(word.endswith("cke") & (n > 4), F.concat(_cut(word, 2), F.lit("c"))),
        F.when(word.endswith("eness") & (n > 6), F.concat(_cut(word, 5), F.lit("ness"))), F.when(word.endswith("sness") & (n > 6), F.concat(_cut(word, 5), F.lit("ssness"))),
    ))


def roman_value(word: Column) -> Column:
    """The value of a roman numeral of i, v, x, l, c; null if it is none."""
    values = F.transform(F.filter(F.split(F.lower(word), ""), lambda c: c != ""), lambda c: F.when(c == "i", 1).when(c == "v", 5).when(c == "x", 10).when(c == "l", 50).when(c == "c", 100))
    signed = F.zip_with(values, F.concat(F.slice(values, 2, F.size(values)), F.array(F.lit(0))), lambda v, after: F.when(after > v, -v).otherwise(v))
    return F.when(word.rlike("^[ivxlcIVXLC]+$"), F.aggregate(signed, F.lit(0), lambda s, x: s + x))


def verse_numbers(text: Column) -> Column:
    """'20, 21-23' as the numbers it names."""
    def span(part: Column) -> Column:
        a = F.regexp_extract(part, r"^\s?(\d+)", 1).cast("int")
        b = F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(part, r"[-–]\s?(\d+)", 1), F.lit("")), F.lit("999")).cast("int"), a)
        return F.sequence(a, F.greatest(a, b))

    return F.flatten(F.transform(F.split(text, r"\s?,\s?"), span))


def plain_html(html: Column) -> Column:
    """Scripts, styles, comments and tags left out, five entities read, white space collapsed."""
    t = F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>", " ")
    t = F.regexp_replace(F.regexp_replace(t, r"(?s)<!--.*?-->", " "), r"<[^>]+>", " ")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(sign))
    return F.trim(collapsed(t))


def escaped_html(text: Column) -> Column:
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(sign), F.lit(entity))
    return text


def escaped_markup(text: Column) -> Column:
    r"""A backslash before each character that a typesetter's markup gives a meaning."""
    return F.regexp_replace(text, r"([\\#\[\]*_$@<>`])", r"\\$1")


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-|-$", "")


def version_numbers(tag: Column) -> Column:
    """'v13.1' as [13, 1]."""
    return F.transform(F.split(F.regexp_replace(tag, "^v", ""), r"\."), lambda x: x.cast("int"))


def ordinal(n: Column) -> Column:
    tens = n % 100
    return F.concat(n.cast("string"), F.when((tens >= 11) & (tens <= 13), "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th"))


def level_em(level: Column) -> Column:
    """Indent of an outline level: 0, 2, 4, 6, then one more for each."""
    return F.when(level <= 3, level * 2).otherwise(level + 3)


def em_level(em: Column) -> Column:
    return F.when(em <= 6, (em / 2).cast("int")).otherwise((em - 3).cast("int"))


def word_score(word: Column, lp: Column, best: Column, best_lp: Column) -> Column:
    """How wrong a word looks: an unlikely small word, or a confident other small word in its place."""
    bare = F.regexp_replace(F.lower(word), "[^a-z]", "")
    small = bare.isin(*SMALL)
    wrong = F.when(small & (lp <= -15.0), 15.0).when(small & (lp > -15.5), -lp).otherwise(0.0)
    gap = F.when((best != bare) & (best_lp > -3.0) & (lp < best_lp - 2.0), (best_lp + 3.0) * 3 + F.least(F.lit(6.0), best_lp - lp)).otherwise(0.0)
    return F.when(lp.isNull(), 0.0).otherwise(F.greatest(wrong, gap))


def shortened(found: Column, n: int) -> Column:
    """The first n words, with an ellipsis if there are more."""
    return F.when(F.size(found) > n, F.concat(F.array_join(F.slice(found, 1, n), " "), F.lit(" …"))).otherwise(F.array_join(found, " "))


def curled(text: Column) -> Column:
    """Straight quotes as curly ones, by the character before."""
    t = F.regexp_replace(text, r"""(^|[\s\(\[—“‘-])\"""", "$1“")
    t = F.regexp_replace(t, '"', "”")
    t = F.regexp_replace(t, r"(^|[\s\(\[—“-])'", "$1‘")
    return F.replace(t, F.lit("'"), F.lit("’"))
