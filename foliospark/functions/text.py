"""Text columns: folding, normal forms, markers, page lists and labels. All built-in functions, no Python rows."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Words that a concept's query can do without, in folded form.
STOP_WORDS = ("va", "cua", "la", "cac", "nhung", "trong", "the", "cho", "mot", "co", "khi", "hay", "theo", "tac", "gia", "so")


def _tables() -> tuple[str, str, str]:
    """(letters, their base letters, nonspacing marks), derived from the Unicode database."""
    src, dst, marks = [], [], []
    for c in map(chr, range(0x80, sys.maxunicode + 1)):
        kind = unicodedata.category(c)
        if kind == "Mn":
            marks.append(c)
        elif kind[0] == "L" and not 0xAC00 <= ord(c) <= 0xD7A3:
            base = [x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn"]
            if len(base) == 1 and base[0] != c and c.lower() == c:
                src.append(c)
                dst.append(base[0])
    return "".join(src) + "đ", "".join(dst) + "d", "".join(marks)


LETTERS, BASES, MARKS = _tables()


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends (``trim`` only takes spaces)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def fold(c: Column) -> Column:
    """Lower case, đ as d, accents deleted, also those that stand alone."""
    return F.translate(F.lower(c), LETTERS + MARKS, BASES)


def fold_same_length(c: Column) -> Column:
    """As ``fold``, but every character stays one character, so places in the result are places in the text."""
    return F.translate(F.lower(c), LETTERS, BASES)


def final_i(c: Column) -> Column:
    """Word-final y becomes i after a consonant or qu."""
    return F.regexp_replace(c, r"(?<=[bcdghklmnpqrstvx]|qu)y(?![a-z])", "i")


def norm(c: Column) -> Column:
    """Folded, only a-z and 0-9."""
    return F.regexp_replace(fold(c), "[^a-z0-9]", "")


def clean(c: Column) -> Column:
    """Folded words parted by one space, with a space at both ends."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(fold(c), "[^a-z0-9]+", " ")), F.lit(" "))


def search_key(c: Column, loose: bool = False) -> Column:
    key = final_i(fold_same_length(c))
    return F.regexp_replace(key, r"(?U)\s", "") if loose else key


def tokens(c: Column) -> Column:
    return F.filter(F.split(strip(c), r"(?U)\s+"), lambda w: w != "")


def letter_words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"\p{L}+"), F.lit(0))


def snippet(text: Column, start: Column, end: Column, width: int = 90) -> Column:
    """``width`` characters around [start, end) (from 0), on one line, with ellipses where text is cut."""
    left, right = F.greatest(start - width, F.lit(0)), F.least(end + width, F.char_length(text))
    body = F.translate(F.substring(text, left + 1, right - left), "\n", " ")
    return F.concat(F.when(left > 0, "…").otherwise(""), body, F.when(right < F.char_length(text), "…").otherwise(""))


def page_list(c: Column) -> Column:
    """Pages of a list such as ``10-13, 17; 20–21``; a reversed range is empty; sorted and distinct."""
    parts = F.filter(F.split(F.regexp_replace(c, "–", "-"), "[,;]"), lambda p: p.rlike(r"^\s*\d+\s*(-\s*\d+\s*)?$"))
    first = lambda p: F.trim(F.element_at(F.split(p, "-"), 1)).cast("int")
    last = lambda p: F.trim(F.element_at(F.split(p, "-"), -1)).cast("int")
    span = lambda p: F.when(first(p) <= last(p), F.sequence(first(p), last(p))).otherwise(F.array().cast("array<int>"))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(parts, span))))


def page_bounds(c: Column) -> Column:
    """Both ends of every range in a page list."""
    both = F.concat(F.regexp_extract_all(c, F.lit(r"(\d+)(?:\s*[-–]\s*(\d+))?"), F.lit(1)), F.regexp_extract_all(c, F.lit(r"(\d+)(?:\s*[-–]\s*(\d+))?"), F.lit(2)))
    return F.transform(F.filter(both, lambda x: x != ""), lambda x: x.cast("int"))


def auto_queries(term: Column) -> Column:
    """Query terms of a concept: the first ``/`` alternative outside parentheses, then the first comma part of the first parenthesis, else the second alternative."""
    outside = F.split(F.regexp_replace(term, r"\([^)]*\)", " "), "/")
    inner = F.regexp_extract(term, r"\(([^)]*)\)", 1)
    second = F.when(inner != "", F.element_at(F.split(inner, ","), 1)).otherwise(F.get(outside, F.lit(1)))
    made = F.array(F.element_at(outside, 1), second)
    return F.filter(F.transform(made, lambda q: F.trim(clean(q))), lambda q: F.coalesce(q, F.lit("")) != "")


def conjunction(query: Column) -> Column:
    return F.filter(F.transform(F.split(query, r"\+"), lambda p: F.trim(clean(p))), lambda p: p != "")


def has_words(text: Column, parts: Column) -> Column:
    """Every part stands in the padded clean text as whole words."""
    return F.forall(parts, lambda p: F.contains(text, F.concat(F.lit(" "), p, F.lit(" "))))


def has_letters(text: Column, parts: Column) -> Column:
    """As ``has_words`` without regard to spaces."""
    tight = F.replace(text, F.lit(" "), F.lit(""))
    return F.forall(parts, lambda p: F.contains(tight, F.replace(p, F.lit(" "), F.lit(""))))


def printed_number(c: Column) -> Column:
    """A page number of at most three digits, inner spaces allowed, wrapped in other than word characters; else null."""
    digits = F.regexp_replace(F.regexp_extract(c, r"(?U)^[^\w]*(\d(?:\s?\d){0,2})[^\w]*$", 1), r"\s", "")
    return F.when(digits != "", digits.cast("int"))


def cell(c: Column) -> Column:
    return F.replace(c, F.lit("|"), F.lit("\\|"))


def chapter_file(no: Column, slug: Column) -> Column:
    return F.concat(no, F.lit("-"), slug, F.lit(".md"))


def figure_file(no: Column, page: Column, k: Column) -> Column:
    return F.format_string("%s/p%03d-%d.jpg", no, page, k)


def chapter_name(label: Column, title: Column) -> Column:
    """``label: title``, or the title of a chapter without label."""
    return F.concat_ws(": ", label, title)


def html_escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


#: Bullets that open a paragraph; what stands before a title that isn't part of it.
BULLET = r"^[•●○◦·]\s*"
TITLE_JUNK = r"^(?:[•●○◦·®\-\s]|\[\?\])*"


def listed(c: Column) -> Column:
    """A bullet at the start becomes a dash."""
    return F.regexp_replace(c, BULLET, "- ")


def bare_title(c: Column) -> Column:
    """Without bullets, section icons and doubt marks at the start."""
    return F.regexp_replace(c, TITLE_JUNK, "")


def doubted(c: Column, conf: Column, least: float = 0.8, mark: str = " [?]") -> Column:
    """The text with a doubt mark where its confidence is under ``least``; a null confidence doubts nothing."""
    return F.when(conf < least, F.concat(c, F.lit(mark))).otherwise(c)


def without_markup(c: Column, mark: str = "[?]") -> Column:
    """Corpus lines without quote and figure prefixes, fences and doubt marks."""
    c = F.regexp_replace(c, r"^```\w*$", "")
    c = F.regexp_replace(c, r"^>\s*(\[[^\]]*\]:?\s*)?", "")
    return F.replace(c, F.lit(mark), F.lit(""))


def collation_key(c: Column, alphabet: str = "aăâbcdđeêghiklmnoôơpqrstuưvxy") -> Column:
    """Sort key: letters by a 29-letter alphabet with tones stripped, other characters after them by code point + 100; ties by the tone marks in code-point order."""
    decomposed = {c: unicodedata.normalize("NFD", c) for c in LETTERS}
    tones = "̣̀́̃̉"
    toned = {c: (unicodedata.normalize("NFC", "".join(x for x in d if x not in tones)), "".join(x for x in d if x in tones)) for c, d in decomposed.items() if any(t in d for t in tones)}
    keep = {c: b for c, (b, _) in toned.items() if len(b) == 1}
    plain = F.translate(F.lower(c), "".join(keep), "".join(keep.values()))
    rank = F.create_map(*[F.lit(x) for i, a in enumerate(alphabet) for x in (a, i)])
    chars = F.filter(F.split(plain, ""), lambda x: x != "")
    key = F.transform(chars, lambda x: F.coalesce(rank[x], F.ascii(x) + 100))
    marks = F.translate(F.lower(c), "".join(keep), "".join(toned[x][1][0] for x in keep))
    return F.struct(key.alias("letters"), F.regexp_replace(marks, f"[^{tones}]", "").alias("tones"))
