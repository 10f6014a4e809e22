"""Vietnamese syllables: words that can't be one point at reading errors. Built-in functions only."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import letter_words

# Tone marks (grave, acute, tilde, hook, dot below), onsets and rhymes.
TONES, STOP_TONES = "\u0300\u0301\u0303\u0309\u0323", "\u0301\u0323"
ONSETS = "ngh ng nh ch gh gi kh ph th tr qu b c d đ g h k l m n p r s t v x"
RHYMES = """
a ac ach ai am an ang anh ao ap at au ay ăc ăm ăn ăng ăp ăt âc âm ân âng âp ât âu ây
e ec em en eng eo ep et ê êch êm ên ênh êp êt êu
i ia ich im in inh ip it iu iêc iêm iên iêng iêp iêt iêu y yêm yên yêt yêu
o oc oi om on ong op ot oong ooc oa oac oach oai oam oan oang oanh oao oap oat oay oăc oăm oăn oăng oăt oe oen oeo oet
ô ôc ôi ôm ôn ông ôp ôt ơ ơi ơm ơn ơp ơt
u uc ui um un ung up ut ua uân uâng uât uây uê uêch uênh uy uya uych uyên uyêt uynh uyt uyu uôc uôi uôm uôn uông uôt uơ
ư ưc ưi ưm ưn ưng ưt ưu ưa ươc ươi ươm ươn ương ươp ươt ươu
"""


def _toned() -> tuple[str, str, str]:
    """(letters with a tone, the letters without it, those among the first that a final stop does not allow)."""
    src, dst, barred = "", "", ""
    for c in map(chr, range(0xC0, min(sys.maxunicode, 0x2000))):
        parts = unicodedata.normalize("NFD", c)
        tone = [x for x in parts if x in TONES]
        base = unicodedata.normalize("NFC", "".join(x for x in parts if x not in TONES))
        if len(tone) == 1 and len(base) == 1 and c.lower() == c and c not in TONES:
            src, dst, barred = src + c, dst + base, barred + ("" if tone[0] in STOP_TONES else c)
    return src, dst, barred


TONED, PLAIN, BARRED = _toned()
ANY_TONE = f"[{TONED}{TONES}]"
BARRED_TONE = f"[{BARRED}{''.join(t for t in TONES if t not in STOP_TONES)}]"
SHAPE = f"^(?:(?:{'|'.join(ONSETS.split())})?(?:{'|'.join(RHYMES.split())})|gi)$"
STOP = "(?:p|t|c|ch)$"
COMPOSED = {unicodedata.normalize("NFD", c): c for c in "âêôăơư"}


def valid_syllable(c: Column) -> Column:
    """At most one tone, a known onset and rhyme, and before a final stop only the two tones it allows. Null stays null."""
    low = F.lower(c)
    base = F.translate(low, TONED + TONES, PLAIN)
    for parts, letter in COMPOSED.items():
        base = F.replace(base, F.lit(parts), F.lit(letter))
    return (F.regexp_count(low, F.lit(ANY_TONE)) <= 1) & ~(low.rlike(BARRED_TONE) & base.rlike(STOP)) & base.rlike(SHAPE)


def suspicious_words(c: Column) -> Column:
    """Words of letters that are not ASCII and no valid syllable, in text order; pure ASCII may be another language."""
    return F.filter(letter_words(c), lambda w: w.rlike(r"[^\x00-\x7F]") & ~valid_syllable(w))
