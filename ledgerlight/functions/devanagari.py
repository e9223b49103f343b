"""Legacy 8-bit Devanagari text to Unicode, and Devanagari to Latin letters."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Private-use marks for parts that move: repha, repha in place, i with repha, i in place.
REPHA, REPHA_SET, I_REPHA, I_SET = "\ue000", "\ue001", "\ue002", "\ue003"
V = "्"

#: What each character of the legacy font stands for, by code. Consonants come as half forms.
GLYPHS = {
    " ": " ", "!": "!", "$": "ॐ", "%": "ऽ", "&": "ः", "'": ",", "(": "(", ")": ")", "*": "ा", "+": "अ",
    ",": ",", "-": "-", ".": ".", "/": "/", "0": "0", "1": "1", "2": "2", "3": "3", "4": "4", "5": "5", "6": "6", "7": "7", "8": "8", "9": "9",
    ":": ":", ";": ";", "<": "इ", "=": "उ", ">": "ऊ", "?": "?", "@": "ऋ", "A": "ॠ", "B": "ए",
    "C": "क्", "E": "क्", "F": "क़्", "G": "क्र्", "H": "क्त्", "I": "क्ष्",
    "J": "ख्", "K": "ख़्", "L": "ख़्", "M": "ग्", "N": "ग़्", "O": "ग्र्", "P": "घ्", "Q": "घ़्",
    "S": "च्", "U": "छ्", "V": "ज्", "W": "ज़्", "Y": "ज्ञ्", "Z": "झ्", "]": "ट्", "`": "ठ्",
    "b": "ड्", "c": "ड़्", "f": "ढ्", "g": "ढ़्", "h": "ण्", "i": "त्", "j": "त्र्", "k": "त्त्",
    "l": "थ्", "n": "द्", "o": "द्र्", "p": "द्र्", "q": "द्द्", "r": "द्ध्",
    "s": "ब्र्", "t": "द्य्", "u": "द्व्", "v": "ध्", "x": "न्", "z": "न्न्",
    "{": "प्", "|": "प्र्", "}": "फ्", "\xa1": "फ्", "\xa2": "फ़्", "\xa3": "फ्र्", "\xa4": "ब्",
    "\xa5": "ब्र्", "\xa6": "भ्", "\xa8": "म्", "\xaa": "य्", "\xae": "र", "\xaf": "र", "\xb0": "र", "\xb1": "ल्",
    "\xb4": "व्", "\xb6": "श्", "\xb7": "श्व्", "\xb8": "श्र्", "\xb9": "ष्", "\xba": "स्", "\xbb": "स्र्",
    "\xbd": "ह्", "\xc0": "ह्म्", "\xc2": "्", "\xc3": "", "\xc4": "ँ", "\xc5": "ँ", "\xc6": "ं", "\xc7": REPHA, "\xc8": REPHA, "\xc9": "ा",
    "\xca": "ि", "\xcb": "िं", "\xcc": I_REPHA, "\xcd": "िं", "\xce": "ि", "\xcf": "िं", "\xd2": "ी", "\xd3": "ीं", "\xd4": "ी" + REPHA,
    "\xd6": "ु", "\xda": "ू", "\xde": "ृ", "\xe0": "े", "\xe4": "े", "\xe5": "ें", "\xe6": "े" + REPHA, "\xe7": "ें" + REPHA, "\xe8": "ै",
    "\xe9": "ैं", "\xea": "ै" + REPHA, "\xeb": "ं" + REPHA, "\xec": "ॉ", "\xf0": "", "\xf1": "", "\xf2": "ा", "\xf4": "ा", "\xf5": "ा", "\xf6": "ा",
    "\xf7": "ा", "\xf8": "ा", "\xf9": "ा", "\xfa": "", "\xfb": "ा", "\xfc": "ू", "\xfe": "ा",
}

#: ASCII that stands for itself where the font has no glyph of its own.
PLAIN = "[A-Za-z0-9()\\[\\]{}/.,:;-]"

_C = "[क-हक़-य़]"
_CLUSTER = f"(?:{_C}{V})*{_C}"
_SIGN = "[ा-ौंःँृ]"
_INNER = "[ि-ौंःँृ]"
_AA = "ा"

#: Rewrites in the order in which they hold (pattern, replacement).
REWRITES = [
    (f"{V}({_INNER}*){REPHA}", f"{V}{REPHA}$1"),  # repha comes next to its virama
    (f"({_C}){V}{REPHA}({_INNER}*?){_AA}", f"{REPHA_SET}$1$2"),  # between half form and stem: before the consonant
    (f"{V}({_INNER}*?){_AA}", "$1"),  # half form and stem: the whole consonant
    ("ाे", "ो"), ("ाै", "ौ"), ("ाॉ", "ॉ"),  # two-part signs
    ("अा", "आ"), ("अो", "ओ"), ("अौ", "औ"), ("अे", "ए"), ("अै", "ऐ"),
    (f"{I_REPHA}({_CLUSTER})", f"{REPHA_SET}$1{I_SET}"),  # i with repha: both go around the cluster that follows
    (f"िं({_CLUSTER})", "$1िं"), (f"ि({_CLUSTER})", "$1ि"),  # i is typed before its cluster
    (f"({_CLUSTER})({_SIGN}*){REPHA}", f"{REPHA_SET}$1$2"),  # repha typed after its syllable
    (f"इ{REPHA}", "ई"),
    (f"[{REPHA_SET}{REPHA}]", f"र{V}"), (I_SET, "ि"),
]

#: The canonical compositions and decompositions that occur in Devanagari.
COMPOSED = [
    ("क़", "क़"), ("ख़", "ख़"), ("ग़", "ग़"), ("ज़", "ज़"), ("ड़", "ड़"), ("ढ़", "ढ़"), ("फ़", "फ़"), ("य़", "य़"),
    ("ऩ", "ऩ"), ("ऱ", "ऱ"), ("ऴ", "ऴ"),
]


def _glyphs() -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(GLYPHS.items())])


def canonical(text: Column) -> Column:
    """Unicode NFC of Devanagari text."""
    for old, new in COMPOSED:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def decode(text: Column) -> Column:
    """Legacy text (one character per byte) as Unicode; what the font table doesn't have becomes U+FFFD."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    known = F.transform(chars, lambda c: F.coalesce(F.try_element_at(_glyphs(), c), F.when(c.rlike(f"^{PLAIN}$"), c), F.lit("�")))
    out = F.array_join(known, "")
    for pattern, new in REWRITES:
        out = F.regexp_replace(out, pattern, new)
    return canonical(out)


def unknown(text: Column) -> Column:
    """Characters of the legacy text that decode() can't read, in order."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.filter(chars, lambda c: F.try_element_at(_glyphs(), c).isNull() & ~c.rlike(f"^{PLAIN}$"))


def unknown_remark(text: Column, column: int) -> Column:
    """Remark that names the unreadable codes, sorted and once each; null where there are none."""
    codes = F.array_sort(F.array_distinct(F.transform(unknown(text), lambda c: F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(F.ascii(c))), 2, "0")))))
    return F.when(F.size(codes) > 0, F.concat(F.lit("undecodable glyph(s) "), F.array_join(codes, ", "), F.lit(f" in column {column}")))


def has_devanagari(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"[\x{0900}-\x{097F}]")


def is_latin_query(text: Column) -> Column:
    """Some text, none of it Devanagari."""
    return (F.coalesce(text, F.lit("")) != "") & ~has_devanagari(text)


#: The public ITRANS scheme.
VOWELS = {"अ": "a", "आ": "A", "इ": "i", "ई": "I", "उ": "u", "ऊ": "U", "ऋ": "RRi", "ॠ": "RRI", "ऌ": "LLi", "ए": "e", "ऐ": "ai", "ऑ": "A.c", "ओ": "o", "औ": "au"}
SIGNS = {"ा": "A", "ि": "i", "ी": "I", "ु": "u", "ू": "U", "ृ": "RRi", "ॄ": "RRI", "े": "e", "ै": "ai", "ॉ": "A.c", "ो": "o", "ौ": "au"}
CONSONANTS = {"क": "k", "ख": "kh", "ग": "g", "घ": "gh", "ङ": "~N", "च": "ch", "छ": "Ch", "ज": "j", "झ": "jh", "ञ": "~n", "ट": "T", "ठ": "Th", "ड": "D", "ढ": "Dh", "ण": "N", "त": "t", "थ": "th", "द": "d", "ध": "dh", "न": "n", "प": "p", "फ": "ph", "ब": "b", "भ": "bh", "म": "m", "य": "y", "र": "r", "ल": "l", "ळ": "L", "व": "v", "श": "sh", "ष": "Sh", "स": "s", "ह": "h"}
NUKTA = {"क": "q", "ख": "K", "ग": "G", "ज": "z", "ड": ".D", "ढ": ".Dh", "फ": "f"}
MARKS = {"ं": "M", "ः": "H", "ँ": ".N", "ऽ": ".a", "ॐ": "OM", "।": "|"} | {chr(0x966 + i): str(i) for i in range(10)}


def romanize(text: str | None) -> str | None:
    """ITRANS letters of Devanagari; a consonant without a sign has its a. Text without Devanagari stays as it is."""
    if not text or not any("ऀ" <= c <= "ॿ" for c in text):
        return text
    out, open_ = [], False  # open_: a consonant that waits for its vowel
    for i, c in enumerate(text):
        if c in CONSONANTS:
            out.append("a" if open_ else "")
            out.append(NUKTA.get(c, CONSONANTS[c]) if text[i + 1 : i + 2] == "़" else CONSONANTS[c])
            open_ = True
        elif c in SIGNS or c == V:
            out.append(SIGNS.get(c, ""))
            open_ = False
        elif c != "़":
            out.append("a" if open_ else "")
            out.append(VOWELS.get(c) or MARKS.get(c) or c)
            open_ = False
    return "".join(out) + ("a" if open_ else "")
