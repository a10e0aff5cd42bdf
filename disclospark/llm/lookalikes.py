"""One form for texts that read the same.

A text is searched once for unstable characters: those the canonical form changes or joins. Everything else is stable and stays as it
is. An unstable character is taken with its boundary context, the starter before it and the combining marks behind it; only these segments are
normalised, and the results spliced into the unchanged text. ASCII texts are stable as they stand.

The form: width variants, ligatures and other joined letters apart, look-alike hyphens to the hyphen, any
blank of one space to a space, characters that show nothing out, and letters with marks composed. Case, accents, digits, dashes of another
length, tabs and line ends stay. Look-alike letters take the script of their word, so Cyrillic and Greek text keeps its letters. The skeleton, by which texts are
compared, is the form with every look-alike letter turned Latin.

A word whose letters without a twin are of one script is of that script; look-alikes in it are turned to it. A word of look-alikes only stays if it is all of one
other script and the text has a word that is surely of that script; else it turns Latin. A word with sure letters of two scripts stays as it is.

Cases: null stays null, an empty text empty; a text of invisible characters only becomes empty; texts of any length are treated whole;
the form of a form is itself.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# Letters that look like Latin ones, each line as `Latin: look-alikes`.
LOOK_ALIKES = """
A: Α А Ꭺ ꓮ
B: Β В Ᏼ ꓐ
C: Ϲ С Ꮯ ꓚ
D: Ꭰ ꓓ
E: Ε Е Ꭼ ꓰ
F: Ϝ ꓝ
G: Ԍ Ꮐ ꓖ
H: Η Н Ꮋ ꓧ
I: Ι І Ӏ ꓲ
J: Ј Ꭻ Ϳ ꓙ
K: Κ К Ꮶ ꓗ
L: Ꮮ ꓡ
M: Μ М Ꮇ Ϻ ꓟ
N: Ν ꓠ
O: Ο О Օ ꓳ
P: Ρ Р Ꮲ ꓑ
Q: Ԛ
R: Ꭱ ꓣ
S: Ѕ Տ Ꮪ ꓢ
T: Τ Т Ꭲ ꓔ
U: Ս ꓴ
V: Ѵ Ꮩ ꓦ
W: Ԝ Ꮃ ꓪ
X: Χ Х ꓫ
Y: Υ Ү ꓬ
Z: Ζ Ꮓ ꓜ
a: а α ɑ
c: с ϲ
d: ԁ
e: е
g: ɡ
h: һ
i: і ι
j: ј ϳ
l: ӏ
n: ո
o: о ο օ
p: р ρ
q: ԛ
s: ѕ
u: υ ս
v: ν ѵ
w: ԝ
x: х
y: у ү
-: ‐ ‑ ﹣ －
'’: ʼ
"""
# Blanks of one space.
BLANKS = (0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)
#: Parts into which the rows of each form are dealt when pairs are made.
SALTS = 4
_TAGS = ("<wide>", "<narrow>", "<compat>", "<noBreak>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>")


def _shows_nothing(c: str) -> bool:
    n = ord(c)
    if c in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85":
        return False
    return (
        unicodedata.category(c) in ("Cf", "Cc")
        or n in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0)
        or 0x180B <= n <= 0x180F or 0xFE00 <= n <= 0xFE0F or 0xE0000 <= n <= 0xE0FFF
    )


def tables() -> tuple[dict[int, str], str]:
    """(replacement of each character, all unstable characters), from the rules above and the character database."""
    swap: dict[int, str] = {}
    for line in LOOK_ALIKES.strip().splitlines():
        latin, _, others = line.partition(": ")
        for o in others.split():
            swap[ord(o)] = latin[-1]
    unstable = set()
    for n in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= n <= 0xDFFF or 0xAC00 <= n <= 0xD7A3 or 0x3400 <= n <= 0x9FFF or 0x20000 <= n <= 0x2F7FF:
            continue
        c = chr(n)
        if n in BLANKS:
            swap[n] = " "
        elif _shows_nothing(c):
            swap[n] = ""
        elif n not in swap:
            parts = unicodedata.decomposition(c).split()
            if parts and parts[0] in _TAGS:
                to = "".join(chr(int(x, 16)) for x in parts[1:])
                if not to.startswith(" ") and not any(x.isdecimal() for x in to) or parts[0] in ("<wide>", "<narrow>", "<font>"):
                    swap[n] = to
        plain = unicodedata.normalize("NFD", c)
        if n in swap or len(plain) > 1 and ord(plain[0]) in swap or unicodedata.combining(c) or unicodedata.normalize("NFC", c) != c:
            unstable.add(n)
        # what composes with a character before it, marks of combining class 0 too
        if len(plain) > 1 and unicodedata.normalize("NFC", c) == c:
            unstable.add(int(unicodedata.decomposition(c).split()[-1], 16))
    # the same of Hangul: vowel and tail letters
    unstable.update(range(0x1161, 0x1176), range(0x11A8, 0x11C3))
    for n in range(0x20):
        if _shows_nothing(chr(n)):
            swap[n] = ""
            unstable.add(n)
    swap[0x7F] = ""
    unstable.add(0x7F)
    # replacements of replacements, to a fixed point
    for n, to in list(swap.items()):
        for _ in range(4):
            to = "".join(swap.get(ord(x), x) for x in to)
        swap[n] = to
    return swap, "".join(map(chr, sorted(unstable)))


def canonicaliser(swap: dict[int, str], unstable: str) -> Callable[[str | None], str | None]:
    quick = frozenset(unstable)
    control = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")
    runs: dict[str, re.Pattern] = {}

    def form(text: str | None) -> str | None:
        if not text or text.isascii() and not control.search(text):
            return text
        met = quick.intersection(text)
        if not met:
            return text
        key = "".join(sorted(met))
        if key not in runs:
            if len(runs) > 10_000:
                runs.clear()
            runs[key] = re.compile(f"[{re.escape(key)}]+")
        out, at = [], 0
        for m in runs[key].finditer(text):
            # boundary context: the stable character before the run; marks after it are unstable and so part of it
            start = max(at, m.start() - 1)
            out.append(text[at:start])
            plain = unicodedata.normalize("NFD", text[start : m.end()].translate(swap)).translate(swap)
            out.append(unicodedata.normalize("NFC", plain))
            at = m.end()
        out.append(text[at:])
        joined = "".join(out)
        # where a removed character had parted a starter from what follows, the context was wider
        return joined if unicodedata.is_normalized("NFC", joined) else unicodedata.normalize("NFC", joined)

    return form


_WORD = re.compile(r"[^\W\d_](?:[^\W\d_]|[\u0300-\u036f])*")


def _script(c: str) -> str:
    return unicodedata.name(c, "?").split()[0]


class _Scripts:
    """Look-alike letters to the script of their word; marks on letters stay."""

    def __init__(self, look_alikes: str = LOOK_ALIKES) -> None:
        self.latin: dict[str, str] = {}
        self.other: dict[tuple[str, str], str] = {}
        for line in look_alikes.strip().splitlines():
            to, _, others = line.partition(": ")
            for o in others.split():
                if o.isalpha() and to[-1].isalpha():
                    self.latin[o] = to[-1]
                    self.other.setdefault((_script(o), to[-1]), o)
        self.twins = {s: frozenset(to for t, to in self.other if t == s) for s in ("CYRILLIC", "GREEK")}
        self.any = frozenset(self.latin)

    def _turn(self, word: str, to: Callable[[str], str]) -> str:
        return unicodedata.normalize("NFC", "".join(map(to, unicodedata.normalize("NFD", word))))

    def _sure(self, letters: str) -> set[str]:
        """Scripts of the letters that have no twin. A Latin letter has one if Cyrillic or Greek does."""
        return {_script(c) for c in letters if c not in self.any and not (c in self.twins["CYRILLIC"] or c in self.twins["GREEK"]) and not unicodedata.combining(c)}

    def __call__(self, text: str) -> str:
        base = unicodedata.normalize("NFD", text)
        if self.any.isdisjoint(base):
            return text
        words = {w: unicodedata.normalize("NFD", w) for w in set(_WORD.findall(text))}
        sure = {w: self._sure(d) for w, d in words.items()}
        texts_own = {s for x in sure.values() if len(x) == 1 for s in x} - {"LATIN"}

        def one(m: re.Match) -> str:
            w = m.group()
            letters = words[w]
            if self.any.isdisjoint(letters):
                met = sure[w]
                if len(met) == 1 and (s := next(iter(met))) in self.twins:  # a foreign word with a Latin letter in it
                    return self._turn(w, lambda c: self.other.get((s, c), c))
                return w
            met = sure[w]
            if met == {"LATIN"}:
                return self._turn(w, lambda c: self.latin.get(c, c))
            if len(met) == 1 and (s := next(iter(met))) in self.twins:
                return self._turn(w, lambda c: c if _script(c) == s else self.other.get((s, self.latin.get(c, c)), c))
            if met:
                return w
            own = {_script(c) for c in letters if not unicodedata.combining(c)}
            if len(own) == 1 and own <= texts_own:
                return w
            return self._turn(w, lambda c: self.latin.get(c, c))

        return unicodedata.normalize("NFC", _WORD.sub(one, text))


def cleaner(swap: dict[int, str], unstable: str) -> Callable[[str | None], str | None]:
    """The clean form: all of the canonical form but the look-alike letters, which take the script of their word."""
    scripts = _Scripts()
    keep = {ord(c) for c in scripts.latin}
    mild = {n: to for n, to in swap.items() if n not in keep and not any(c in scripts.any for c in unicodedata.normalize("NFD", chr(n)))}
    form = canonicaliser(mild, unstable)

    def clean(text: str | None) -> str | None:
        t = form(text)
        return t if not t or t.isascii() else scripts(t)

    return clean


def canonical_texts(df: DataFrame, text: str, keep: list[str], with_text: bool = True) -> DataFrame:
    """`keep`, `form` (the clean text; left out if not asked for), form_hash (of the skeleton) and text_hash (128 bits as hex; null for null)."""

    swap, unstable = tables()  # made once, by the driver

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        skeleton, clean = canonicaliser(swap, unstable), cleaner(swap, unstable)
        digest = lambda t: None if t is None else xxhash.xxh3_128_hexdigest(t.encode("utf-8", "replace"))
        for b in batches:
            for part in (b.slice(i, 512) for i in range(0, b.num_rows, 512)):
                texts = part.column(part.num_columns - 1).to_pylist()
                forms = [skeleton(t) for t in texts]
                cols = [*part.columns[:-1], *([pa.array([clean(t) for t in texts], pa.string())] if with_text else [])]
                cols += [pa.array([digest(t) for t in x], pa.string()) for x in (forms, texts)]
                yield pa.record_batch(cols, names=[*keep, *(["form"] if with_text else []), "form_hash", "text_hash"])

    chosen = df.select(*keep, text)
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]]
    return chosen.mapInArrow(run, ", ".join([*schema, *(["form string"] if with_text else []), "form_hash string", "text_hash string"]))


def form_classes(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, form_hash, text_hash, representative) of rows whose form several texts have; the representative is the least key of the form.

    Forms that only one text has leave before any join, so copies of one text, however many, take no part.
    """
    blank = F.coalesce(F.col(text).rlike(r"\A[\s\x{A0}\x{2000}-\x{200F}\x{202F}\x{205F}\x{2060}-\x{2064}\x{3000}\x{FEFF}\x{AD}]*\z"), F.lit(True))
    hashed = materialize(canonical_texts(df.filter(~blank), text, [key], with_text=False))
    several = hashed.groupBy("form_hash").agg(F.min("text_hash").alias("lo"), F.max("text_hash").alias("hi"), F.min(key).alias("representative"))
    return hashed.join(several.filter("lo != hi").select("form_hash", "representative"), "form_hash")


def same_looking(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_a, doc_b), smaller first: rows whose texts differ but have one form, the classes expanded.

    A form's rows are dealt into SALTS parts on one side and repeated for each part on the other, so no form's pairs are one task's.
    """
    rows = materialize(form_classes(df, text, key))
    part = F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")
    a = rows.select("form_hash", part.alias("part"), F.col(key).alias("doc_a"), F.col("text_hash").alias("text_a"))
    b = rows.select("form_hash", F.explode(F.array(*map(F.lit, range(SALTS)))).alias("part"), F.col(key).alias("doc_b"), F.col("text_hash").alias("text_b"))
    return a.join(b, ["form_hash", "part"]).filter((F.col("text_a") != F.col("text_b")) & (F.col("doc_a") < F.col("doc_b"))).select("doc_a", "doc_b")
