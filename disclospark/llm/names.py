"""Variant spellings of people's names: noisy-channel attribution.

A register and the spellings that aren't in it, seldom or frequent, are the candidate canonical forms. A spelling is attached to the form with the
largest posterior: the logarithm of the form's frequency (prior) plus the likelihood that its parts were typed this way: a typo, an initial, a
cut-off first name, a nickname, a middle name spelled out, left out or wrong, a suffix left out. The channel starts from the weights below, which also say what is
possible at all; how likely each event is among those is then estimated from the spellings that one form alone explains. Candidates come from an equi-join on blocking
keys: last names with up to two letters left out on either side, as many as the likelihood allows, and for long ones pieces one of which two typos must spare. All
pairs the likelihood takes meet; never are all pairs formed. Only distinct spellings are scored. If the posterior of another form comes within OPEN_WITHIN, the spelling stays open.

Cases: null and blank spellings and those without a letter stay unattached; a last name alone, with one typo at most, is attached if only one form bears it or one is borne far more often;
repeated rows share one spelling; very long texts are parsed and compared like others; last names of one letter are none; ties in posterior leave a spelling open; empty input gives no rows.
"""

from __future__ import annotations

import math
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

# Titles, suffixes and nicknames of general English usage.
TITLES = {"hon", "honorable", "rep", "representative", "sen", "senator", "congressman", "congresswoman", "mr", "mrs", "ms", "mx", "dr"}
SUFFIXES = {"jr": "jr", "sr": "sr", "ii": "ii", "iii": "iii", "iv": "iv", "2nd": "ii", "3rd": "iii", "4th": "iv"}
NICKNAMES = {
    "alexander": "alex al sandy xander lex", "andrew": "andy drew", "anthony": "tony", "benjamin": "ben benny benji", "catherine": "cathy kate katie cat",
    "charles": "charlie chuck chas charley", "christopher": "chris kit topher", "daniel": "dan danny", "david": "dave davy", "deborah": "deb debbie debby debra",
    "edward": "ed eddie ted ned teddy", "elizabeth": "liz beth betty eliza lizzie libby betsy", "francis": "frank frankie fran", "gregory": "greg gregg",
    "harold": "harry hal", "ignacio": "nacho iggy", "ines": "inez", "james": "jim jimmy jamie", "john": "jack johnny", "joseph": "joe joey jo",
    "katherine": "kate kathy katie kat kay kitty", "lawrence": "larry lars laurie", "margaret": "maggie meg peggy marge margie greta", "mary": "molly polly",
    "michael": "mike mick mickey", "nathaniel": "nat nate nathan", "nicholas": "nick nicky", "oliver": "ollie oli", "patricia": "pat patty trish tricia patti",
    "patrick": "pat paddy", "peter": "pete", "quentin": "quent quin", "rebecca": "becky becca reba", "richard": "rick dick rich ricky richie",
    "robert": "bob bobby rob robbie bert", "ronald": "ron ronnie", "samuel": "sam sammy", "stephen": "steve", "steven": "steve", "susan": "sue susie suzy",
    "theodore": "theo ted teddy", "thomas": "tom tommy", "timothy": "tim", "ursula": "ursie uschi ulla", "victoria": "vicky tori vicki vic",
    "walter": "walt", "wendell": "wen dell", "william": "bill billy will willy liam", "yolanda": "yoli yola", "zachary": "zach zack zak",
    "abigail": "abby gail", "abraham": "abe", "albert": "al bert bertie", "alfred": "al alf fred freddie", "amanda": "mandy", "angela": "angie", "arnold": "arnie", "arthur": "art artie",
    "barbara": "barb babs barbie", "bernard": "bernie", "beverly": "bev", "bradley": "brad", "calvin": "cal", "caroline": "carrie carol", "cassandra": "cass cassie sandra",
    "christina": "chris tina chrissy", "christine": "chris chrissy tina", "clifford": "cliff", "clinton": "clint", "constance": "connie", "cynthia": "cindy", "dolores": "lola", "donald": "don donnie",
    "dorothy": "dot dottie dolly", "douglas": "doug", "eleanor": "ellie nell nora", "eugene": "gene", "evelyn": "evie", "frances": "fran frannie", "franklin": "frank", "frederick": "fred freddie rick",
    "gabriel": "gabe", "gerald": "gerry jerry", "gertrude": "trudy gert", "gilbert": "gil bert", "gordon": "gordy", "gwendolyn": "gwen", "helen": "nell nellie", "henry": "hank harry hal",
    "herbert": "herb bert", "howard": "howie", "irving": "irv", "isabel": "izzy bella", "jacob": "jake", "jacqueline": "jackie", "janet": "jan", "jeffrey": "jeff", "jennifer": "jen jenny", "jeremy": "jerry",
    "jessica": "jess jessie", "jonathan": "jon jonny nathan", "joshua": "josh", "judith": "judy", "kenneth": "ken kenny", "kimberly": "kim", "leonard": "len lenny leo", "lewis": "lou lew", "louis": "lou louie",
    "marjorie": "marge margie", "martha": "marty patty", "martin": "marty", "matthew": "matt", "maximilian": "max", "melissa": "missy mel", "mitchell": "mitch", "nancy": "nan", "norman": "norm",
    "pamela": "pam", "penelope": "penny", "philip": "phil pip", "phillip": "phil", "priscilla": "prissy cilla", "raymond": "ray", "roberta": "bobbie robbie", "roderick": "rod rick", "rodney": "rod", "roger": "rodge",
    "rosemary": "rose rosie", "rudolph": "rudy", "russell": "russ", "sandra": "sandy", "sharon": "shari", "sidney": "sid", "stanley": "stan", "stuart": "stu", "suzanne": "sue suzy", "teresa": "terry tess",
    "terrence": "terry", "valerie": "val", "vincent": "vince vinny", "virginia": "ginny", "vivian": "viv", "wallace": "wally", "winifred": "winnie", "winston": "win",
}
SHORT_FORMS = {k: frozenset(v.split()) for k, v in NICKNAMES.items()}

# What exports write for a part that is missing.
MISSING = r"\b(?:None|NULL|null|NaN|nan|N/A)\b"

FLOOR = -9.0
#: Two people within these log odds (twenty to one) are not told apart; nor two likelihoods of spellings without a register.
OPEN_WITHIN = 3.0
EQUAL_WITHIN = 0.25
DOUBTFUL = -4.5
#: Forms, and their blocking keys (some hundred bytes each), are broadcast up to this many; more are joined by a shuffle.
BROADCAST_FORMS = 5_000
_NICK = re.compile(r"[\"“”(]\s*[\w.\- ]+\s*[\"“”)]")
# What may befall a name on its way to paper, with the starting weights; impossible is what falls below FLOOR.
EVENTS = {
    "last typo": -2.5, "last two typos": -5.5, "first initial": -2.0, "first nickname": -1.0, "first spelled out": -2.5, "first cut off": -1.5, "first typo": -2.5, "first two typos": -5.0,
    "nickname typo": -4.0, "no first": -3.0, "middle agrees": -0.2, "middle differs": -12.0, "middle added": -4.0, "middle left out": -1.0, "suffix left out": -1.5, "suffix added": -6.0, "suffix differs": -12.0,
}
EVENT_NO = {e: i for i, e in enumerate(EVENTS)}
_WORD = re.compile(r"[^\W\d_][\w’'‘`´-]*\.?|\d(?:nd|rd|th)\b")
_GLUED = re.compile(r"(?<=\w)\.(?=\w)")


def fold(s: str) -> str:
    """Lower-case letters without accents; all else goes."""
    return "".join(c for c in unicodedata.normalize("NFKD", s).casefold() if c.isalpha())


def _compact_last(tokens: list[str]) -> str:
    s = "".join(map(fold, tokens))
    return "mc" + s[3:] if s.startswith("mac") and len(s) > 5 else s


def _words(s: str) -> list[str]:
    return [w.rstrip(".") for w in _WORD.findall(_GLUED.sub(". ", s))]


def _split_off(words: list[str]) -> tuple[list[str], str]:
    suffix = ""
    out = []
    for w in words:
        key = w.lower()
        if key in SUFFIXES and (out or len(words) > 1):
            suffix = SUFFIXES[key]
        else:
            out.append(w)
    return out, suffix


def _untitled(words: list[str]) -> list[str]:
    while len(words) > 1:
        head = words[0].lower()
        if head in TITLES or head == "the" and words[1].lower() in TITLES:
            words = words[1:]
        else:
            break
    return words if words and words[0].lower() not in TITLES or len(words) > 1 else []


def parse_name(text: str) -> list[tuple[list[str], str, str]]:
    """Readings of a spelling: (given names, compact last name, suffix)."""
    s = unicodedata.normalize("NFKC", text)
    s = _NICK.sub(" ", s)
    parts = [p for p in map(_words, s.split(",")) if p]
    if not parts:
        return []
    suffix, kept = "", []
    for i, p in enumerate(parts):
        rest, found = _split_off(p) if i == 0 else ([w for w in p if w.lower() not in SUFFIXES], next((SUFFIXES[w.lower()] for w in p if w.lower() in SUFFIXES), ""))
        suffix = suffix or found
        if rest:
            kept.append(rest)
    if len(kept) > 1:
        given = [g for g in map(fold, _untitled([w for p in kept[1:] for w in p])) if g]
        # a title before a last name may also be a part of it, mistyped
        lasts = {_compact_last(kept[0]), _compact_last(_untitled(kept[0]))}
        return [(given, last, suffix) for last in sorted(lasts) if last]
    words = _untitled(kept[0]) if kept else []
    if len(words) < 2:
        return [([], _compact_last(words), suffix)] if words else []
    # a lone letter starts a last name only as the O of O'Name
    sizes = [k for k in range(1, min(4, len(words) - 1) + 1) if k == 1 or not any(len(w) == 1 and w not in "oO" for w in words[-k:-1])]
    return [([fold(g) for g in words[:-k] if fold(g)], _compact_last(words[-k:]), suffix) for k in sizes] + [([], _compact_last(words), suffix)]


def edits(a: str, b: str, most: int = 3) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours; most + 1 if there are more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, now[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            now[j] = d
        if min(now) > most:
            return most + 1
        before, last = last, now
    return min(last[-1], most + 1)


def _first_event(typed: str, meant: str) -> str | None:
    """What befell a first name; '' for nothing, null if one isn't the other."""
    if typed == meant:
        return ""
    if len(typed) == 1:
        return "first initial" if meant.startswith(typed) else None
    short = SHORT_FORMS.get(meant, frozenset())
    if typed in short:
        return "first nickname"
    if len(meant) == 1:
        return "first spelled out" if typed.startswith(meant) else None
    if meant.startswith(typed):
        return "first cut off"
    if len(typed) >= 3:
        d = edits(typed, meant, 2)
        if d == 1 and len(meant) >= 4:
            return "first typo"
        if d == 2 and len(meant) >= 6:
            return "first two typos"
        if len(typed) >= 4 and any(edits(typed, s, 1) == 1 for s in short if len(s) >= 4):
            return "nickname typo"
    return None


def events(reading: tuple[list[str], str, str], meant: tuple[list[str], str, str]) -> list[str] | None:
    """What befell a name that it reads so; null if that can't be."""
    given, last, suffix = reading
    c_given, c_last, c_suffix = meant
    if not c_given or len(last) < 2 or len(c_last) < 2:
        return None
    out = []
    if last != c_last:
        d = edits(last, c_last, 2)
        # two letters are few, and a last name alone says little
        if d > 2 or d == 2 and (len(c_last) < 8 or not given) or d == 1 and len(c_last) < 4:
            return None
        out.append("last typo" if d == 1 else "last two typos")
    first = _first_event(given[0], c_given[0]) if given else "no first"
    if first is None:
        return None
    out += [first] if first else []
    middle, c_middle = given[1:], c_given[1:]
    if middle and c_middle:
        a, b = middle[0], c_middle[0]
        same = a == b or (a[0] == b[0] and min(len(a), len(b)) == 1) or (min(len(a), len(b)) > 3 and edits(a, b, 1) == 1)
        out.append("middle agrees" if same else "middle differs")
    elif middle:
        out += ["middle added"] * len(middle)
    elif c_middle:
        out.append("middle left out")
    if suffix != c_suffix:
        out.append("suffix left out" if not suffix else "suffix added" if not c_suffix else "suffix differs")
    return out


def likelihood(reading: tuple[list[str], str, str], meant: tuple[list[str], str, str]) -> float | None:
    met = events(reading, meant)
    return None if met is None else sum(EVENTS[e] for e in met)


#: Up to SHORT_NAME letters, keys are the name with letters left out; from LONG_NAME on, pieces. Names between have both, so any two within two letters of length share a kind.
SHORT_NAME, LONG_NAME, PIECES = 26, 23, 5


def _cuts(n: int) -> list[int]:
    return [i * n // PIECES for i in range(PIECES + 1)]


def _keys_of(last: str, deep: bool, probe: bool) -> set[str]:
    """Two names that lie within two typos (`deep`) or one share a key, of `probe` kind on one side and not on the other.

    A typo, a swap of neighbours too, is undone by leaving out a letter on either side; of five pieces it spoils two at most.
    """
    n = len(last)
    if n < 2:
        return set()
    out = {last}
    if 3 <= n <= SHORT_NAME:
        once = {last[:i] + last[i + 1 :] for i in range(n)}
        out |= once
        if deep and n >= 6:
            out |= {s[:i] + s[i + 1 :] for s in once for i in range(n - 1)}
    if n >= LONG_NAME:
        for m in range(n - 2, n + 3) if probe else (n,):
            at = _cuts(m)
            for i in range(PIECES):
                for d in range(-2, 3) if probe else (0,):
                    start, end = at[i] + d, at[i + 1] + d
                    if 0 <= start and end <= n:
                        out.add(f"{m}/{i}/{last[start:end]}")
    return out


def _name_keys(text: str, probe: bool) -> list[str]:
    return sorted({k for given, last, _ in parse_name(text) for k in _keys_of(last, bool(given), probe)})


@F.pandas_udf(T.ArrayType(T.StringType()))
def typed_keys(text: pd.Series) -> pd.Series:
    return text.map(lambda t: _name_keys(t or "", True))


@F.pandas_udf(T.ArrayType(T.StringType()))
def form_keys(text: pd.Series) -> pd.Series:
    return text.map(lambda t: _name_keys(t or "", False))


def _best(typed: pd.Series, meant: pd.Series) -> list[tuple[float, list[str]] | None]:
    """Of each pair the likeliest reading's score and events."""
    parsed: dict[str, list] = {}

    def read(t: str) -> list:
        if t not in parsed:
            parsed[t] = parse_name(t)
        return parsed[t]

    def best(t: str, m: str) -> tuple[float, list[str]] | None:
        met = [e for r in read(t) for c in read(m) if (e := events(r, c)) is not None]
        return max(((sum(EVENTS[x] for x in e), e) for e in met), key=lambda x: x[0], default=None)

    return [best(t, m) for t, m in zip(typed, meant, strict=True)]


@F.pandas_udf(T.DoubleType())
def spelling_likelihood(typed: pd.Series, meant: pd.Series) -> pd.Series:
    """Log-likelihood of the best reading by the starting weights. Null if none is possible."""
    return pd.Series([b and b[0] for b in _best(typed, meant)], dtype="float64")


@F.pandas_udf(T.StructType([T.StructField("likely", T.DoubleType()), T.StructField("met", T.ArrayType(T.IntegerType()))]))
def spelling_events(typed: pd.Series, meant: pd.Series) -> pd.DataFrame:
    """The same with the numbers of the events."""
    found = _best(typed, meant)
    return pd.DataFrame({"likely": pd.Series([b and b[0] for b in found], dtype="float64"), "met": [b and [EVENT_NO[e] for e in b[1]] for b in found]})


def form_text(first: Column, last: Column, suffix: Column) -> Column:
    """`last, first, suffix`, which reads one way only. A last name that holds a comma already is the whole name."""
    clean = F.regexp_replace(F.coalesce(first, F.lit("")), MISSING, "")
    given = F.when(F.coalesce(last, F.lit("")).contains(","), "").otherwise(clean)
    parts = F.array(F.coalesce(last, F.lit("")), given, F.coalesce(suffix, F.lit("")))
    return F.array_join(F.filter(parts, lambda p: F.trim(p) != ""), ", ")


def candidate_pairs(typed: DataFrame, meant: DataFrame) -> DataFrame:
    """Distinct pairs (spelling, form_id) that share a blocking key. `typed`: spelling; `meant`: form_id, form."""
    keys = meant.select("form_id", F.explode(form_keys("form")).alias("k"))
    few = meant.count() <= BROADCAST_FORMS
    return typed.select("spelling", F.explode(typed_keys("spelling")).alias("k")).join(F.broadcast(keys) if few else keys, "k").select("spelling", "form_id").distinct()


def estimate_channel(scored: DataFrame, strength: float = 20.0) -> list[float]:
    """Log-probability of each event, from the spellings that have one possible form, by how often they occur; `strength` of the starting weights is mixed in."""
    alone = scored.groupBy("spelling").agg(F.count(F.lit(1)).alias("n"), F.first("met").alias("met"), F.first("times").alias("times")).filter("n = 1")
    met = [F.sum(F.when(F.array_contains("met", i), F.col("times")).otherwise(0)).alias(f"e{i}") for i in range(len(EVENTS))]
    row = alone.agg(F.sum("times").alias("all"), *met).first()  # one number an event
    total = float(row["all"] or 0) + strength
    start = [math.exp(w) for w in EVENTS.values()]
    return [math.log((float(row[f"e{i}"] or 0) + strength * start[i]) / total) for i in range(len(EVENTS))]


def attach(spellings: DataFrame, forms: DataFrame) -> DataFrame:
    """(spelling, form_id, posterior): the one form of largest posterior. `spellings`: spelling, frequency; `forms`: form_id, form (text), frequency."""
    pairs = candidate_pairs(spellings, forms)
    scored = (
        pairs.join(if_few(forms.withColumnRenamed("frequency", "prior")), "form_id")
        .withColumn("s", spelling_events("spelling", "form")).filter(F.col("s.likely") >= FLOOR)
        .join(spellings.select("spelling", F.col("frequency").alias("times")), "spelling")
    )
    scored = materialize(scored.select("spelling", "form_id", "prior", "times", "s.met"))
    channel = F.array(*[F.lit(w) for w in estimate_channel(scored)])
    likely = F.aggregate("met", F.lit(0.0), lambda a, e: a + F.get(channel, e))
    # best and runner-up by aggregates: no group is sorted, and both combine map-side
    judged = scored.withColumn("posterior", F.log(F.col("prior") + F.lit(1.0)) + likely)
    best = judged.groupBy("spelling").agg(F.max_by("form_id", F.struct("posterior", "form_id")).alias("own"), F.max("posterior").alias("top"))
    rivals = judged.join(best, "spelling").filter((F.col("form_id") != F.col("own")) & (F.col("posterior") > F.col("top") - OPEN_WITHIN)).select("spelling").distinct()
    return best.join(rivals, "spelling", "left_anti").select("spelling", F.col("own").alias("form_id"), F.col("top").alias("posterior"))


def if_few(forms: DataFrame) -> DataFrame:
    return F.broadcast(forms) if forms.count() <= BROADCAST_FORMS else forms


def member_spelling(first: str = "first", last: str = "last", suffix: str = "suffix") -> Column:
    """The name of a row whose parts stand in fields, as one spelling; a prefix says nothing about who is meant."""
    return form_text(F.col(first), F.col(last), F.col(suffix))


def has_letter(c: str) -> Column:
    return F.coalesce(F.col(c).rlike(r"\p{L}"), F.lit(False))


def _ends(links: DataFrame) -> DataFrame:
    """(spelling, end): the links spelling -> form_id followed to where they end, twice as far each time. Around a circle the least name counts."""
    walk, steps = links.select("spelling", F.col("form_id").alias("at"), F.col("spelling").alias("least")), 1
    while True:
        ahead = walk.select(F.col("spelling").alias("at"), F.col("at").alias("then"), F.col("least").alias("least_then"))
        walk = materialize(walk.join(ahead, "at", "left"))
        left = walk.agg(F.count("then").alias("moving"), F.count(F.lit(1)).alias("all")).first()
        if not left["moving"] or steps > left["all"]:
            return walk.select("spelling", F.coalesce("least_then", "at").alias("end"))
        walk = walk.select("spelling", F.coalesce("then", "at").alias("at"), F.least("least", "least_then").alias("least"))
        steps *= 2


def link_people(spellings: DataFrame) -> DataFrame:
    """(spelling, person) of spellings that stand for the same person as another one. `spellings`: spelling, frequency (distinct).

    Of two spellings that may be the same name, the one that is likelier typed for the other hangs on it, or the rarer one if both are as likely;
    how often either occurs is only compared, so more rows of the same kind link the same spellings. Each hangs on its likeliest form, which may itself
    hang on another; the last one is the person. Forms of two persons under which a spelling is equally likely leave it open. A link less likely
    than DOUBTFUL counts only if the form is spelled so at least twice as often.
    """
    pairs = candidate_pairs(spellings, spellings.select(F.col("spelling").alias("form_id"), F.col("spelling").alias("form")))
    pairs = pairs.filter("spelling < form_id").withColumnRenamed("form_id", "other")
    scored = (
        pairs.join(spellings, "spelling")
        .join(spellings.select(F.col("spelling").alias("other"), F.col("frequency").alias("other_frequency")), "other")
        .withColumn("there", F.coalesce(spelling_likelihood("spelling", "other"), F.lit(FLOOR - 1)))
        .withColumn("back", F.coalesce(spelling_likelihood("other", "spelling"), F.lit(FLOOR - 1)))
        .withColumn("up", (F.col("there") > F.col("back")) | (F.col("there") == F.col("back")) & (F.col("other_frequency") > F.col("frequency")))
    )
    mine, form = F.struct("spelling", "frequency"), F.struct(F.col("other").alias("spelling"), F.col("other_frequency").alias("frequency"))
    scored = materialize(
        scored.select(F.when(F.col("up"), mine).otherwise(form).alias("x"), F.when(F.col("up"), form).otherwise(mine).alias("f"), F.greatest("there", "back").alias("likely"))
        .filter((F.col("likely") >= FLOOR) & ((F.col("likely") >= DOUBTFUL) | (F.col("f.frequency") >= 2 * F.col("x.frequency"))))
        .select(F.col("x.spelling").alias("spelling"), F.col("f.spelling").alias("form_id"), "likely", (F.col("likely") + 0.05 * F.log(F.col("f.frequency") + F.lit(1.0))).alias("posterior"))
    )
    if scored.isEmpty():
        return scored.select("spelling", F.col("form_id").alias("person"))
    best = scored.groupBy("spelling").agg(F.max_by(F.struct("form_id", "likely"), F.struct("posterior", "form_id")).alias("b"))
    links = materialize(best.select("spelling", "b.form_id", F.col("b.likely").alias("own_likely")))
    while True:
        ends = _ends(links)
        near = scored.join(links.select("spelling", F.col("form_id").alias("own"), "own_likely"), "spelling").filter(
            (F.col("form_id") != F.col("own")) & (F.col("likely") > F.col("own_likely") - EQUAL_WITHIN)
        )
        theirs = ends.select(F.col("spelling").alias("form_id"), F.col("end").alias("their_end"))
        rivals = near.join(ends, "spelling").join(theirs, "form_id", "left").filter(F.coalesce("their_end", "form_id") != F.col("end"))
        open_ones = materialize(rivals.select("spelling").distinct())
        if open_ones.isEmpty():
            return ends.select("spelling", F.col("end").alias("person"))
        links = materialize(links.join(open_ones, "spelling", "left_anti"))


def attribute(spellings: DataFrame, register: DataFrame) -> DataFrame:
    """(spelling, filer_id, person) of every spelling with a letter.

    `spellings`: spelling, frequency (distinct). `register`: filer_id, full_name, first, last, suffix. filer_id is null where no
    filer of the register is meant; `person` names the form a spelling stands for: the filer, or the spelling outside the register that it
    most likely stands for, or else the spelling itself.
    """
    known = register.select(
        F.col("filer_id"), F.col("full_name").alias("spelling"), form_text(F.col("first"), F.col("last"), F.col("suffix")).alias("form")
    )
    usable = spellings.filter(has_letter("spelling"))
    exact = known.groupBy("spelling").agg(F.min("filer_id").alias("exact_id"))
    looked = usable.join(exact, "spelling", "left")
    prior = known.join(usable, "spelling", "left").groupBy("filer_id", "form").agg(F.max(F.coalesce("frequency", F.lit(0))).alias("frequency"))
    forms = prior.select(F.col("filer_id").alias("form_id"), "form", "frequency")
    typed = looked.filter("exact_id is null")
    attached = attach(typed, forms).select("spelling", F.col("form_id").alias("near_id"))
    settled = materialize(
        looked.join(attached, "spelling", "left").select("spelling", "frequency", F.coalesce("exact_id", "near_id").alias("filer_id"))
    )
    others = link_people(settled.filter("filer_id is null").select("spelling", "frequency"))
    person = F.coalesce(F.concat(F.lit("#"), F.col("filer_id").cast("string")), F.col("person"), F.col("spelling"))
    return settled.join(others, "spelling", "left").select("spelling", "filer_id", person.alias("person"))
