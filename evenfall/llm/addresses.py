"""The same postal address written differently.

Each address text is parsed into components (house number, street, street type, direction, town, state, postcode, country) with
locale dictionaries; venue names, units, floors and entrances are dropped, the order of the parts doesn't matter. Two records
denote the same location if their components agree under explicit rules for missing ones. Candidates come from hierarchical
keys that always hold the house number: with either end of the street's name and the state as far as it is known, or with postcode or town. So one typing error in the
street can't hide a pair, and no key is as wide as a town. A gazetteer learnt from all complete addresses (postcode to town and
state) fills in the town where an address has only a postcode.

Parsing and comparing run in Arrow functions; grouping, keys, joins and the gazetteer are DataFrame algebra. Each distinct
address text is parsed and compared once, whatever number of rows repeats it.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenfall.runtime import cut, keyed_join

# Street types by locale, canonical code and spellings.
ENGLISH_TYPES = {
    "st": "street str st", "ave": "avenue aven ave av", "blvd": "boulevard boul blvd bvd", "dr": "drive drv dr", "ln": "lane ln", "rd": "road rd", "ct": "court crt ct",
    "hwy": "highway hway hwy", "pl": "place pl", "sq": "square sq", "ter": "terrace terr ter", "way": "way wy", "pkwy": "parkway pkwy pky", "cir": "circle circ cir", "trl": "trail trl", "aly": "alley aly", "cres": "crescent cres", "pde": "parade pde", "cl": "close", "row": "row", "plz": "plaza", "loop": "loop", "pike": "pike", "expy": "expressway expy",
}
SPANISH_TYPES = {"calle": "calle cl c/ c", "avenida": "avenida avda avd avda av", "paseo": "paseo pso pº p.º p°", "plaza": "plaza plza pza pl", "camino": "camino cno", "carretera": "carretera ctra", "ronda": "ronda rda", "travesia": "travesia trv", "glorieta": "glorieta gta"}
GERMAN_TYPES = {"strasse": "strasse str", "platz": "platz pl", "weg": "weg", "gasse": "gasse g", "allee": "allee", "ufer": "ufer", "ring": "ring", "damm": "damm", "markt": "markt"}
DIRECTIONS = {"n": "north n", "s": "south s", "e": "east e", "w": "west w", "ne": "northeast ne", "nw": "northwest nw", "se": "southeast se", "sw": "southwest sw"}
# States and provinces by code, so a name is read as its code.
STATES = {
    "al": "alabama", "ak": "alaska", "az": "arizona", "ar": "arkansas", "ca": "california", "co": "colorado", "ct": "connecticut", "de": "delaware", "fl": "florida", "ga": "georgia", "hi": "hawaii", "id": "idaho", "il": "illinois", "in": "indiana",
    "ia": "iowa", "ks": "kansas", "ky": "kentucky", "la": "louisiana", "me": "maine", "md": "maryland", "ma": "massachusetts", "mi": "michigan", "mn": "minnesota", "ms": "mississippi", "mo": "missouri", "mt": "montana", "ne": "nebraska", "nv": "nevada",
    "nh": "new hampshire", "nj": "new jersey", "nm": "new mexico", "ny": "new york", "nc": "north carolina", "nd": "north dakota", "oh": "ohio", "ok": "oklahoma", "or": "oregon", "pa": "pennsylvania", "ri": "rhode island", "sc": "south carolina", "sd": "south dakota",
    "tn": "tennessee", "tx": "texas", "ut": "utah", "vt": "vermont", "va": "virginia", "wa": "washington", "wv": "west virginia", "wi": "wisconsin", "wy": "wyoming", "dc": "district of columbia",
    "nsw": "new south wales", "qld": "queensland", "sa": "south australia", "tas": "tasmania", "vic": "victoria", "nt": "northern territory", "act": "australian capital territory",
    "an": "andalucia", "cl": "castilla y leon", "cm": "castilla la mancha", "ct_es": "cataluna", "vc": "comunidad valenciana", "md_es": "comunidad de madrid", "ga_es": "galicia", "pv": "pais vasco", "ar_es": "aragon", "ex": "extremadura", "as": "asturias", "ib": "islas baleares", "cn": "canarias", "cb": "cantabria", "ri_es": "la rioja", "na": "navarra", "mc": "murcia",
    "bw": "baden wurttemberg", "by": "bayern", "be": "berlin", "bb": "brandenburg", "hb": "bremen", "hh": "hamburg", "he": "hessen", "mv": "mecklenburg vorpommern", "ni": "niedersachsen", "nw": "nordrhein westfalen", "rp": "rheinland pfalz", "sl": "saarland", "sn": "sachsen", "st_de": "sachsen anhalt", "sh": "schleswig holstein", "th": "thuringen",
    "no": "northern division", "we": "western division", "ce": "central division", "ea": "eastern division",
}
STATES_SHORT = {"northern": "no", "western": "we", "central": "ce", "eastern": "ea"}
# Last words of venue names.
VENUE_WORDS = frozenset(
    "hall club cafe bar pub tavern inn theatre theater cinema museum gallery playhouse ballroom lounge kitchen arms house collection commons taproom brewery library church center centre rooms room stage basement alehouse restaurant bistro hotel school studio studios annex hub space factory warehouse arena stadium auditorium pavilion venue saloon winery cellar academy institute lodge works kino teatro sala museo galeria bodega taberna theater museum galerie kneipe saal".split()
)
COUNTRIES = ("united states of america", "united states", "u s a", "usa", "us", "u s", "estados unidos", "espana", "spain", "es", "deutschland", "germany", "de", "australia", "au", "aus", "fiji", "fj", "united kingdom", "uk", "france")



def _inverse(types: dict[str, str]) -> dict[str, str]:
    return {w: code for code, words in types.items() for w in words.split()}


_EN, _ES, _DE, _DIR = map(_inverse, (ENGLISH_TYPES, SPANISH_TYPES, GERMAN_TYPES, DIRECTIONS))
_STATE = STATES_SHORT | {name: code.partition("_")[0] for code, name in STATES.items()} | {code: code for code in STATES if "_" not in code}
_NOISE = re.compile(
    r"\([^()]*\)|\bc/o\b|\b(?:suite|ste|unit|apt|apartment|room|rm|floor|fl|flr|piso|planta|stock|og|eg|puerta|hinterhaus|bldg|building|door|gate|entrance)\b\.?\s*#?\s*\d{1,4}[a-z]?\b(?!\d)|#\s*\d+[a-z]?\b"
    r"|\b(?:\d+(?:st|nd|rd|th)|ground|first|second|third|top|upper|lower)\s+(?:floor|fl|level)\b\.?|\b(?:side|rear|back|front|stage|main|north|south|east|west|courtyard)\s+(?:door|entrance|gate)\b|\b\d+\.\s*(?:stock|og)\b|\b(?:erdgeschoss|hinterhof|bajo|rear of building|upstairs|downstairs)\b"
)
_NUMBER_SIGN = re.compile(r"\b(?:n\s?[º°o]\.?|num\.?|numero|nr\.?|no\.)\s*(?=\d)|(?<![\w])[º°]\s*(?=\d)")
_GERMAN_STREET = re.compile(r"^(.{4,}?)(strasse|str|platz|pl|weg|gasse|g|allee|ufer|ring|damm)$")


def fold(text: str) -> str:
    """Lower case without accents; ß is ss, and umlauts are their plain vowels however they are written out later."""
    t = unicodedata.normalize("NFKD", text.lower().replace("ß", "ss"))
    return "".join(c for c in t if not unicodedata.combining(c))


def _words(segment: str) -> list[str]:
    return re.findall(r"[a-z0-9]+(?:-\d+)?", segment)


@lru_cache(100_000)
def parse(text: str | None) -> tuple | None:
    """(number, street, type, direction, town, state, postcode), '' for what is missing; None if number or street are missing."""
    if not text:
        return None
    t = unicodedata.normalize("NFKC", text.replace("º", "°")).replace("°", "º")
    t = fold(t.replace("º", "\x01")).replace("\x01", "º")
    t = re.sub(r"[ \t\r\f\v ]+", " ", t)
    t = re.sub(r"\bp\.?\s?º(?=\s*[a-z])", "paseo", t)
    t = re.sub(r"\bc/\s*", "calle ", t)
    marked = bool(_NUMBER_SIGN.search(t))
    t = _NUMBER_SIGN.sub(" ", t)
    t = _NOISE.sub(" ", t)
    t = re.sub(r"\b([a-z])\.\s?(?=[a-z]\.)", r"\1", t).replace(".", " ")
    segments = [s for s in (x.strip() for x in re.split(r"[,;|\n@]|\s[-–—]\s", t)) if s]
    number = street = kind = direction = town = state = postcode = ""
    rest: list[list[str]] = []
    # postcodes first: five digits, or four that stand behind a state or alone
    parts: list[list[str]] = []
    for s in segments:
        w = _words(s)
        if w:
            parts.append(w)
    flat = [x for w in parts for x in w]
    digits = [x for x in flat if re.fullmatch(r"\d+(?:-\d+)?", x)]
    five = [x for x in digits if re.fullmatch(r"\d{5}(?:-\d{4})?", x)]
    if five:
        postcode = five[-1]
    elif len(digits) > 1:
        for w in parts:
            for i, x in enumerate(w):
                if re.fullmatch(r"\d{4}", x) and (len(w) == 1 or (i > 0 and (w[i - 1] in _STATE or " ".join(w[max(0, i - 2) : i]) in _STATE) and w[i - 1] not in _DIR) or (i == len(w) - 1 and i > 1 and any(re.fullmatch(r"\d+", y) for y in w[:i]))):
                    postcode = x
    if postcode:
        left = postcode
        for w in parts:
            if left in w:
                w.remove(left)
                break
        postcode = postcode.partition("-")[0]
    # the part with the house number holds the street
    for w in parts:
        if street:
            rest.append(w)
            continue
        at = next((i for i, x in enumerate(w) if re.fullmatch(r"\d{1,5}[a-z]?", x)), None)
        if at is None:
            rest.append(w)
            continue
        number = w[at]
        before, after = w[:at], w[at + 1 :]
        if not before and rest and rest[-1] and (rest[-1][0] in _ES or (marked and not any(x.isdigit() for x in rest[-1]))):
            # "Calle Jarra Redonda, nº 1000 75117 Puerto Aroma"
            before = rest.pop()
            if after:
                rest.append(after)
            after = []
        if not before and not after:  # a number alone: the street is the part before (or after)
            if rest and len(parts) > 1:
                before = rest.pop()
            else:
                number = ""
                continue
        found = _street(before, after)
        if not found:
            number = ""
            rest.append(before + after)
            continue
        street, kind, direction, tail = found
        if tail:
            rest.append(tail)
    if not street:
        return None
    # what is left: country, state, town; a part that is none of them is a venue's name
    towns: list[tuple[str, bool]] = []
    for w in rest:
        w = list(w)
        n0 = len(w)
        while w and (c := _ends(w, COUNTRIES)) and not any(len(w) >= k and " ".join(w[-k:]) in _STATE for k in (2, 3, 4)):
            w = w[:-c]
        for n in (3, 2, 1):
            if len(w) >= n and (code := _STATE.get(" ".join(w[-n:]))):
                if not state:
                    state = code
                    w = w[:-n]
                break
        if w and w[-1] not in VENUE_WORDS and "annex" not in w and not any(x.isdigit() for x in w):
            towns.append((" ".join(w), len(w) < n0))
    if towns:
        marked = [x for x, m in towns if m]
        town = marked[-1] if marked else towns[-1][0]
        candidates = [x for x, _ in towns]
    else:
        candidates = []
    return (number.lstrip("0") or number, street, kind, direction, "|".join(dict.fromkeys([town, *candidates])) if town else "", state, postcode)


def _ends(words: list[str], phrases: tuple[str, ...]) -> int:
    for n in (4, 3, 2, 1):
        if len(words) >= n and " ".join(words[-n:]) in phrases:
            return n
    return 0


def _street(before: list[str], after: list[str]) -> tuple[str, str, str, list[str]] | None:
    """(name, type, direction, words left over) from the words before and behind the house number in its part."""
    # Spanish: type, name, number; also number, type, name
    for side, other in ((before, after), (after, before)):
        for i, x in enumerate(side):
            if x in _ES and x not in ("c", "cl", "pl", "av") or (x in ("c", "cl", "pl", "av") and i < len(side) - 1 and (side is before or i == 0)):
                if side is after and i > 0:
                    continue  # an English type behind its name
                name = side[i + 1 :]
                if side is after and len(name) > 2:
                    name, other = name[:2], name[2:]
                else:
                    other = list(other) if side is before else []
                if name:
                    return " ".join(name), _ES[x], "", other
    # German: a compound with its type, number behind or before
    for side, other in ((before, after), (after, before)):
        if not side:
            continue
        for i, x in enumerate(side):
            if x in ("strasse", "weg", "gasse", "platz", "allee") and i > 0 or (x in ("str", "g", "pl") and i > 0 and side is before and not after[:0] and i == len(side) - 1):
                return side[i - 1], _DE[x], "", (list(after) if side is before else list(side[i + 1 :]))
        x = side[-1] if side is before else side[0]
        m = _GERMAN_STREET.match(x)
        if m and (side is before or m[2] in ("strasse", "platz", "weg", "gasse", "allee")):
            return m[1], _DE[m[2]], "", (list(after) if side is before else list(side[1:]))
    # English: number, direction, name, type, direction
    if after:
        w = list(after)
        direction = ""
        if len(w) > 1 and w[0] in _DIR and w[1] not in _EN:
            direction, w = _DIR[w[0]], w[1:]
        kind, k = "", None
        for i in range(1, min(len(w), 4)):
            if w[i] in _EN and not (w[i] in _STATE and w[i] in ("ct", "al") and i == len(w) - 1 and i > 2):
                k = i
                break
        if k is not None:
            name, kind, tail = w[:k], _EN[w[k]], w[k + 1 :]
        else:
            name, tail = w[:1], w[1:]
        if not direction and tail and tail[0] in _DIR:
            if len(tail[0]) <= 2 or " ".join(tail[1:]) in _STATE or len(tail) == 1:
                direction, tail = _DIR[tail[0]], tail[1:]
            elif kind:
                direction = "?" + _DIR[tail[0]]  # "Street East Maccabee": of the street or of the town
        return " ".join(name), kind, direction, tail
    if before and len(before) <= 3:  # name, number without a type
        return " ".join(before), "", "", []
    return None


@lru_cache(200_000)
def edits(a: str, b: str, most: int) -> int:
    """Edits between two words (a swap of neighbours is one), most + 1 if more than most."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(one[j] + 1, row[-1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, two[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return min(one[-1], most + 1)


def _close(a: str, b: str) -> bool:
    """Words that differ by typing errors only: one edit up to five letters, two beyond."""
    most = 1 if min(len(a), len(b)) <= 5 else 2
    return edits(a, b, most) <= most


@lru_cache(200_000)
def same_words(a: str, b: str) -> bool:
    if a == b:
        return True
    x, y = a.split(), b.split()
    if len(x) == len(y):
        return all(map(_close, x, y))
    return edits(a.replace(" ", ""), b.replace(" ", ""), 1) <= 1


@lru_cache(200_000)
def same_town(a: str, b: str) -> bool:
    """Whether one of the readings of a (separated by |) is a reading of b."""
    return any(same_words(x, y) for x in a.split("|") for y in b.split("|"))


def settled(p: tuple, q: tuple) -> tuple:
    """An address whose direction word may be the street's or the town's, read as its own postcode's town or the other's tells."""
    if p[3][:1] != "?":
        return p
    full = p[4].partition("|")[0]
    bare = full.partition(" ")[2]
    for t in (p[7], q[4], q[7]):
        if t and bare and same_town(bare, t) != same_town(full, t):
            return (*p[:3], p[3][1:], bare, *p[5:]) if same_town(bare, t) else (*p[:3], "", *p[4:])
    return (*p[:3], "", *p[4:])


def same_location(p: tuple, q: tuple) -> bool:
    """p, q: (number, street, type, direction, town, state, postcode, town by gazetteer, state by gazetteer).

    Number and street have to agree. Every other component that one side lacks agrees with any: type, direction, and in the locality
    postcode, state and town. Two postcodes decide the locality; else neither two states nor two towns may differ, where the
    gazetteer's stand in for what the text lacks.
    """
    p, q = settled(p, q), settled(q, p)
    if p[0] != q[0] or (p[2] and q[2] and p[2] != q[2]) or (p[3] and q[3] and p[3] != q[3]) or not same_words(p[1], q[1]):
        return False
    if p[6] and q[6]:
        return p[6] == q[6]
    if len({p[5] or p[8], q[5] or q[8]} - {""}) == 2:
        return False
    t, u = p[4] or p[7], q[4] or q[7]
    return not (t and u) or same_town(t, u) or bool(p[7] and same_town(p[7], u)) or bool(q[7] and same_town(t, q[7]))


_PARSED = "number string, street string, kind string, direction string, town string, state string, postcode string"


def _parse_batch(text: pd.Series) -> pd.DataFrame:
    rows = [parse(t) or ("",) * 7 for t in text]
    return pd.DataFrame(rows, columns=["number", "street", "kind", "direction", "town", "state", "postcode"])


def _same_batch(a: pd.DataFrame, b: pd.DataFrame) -> pd.Series:
    return pd.Series([same_location(x, y) for x, y in zip(a.itertuples(index=False, name=None), b.itertuples(index=False, name=None))], dtype=bool)


_COLUMNS = ("number", "street", "kind", "direction", "town", "state", "postcode", "g_town", "g_state")


def parsed(addresses: DataFrame) -> DataFrame:
    """The rows of distinct address texts (column _text) that name a number and a street, with the components."""
    parse_udf = F.pandas_udf(_parse_batch, _PARSED)
    rows = addresses.where(F.col("_text").isNotNull() & F.col("_text").rlike("[0-9]")).select("*", parse_udf("_text").alias("p"))
    return rows.select(*addresses.columns, "p.*").where("number != '' AND street != ''")


def gazetteer(addresses: DataFrame, key: str) -> DataFrame:
    """For every postcode (or town) the town and state that most address texts give with it; at least two texts must agree."""
    both = addresses.where("town != '' AND state != '' AND instr(town, '|') = 0").where(F.col(key) != "").groupBy(F.col(key).alias("_k"), F.col("town").alias("_t"), F.col("state").alias("_s")).agg(F.count(F.lit(1)).alias("n"))
    best = both.groupBy("_k").agg(F.max(F.struct(F.col("n"), F.col("_t"), F.col("_s"))).alias("b"))
    return best.where("b.n >= 2").select(F.col("_k").alias(key), F.col("b._t").alias("g_town"), F.col("b._s").alias("g_state"))


def _keys(df: DataFrame, seed: bool) -> DataFrame:
    """A row for every key of an address. Keys of seeds meet those of all addresses.

    Two addresses with postcodes have the same one if they are the same, and meet by it. Two with known states have the same one. So a pair
    that meets by either end of its street meets in the state that both know, unless one of them knows none; such pairs have keys of their
    own, which say which side knows, so that two that know never meet there. In the same way keys say whether the seed has a postcode,
    and addresses with one don't meet seeds with one.
    """
    street = F.regexp_replace("street", " ", "")
    letters = lambda c: F.array_join(F.array_sort(F.split(F.substring(c, 1, 4), "")), "")  # noqa: E731  # swapped neighbours don't matter
    ends = F.array(F.concat(F.lit("a"), letters(street)), F.concat(F.lit("z"), letters(F.reverse(street))))
    state, posted = F.coalesce(F.nullif("state", F.lit("")), F.nullif("g_state", F.lit("")), F.lit("")), F.col("postcode") != ""
    known = state != ""
    if seed:
        where = F.when(known, F.array(F.concat(F.lit("="), state), F.lit("seed"))).otherwise(F.array(F.lit("other"), F.lit("none")))
        where = F.transform(where, lambda w: F.concat(F.when(posted, F.lit("1")).otherwise(F.lit("0")), w))
    else:
        where = F.when(known, F.array(F.concat(F.lit("="), state), F.lit("other"))).otherwise(F.array(F.lit("seed"), F.lit("none")))
        where = F.flatten(F.transform(F.when(posted, F.array(F.lit("0"))).otherwise(F.array(F.lit("0"), F.lit("1"))), lambda p: F.transform(where, lambda w: F.concat(p, w))))
    streets = F.flatten(F.transform(ends, lambda e: F.transform(where, lambda w: F.concat(e, w))))
    towns = F.filter(F.concat(F.split("town", r"\|"), F.array("g_town")), lambda t: t != "")
    towns = F.array_distinct(F.transform(towns, lambda t: F.concat(F.lit("t"), letters(t))))
    keys = F.concat(streets, towns, F.when(posted, F.array(F.concat(F.lit("p"), F.col("postcode")))).otherwise(F.array().cast("array<string>")))
    return df.withColumn("_key", F.explode(F.transform(keys, lambda k: F.xxhash64(F.col("number"), k))))


def same_addresses(seeds: DataFrame, events: DataFrame) -> DataFrame:
    """(seed_id, other_kind, other_id) of seeds and events, seeds and seeds whose location_address denotes the same location.

    Null, empty and town-only addresses, or such without a number, denote none. Repeated seeds and events each count.
    Only ids and location_address are read.
    """
    s = seeds.select(F.col("seed_id").cast("long").alias("seed_id"), F.col("location_address").alias("_text"))
    e = events.select(F.col("event_id").cast("long").alias("event_id"), F.col("location_address").alias("_text"))
    # rows find their text again by 128 bits of hash, so that no join moves or holds the texts themselves
    hashes = (F.xxhash64("_text").alias("h1"), F.xxhash64("_text", F.lit(1)).alias("h2"))
    texts = s.select("_text", F.lit(True).alias("of_seed")).unionByName(e.select("_text", F.lit(False).alias("of_seed")))
    texts = texts.where("_text IS NOT NULL").groupBy("_text").agg(F.max("of_seed").alias("of_seed"))
    p = cut(parsed(texts).select(*hashes, "*").drop("_text"))
    # a postcode tells town and state; where there is none, a town tells the state
    p = keyed_join(p, gazetteer(p, "postcode"), ["postcode"], "left")
    p = keyed_join(p, gazetteer(p.drop("g_town", "g_state"), "town").select("town", F.col("g_state").alias("t_state")), ["town"], "left")
    p = p.withColumn("g_town", F.coalesce("g_town", F.lit(""))).withColumn("g_state", F.coalesce("g_state", "t_state", F.lit(""))).drop("t_state")
    # texts with the same components are one place: compare places, not texts
    p = p.withColumn("place", F.xxhash64(*_COLUMNS))
    places = cut(p.groupBy("place").agg(*[F.first(c).alias(c) for c in _COLUMNS], F.max("of_seed").alias("of_seed")))
    left = _keys(places, False).select("_key", F.col("place").alias("l_place"), F.struct(*_COLUMNS).alias("a"))
    right = _keys(places.where("of_seed"), True).select("_key", F.col("place").alias("r_place"), F.struct(*_COLUMNS).alias("b"))
    same = F.pandas_udf(_same_batch, "boolean")
    pairs = keyed_join(left, right, ["_key"]).dropDuplicates(["l_place", "r_place"]).where(same("a", "b")).select("l_place", "r_place")
    pairs = cut(pairs)
    by_text = p.select("h1", "h2", "place")
    s_place = cut(s.select("seed_id", *hashes).join(by_text, ["h1", "h2"]).select("seed_id", "place"))
    seeds_of = pairs.join(s_place.withColumnRenamed("place", "r_place"), "r_place").select(F.col("l_place").alias("place"), "seed_id")
    e_place = keyed_join(e.where("_text IS NOT NULL").select("event_id", *hashes), by_text, ["h1", "h2"]).select("event_id", "place")
    found_e = keyed_join(e_place, seeds_of, ["place"]).select("seed_id", F.lit("event").alias("other_kind"), F.col("event_id").alias("other_id"))
    other = s_place.withColumnRenamed("seed_id", "other_id")
    found_s = keyed_join(other, seeds_of, ["place"]).where("seed_id < other_id").select("seed_id", F.lit("seed").alias("other_kind"), "other_id")
    return found_e.unionByName(found_s).select("seed_id", "other_kind", "other_id")
