"""Template residue, filler text and error messages in titles and descriptions.

A field is cut into passages: spans that look like template code, and sentences. Passages with well-known wording (KINDS) are trusted
positives, all others are unlabelled. A naive Bayes model of the two classes is learnt from them by expectation-maximization:

* a first model takes all unlabelled passages as real, and some of the positives as spies among them. Unlabelled passages that score
  below nearly all spies, and far below even odds, are reliable real content and stay so;
* the other unlabelled passages get a share in both classes by the model, and the model is learnt again from the shares, until
  they stay. So wording that only goes along with trusted residue, and wording that goes along with that, becomes residue too.

Every passage of every field is scored by the model alone, trusted wording or not, and the passages of a field are aggregated: a field is
residue if it is more likely than not that at least one of its passages is.

The model is fitted on bounded samples: SAMPLE_ROWS rows of each stratum (titles, short and long descriptions), drawn by hash, and
TRUSTED_FIELDS texts that open with trusted wording or hold template code, which are looked for in all rows and drawn by priority, so each
stands for as many rows as it should whether texts are often repeated or never. Shares of the classes are weighted to the whole table, so
the model doesn't depend on its size. Scoring covers all fields whole.
"""

from __future__ import annotations

import math
import re
import uuid
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenfall.llm import furniture

#: Rows that each stratum is represented by, at most, and distinct texts with trusted wording, at most.
SAMPLE_ROWS, TRUSTED_FIELDS = 8_000, 6_000
#: Descriptions of at most so many characters are a stratum of their own. Only the sample depends on it.
SHORT = 200
ROUNDS = 12
#: Share of the positives that are spies, the quantile of their scores below which an unlabelled passage is reliably real, and the log
#: odds that it must be below besides.
SPIES, QUANTILE, SURELY_REAL = 0.15, 0.05, -10.0
#: Weight of the shares of words among all passages in a class's shares of words.
PRIOR_WEIGHT = 50.0
#: Most that one feature may speak for residue.
MOST_ODDS = 6.5
#: Words that occur less often in the sample are taken by their kind.
LEAST = 3
#: Fields that trusted texts are counted per, and the rows of them below which they aren't thinned so.
RATE, ENOUGH = 500_000, 1_000

# Syntax of template languages, mail merges and formatting.
SPAN = re.compile(
    r"\{\{\{?[^{}]*\}?\}\}|\{%.*?%\}|<%.*?%>|\$\{[^{}]*\}|#\{[^{}]*\}|%\(\w+\)[a-z]|%[A-Z][A-Z_]+%|\*\|[^|]*\|\*|@@\w+@@|\[\[[^\[\]]*\]\]|\[[^\[\]\n]{1,60}\]|\{[^{}\n]{0,40}\}"
    r"|\b__\w+?__\b|&lt;/?\w+&gt;|<\w+>|(?<![\w:]):[a-z_]+:[a-z_]+\b|(?<![\w:/]):[a-z]+_[a-z_]+\b|\b(?:undefined|NaN)\b|(?<!\w)null(?!\w)|\[object \w+\]"
)
# Trusted wording by kind; of spans anywhere, of a whole field, and of the beginning of a sentence.
SYNTAX = r"\{\{.*?\}\}|\{%.*?%\}|<%.*?%>|\$\{\w[\w.]*\}|#\{\w[\w.]*\}|%\(\w+\)s|%[A-Z_]{3,}%|\*\|[A-Z_]+\|\*|@@\w+@@|\[\[\w+\]\]|__[A-Z_]{3,}__|&lt;\w+&gt;|\{\d\}|\[object \w+\]"
WHOLE = r"undefined|null|NaN|None|Loading(?:…|\.\.\.)|Forbidden"
KINDS = {
    "filler": r"lorem ipsum \w+",
    "status": r"(?:http |error )?[45]\d\d\W*(?:not found|forbidden|unauthorized|bad gateway|(?:service )?unavailable|server error|gone|timeout)|error [45]\d\d",
    "page": r"(?:\w+[,!:] )?(?:(?:this|that|the) )?(?:page|address|link|seite|página) (?:\w+ ){0,5}(?:not (?:be )?found|no longer exists|nicht gefunden|no encontrada)",
    "access": r"access denied",
    "script": r"(?:[\w,]+ ){0,8}(?:enable|activate|turn on|allow|aktivieren sie|requiere) javascript",
    "browser": r"(?:checking your browser|just a (?:second|moment))",
    "prompt": r"(?:your (?:\w+ ){1,4}(?:goes )?here|(?:insert|enter) (?:\w+ ){1,4}here|escribe aquí|hier steht ein beispieltext|(?:sample|demo) (?:event|page|show|post|text|description))",
}
_SYNTAX = re.compile(SYNTAX)
_WHOLE = re.compile(WHOLE)
_SPECIAL = re.compile(r"[{\[<$%*@_&]|:[a-z]|undefined|NaN|null")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+")
_WORD = re.compile(r"[^\W\d_]+|\d+|[#@%!?…]")
_SAYS = re.compile(r"[^\W_]")

Model = tuple[dict[str, float], float]


def trusted_wording(kinds: dict[str, str] = KINDS) -> re.Pattern:
    """The beginnings of sentences of these kinds."""
    return re.compile(r"\W*(?:" + "|".join(kinds.values()) + r")\b", re.IGNORECASE)


def opens_trusted(name: str, kinds: dict[str, str] = KINDS):
    """Whether that column opens with the same; for the JVM."""
    return F.col(name).rlike(rf"(?iU:^[^\p{{L}}\p{{N}}_]*(?:{'|'.join(kinds.values())})\b)")


def trusted_text(kinds: dict[str, str] = KINDS):
    """Whether the column text opens with the same, is trusted whole, or holds trusted spans; for the JVM."""
    text = F.col("text")
    syntax = text.rlike(rf"(?=[{{<$#%*@\[_&])(?:{SYNTAX})")
    return syntax | ((F.length(text) < 20) & F.trim(text).rlike(rf"^(?:{WHOLE})$")) | opens_trusted("text", kinds)


def span_features(span: str) -> tuple[str, ...]:
    """The span's shape, in which each run of words is one letter, and its words."""
    shape = re.sub(r"\w+(?:[\s.'’-]+\w+)*", lambda m: "A" if m[0].isupper() else "9" if m[0].isdigit() else "a_" if "_" in m[0] else "a" if m[0].islower() else "Aa", span)
    return tuple(dict.fromkeys(("S:" + "".join(shape.split()), *(w.lower() for w in re.findall(r"[^\W\d_]+", span)))))


def sentence_features(sentence: str, place: str) -> tuple[str, ...]:
    """Distinct words, those with a capital marked until it is known whether they are rare, and the place of the sentence."""
    out = []
    for w in _WORD.findall(sentence):
        if w.isdigit():
            out.append("#http" if w[0] in "45" and len(w) == 3 else "#num")
        else:
            out.append(w.lower() + "\0" if w[0].isupper() else w)
    return (*dict.fromkeys(out), place)


def cut_up(text: str, title: bool) -> tuple[list[tuple[str, list[str], list[str]]], str]:
    """Lines with their spans and sentences, and the place of the sentences: a title, or one of one, few or many in a description."""
    special = _SPECIAL.search(text)
    lines: list[tuple[str, list[str], list[str]]] = []
    n = 0
    for line in text.split("\n"):
        spans = [m[0] for m in SPAN.finditer(line)] if special else []
        rest = SPAN.sub(" ", line) if spans else line
        sentences = [x for x in _SENTENCE.split(rest) if _SAYS.search(x)]
        n += len(sentences)
        lines.append((line, spans, sentences))
    return lines, "F:title" if title else "F:one" if n == 1 else "F:few" if n <= 3 else "F:many"


def is_furniture(line: str, spans: list[str]) -> bool:
    """Page furniture is a real part of a page, whatever words it shares with notices; template code in it is none."""
    return furniture.reads_like(line) and not (spans and _SYNTAX.search(line))


def passages(text: str, title: bool, wording: re.Pattern) -> list[tuple[tuple[str, ...], bool]]:
    """The features of every passage, and whether it is trusted. A field of few sentences that opens with trusted wording is trusted whole."""
    lines, place = cut_up(text, title)
    few = sum(len(x) for _, _, x in lines) <= 3 and not any(x for _, x, _ in lines)
    whole = bool(_WHOLE.fullmatch(text.strip())) or few and bool(wording.match(text))
    out = []
    for line, spans, sentences in lines:
        if not is_furniture(line, spans):
            out += [(span_features(x), whole or bool(_SYNTAX.fullmatch(x))) for x in spans]
            out += [(sentence_features(x, place), whole or bool(wording.match(x))) for x in sentences]
    return out


def resolved(features: tuple[str, ...], known) -> list[str]:
    """Features of the vocabulary; rare words and shapes stand by their kind."""
    out = []
    new, New = ("S:new", "S:new") if features[0][:2] == "S:" else ("#new", "#New")
    for w in features:
        base = w[:-1] if w[-1:] == "\0" else w
        out.append(base if base in known or base[:2] == "F:" else "S:?" if base[:2] == "S:" else New if base is not w else new)
    return list(dict.fromkeys(out))


def fit(fields: list[tuple[str, bool, float, float]], *, kinds: dict[str, str] = KINDS, rounds: int = ROUNDS) -> Model:
    """(log odds by feature, prior log odds) from fields (text, is title, how many rows of the table it stands for, its rate if trusted).

    With rounds 0 the model is the first one with reliable real content, without expectation-maximization.
    """
    wording = trusted_wording(kinds)
    known: dict[tuple[str, ...], bool] = {}
    often: dict[tuple[str, ...], float] = {}
    stands: dict[tuple[str, ...], float] = {}
    for text, title, rows, rate in fields:
        for x, ok in passages(text, title, wording):
            known[x] = known.get(x, False) or ok
            often[x] = often.get(x, 0.0) + (rate if ok and rate else 1.0)
            stands[x] = stands.get(x, 0.0) + rows
    if not known or not any(known.values()):
        return {}, -50.0
    frequency: dict[str, float] = {}
    for x in known:
        for w in {w.rstrip("\0") for w in x}:
            frequency[w] = frequency.get(w, 0) + often[x]
    vocabulary = {w for w, n in frequency.items() if n >= LEAST or w[:2] == "S:"}
    index: list[int] = []
    start: list[int] = []
    number: dict[str, int] = {}
    for x in known:
        start.append(len(index))
        index += [number.setdefault(w, len(number)) for w in resolved(x, vocabulary)]
    at, start_ = np.array(index), np.array(start)
    length = np.diff(np.append(start_, len(at)))
    sure = np.array(list(known.values()))
    n = np.array(list(often.values()))
    weight = np.minimum(n, np.sqrt(n))  # a passage that many records share is less than as many passages
    size = np.array(list(stands.values()))
    background = np.bincount(at, weights=np.repeat(weight, length), minlength=len(number)) + 0.05
    background /= background.sum()

    def learnt(p: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, float]:
        pos, neg = (np.bincount(at, weights=np.repeat(among * weight * w, length), minlength=len(number)) for w in (p, 1 - p))
        # both classes are mixed with the words of all passages by the same share, so what neither has seen speaks for neither
        mixed = PRIOR_WEIGHT / (pos.sum() + PRIOR_WEIGHT)
        logs = [np.log((1 - mixed) * n / max(n.sum(), 1e-9) + mixed * background) for n in (pos, neg)]
        share = min(0.5, max(1e-9, float((among * size * p).sum() / size.sum())))
        return np.minimum(logs[0] - logs[1], MOST_ODDS), math.log(share / (1 - share))

    def scores(odds: np.ndarray, prior: float) -> np.ndarray:
        return np.add.reduceat(odds[at], start_) + prior

    everything = np.ones(len(sure))
    spies = sure & (np.random.default_rng(0).random(len(sure)) < SPIES)
    first = scores(*learnt((sure & ~spies).astype(float), everything))
    limit = min(SURELY_REAL, float(np.quantile(first[spies], QUANTILE))) if spies.any() else SURELY_REAL
    real = ~sure & (first < limit)
    p = sure.astype(float)
    odds, prior = learnt(p, (sure | real).astype(float))
    for _ in range(rounds):
        old = p
        p = np.where(sure, 1.0, np.where(real, 0.0, 1 / (1 + np.exp(-np.clip(scores(odds, prior), -50, 50)))))
        odds, prior = learnt(p, everything)
        if np.abs(p - old).max() < 1e-3:
            break
    out = {w: float(odds[i]) for w, i in number.items()}
    for w in ("#new", "#New", "S:new", "S:?"):
        out.setdefault(w, 0.0)
    return out, prior


class Tokens(dict):
    """The number of the feature that a word or figure is, worked out when it is first met."""

    def __init__(self, number: dict[str, int]) -> None:
        super().__init__()
        self.number = number

    def __missing__(self, w: str) -> int:
        if w.isdigit():
            k = "#http" if w[0] in "45" and len(w) == 3 else "#num"
        else:
            k = w.lower()
            if k not in self.number:
                k = "#New" if w[0].isupper() else "#new"
        n = self.number.get(k, 0)  # the first feature speaks for nothing
        if len(self) < 500_000:
            self[w] = n
        return n


class Scorer:
    """Log odds that fields are residue."""

    #: Passages with lower log odds can't matter.
    FLOOR = -12.0

    def __init__(self, model: Model) -> None:
        self.odds, self.prior = model
        names = ["", *self.odds]
        self.values = [0.0, *self.odds.values()]
        self.number = Tokens({w: n for n, w in enumerate(names) if n})
        self.score = lru_cache(20_000)(self._score)
        self.of_span = lru_cache(5_000)(lambda x: self.prior + sum(self.odds.get(w, 0.0) for w in resolved(span_features(x), self.odds)))

    def of_sentence(self, sentence: str, place: str) -> float:
        features = set(map(self.number.__getitem__, _WORD.findall(sentence)))
        return self.prior + self.odds.get(place, 0.0) + sum(map(self.values.__getitem__, features))

    def _score(self, text: str, title: bool) -> float:
        """Log odds that at least one passage is residue; -50 if none can be."""
        lines, place = cut_up(text, title)
        none = 0.0  # the negative log of the chance that no passage is
        for line, spans, sentences in lines:
            here = 0.0
            for s in [*map(self.of_span, spans), *[self.of_sentence(x, place) for x in sentences]]:
                if s > self.FLOOR:
                    here += math.log1p(math.exp(min(s, 50.0)))
            # most lines say nothing, so whether they are furniture needn't be asked
            if here > 1e-3 and is_furniture(line, spans):
                continue
            none += here
        if none <= 0:
            return -50.0
        return none if none > 30 else math.log(math.expm1(none))


def learn(fields: DataFrame, *, kinds: dict[str, str] = KINDS, rounds: int = ROUNDS) -> Model:
    """The model from bounded samples of fields (columns event_id, field_name, text)."""
    stratum = F.when(F.col("field_name") == "title", F.lit("title")).when(F.length("text") <= SHORT, F.lit("short")).otherwise(F.lit("long"))
    f = fields.withColumn("stratum", stratum)
    sizes = {r["stratum"]: r["n"] for r in f.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return {}, -50.0
    # a row is drawn by its own hash, so the same ones are, however the table is partitioned
    draw = F.pmod(F.xxhash64("event_id", "field_name"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    share = F.create_map(*[x for s, n in sizes.items() for x in (F.lit(s), F.lit(min(1.0, SAMPLE_ROWS / n)))])
    drawn = f.where(draw < share[F.col("stratum")]).select("stratum", "text", trusted_text(kinds).alias("trusted")).limit(4 * SAMPLE_ROWS).collect()
    taken = {s: sum(r["stratum"] == s for r in drawn) for s in sizes}
    # priorities: of the texts with the greatest n / u, u uniform by the text's hash, each stands for n rows, or for the first priority
    # that is left out if that is more. This estimates the rows of every kind of text without bias
    u = (F.pmod(F.xxhash64("text", "field_name"), F.lit(1 << 40)) + 1) / F.lit(float(1 << 40))
    found = f.where(trusted_text(kinds)).groupBy("field_name", "text").agg(F.count(F.lit(1)).alias("n")).withColumn("priority", F.col("n") / u)
    found = found.orderBy(F.desc("priority"), "text", "field_name").limit(TRUSTED_FIELDS + 1).collect()
    least = found.pop()["priority"] if len(found) > TRUSTED_FIELDS else 0.0
    trusted = {(r["text"], r["field_name"] == "title"): max(float(r["n"]), least) for r in found}
    thin = max(1.0, min(sum(sizes.values()) / RATE, sum(trusted.values()) / ENOUGH))
    rows: dict[tuple[str, bool], tuple[float, float]] = {}
    for r in drawn:
        if not r["trusted"]:  # the others are represented by those found
            k = (r["text"], r["stratum"] == "title")
            rows[k] = (rows.get(k, (0.0, 0.0))[0] + sizes[r["stratum"]] / taken[r["stratum"]], 0.0)
    rows |= {k: (n, n / thin) for k, n in trusted.items()}
    return fit(sorted((t, title, n, rate) for (t, title), (n, rate) in rows.items()), kinds=kinds, rounds=rounds)


_SCORERS: dict[str, Scorer] = {}


def _scorer(key: str, model) -> Scorer:
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(model.value)
    return _SCORERS[key]


def scored(fields: DataFrame, model: Model) -> DataFrame:
    """Adds score, the log odds that the column text (a title where field_name says so) is residue."""
    sent = fields.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    def score(text: pd.Series, name: pd.Series) -> pd.Series:
        s = _scorer(key, sent).score
        return pd.Series([s(t, n == "title") for t, n in zip(text, name)], dtype=float)

    return fields.withColumn("score", F.pandas_udf(score, "double")("text", "field_name"))


def scored_rows(events: DataFrame, model: Model, names: tuple = ("title", "description")) -> DataFrame:
    """Adds score, the greater one of a row's title and description; both in one go. names: the two columns; where one is null, the other counts."""
    sent = events.sparkSession.sparkContext.broadcast(model)
    key = uuid.uuid4().hex

    def score(title: pd.Series, description: pd.Series) -> pd.Series:
        s = _scorer(key, sent).score
        return pd.Series([max(s(t, True) if t else -50.0, s(d, False) if d else -50.0) for t, d in zip(title, description)], dtype=float)

    return events.withColumn("score", F.pandas_udf(score, "double")(*names))


def fields_of(events: DataFrame) -> DataFrame:
    """event_id, field_name, text of every title and description that is not null or empty."""
    pairs = F.array(F.struct(F.lit("title").alias("field_name"), F.col("title").alias("text")), F.struct(F.lit("description").alias("field_name"), F.col("description").alias("text")))
    return events.select("event_id", F.explode(pairs).alias("f")).select("event_id", "f.field_name", "f.text").where("text IS NOT NULL AND text != ''")


def residue_fields(events: DataFrame, model: Model | None = None) -> DataFrame:
    """(event_id, field_name) of the titles and descriptions that are residue, wholly or in part.

    Null and empty fields have no row. Without any trusted residue in the table nothing is found. Repeated event rows each count.
    """
    fields = fields_of(events)
    return scored(fields, model or learn(fields)).where("score > 0").select("event_id", "field_name")
