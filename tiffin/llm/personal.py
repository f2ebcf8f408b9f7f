"""Personal data by weak supervision: labelers vote, their reliabilities are estimated, a classifier decides.

1. **Candidates.** Base spans (e-mail and IP addresses, card and phone numbers by the rules in `base_spans`) and wider
   forms that these rules miss: card numbers next to other digits, phone numbers without a plus sign or next to other
   digits, spelled-out e-mail addresses, IPv6 addresses, bank account numbers, names of people.
2. **Labelers** (`LABELERS`) vote for (1) or against (-1) a candidate, or abstain (0): regular expressions for its
   usual forms, checksums and ranges, gazetteers (issuer and country prefixes, top-level domains, first names), cue
   words for and against it before the span, and what touches the span.
3. **Aggregation.** A labeler of a kind of span has one reliability, the chance that a vote of its is right, and
   abstains whatever the truth is. Expectation-maximisation over the votes of all candidates estimates reliabilities
   and the share of personal data per kind, and with them the probability of each pattern of votes.
4. **Classifier.** A naive Bayes classifier over hashed features of span and context, which the labelers do not use as
   such, is trained on all candidates, each counted in both classes by its probability. Its odds, tempered by the number of
   features, and those of the votes decide on the candidates that are no base spans: those with a probability of
   `LEAST` or more are added, longest first, if they overlap no span that is there already. Card and account numbers
   that fail their checksum train the model, but are never added: they are no such numbers.

Texts are scanned once, and the candidates with votes and features are written to the shared folder. What training
collects is bounded by the numbers of kinds, labelers and features: patterns of votes (at most 6 * 3^6 counts) and
soft counts per feature (6 * 6 * 1,024). Both are summed in the tasks first, so a cue or a feature that all
rows share is no hot key.

Spans are code points, end exclusive. Kinds are listed in the order of `KINDS`.

Defined results: a null or empty text has no spans. Whole texts are scanned, whatever their length. Repeated rows count
repeatedly in the training and get equal spans; nothing joins on ids, so null or repeated ids do not matter, nor do other
columns. Without any candidate (or on an empty table) nothing is added.
"""

from __future__ import annotations

import ipaddress
import math
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm.common import staged, table

# The kinds in the order of the output, base kinds first.
KINDS = ("email", "ip", "card", "phone", "iban", "name")
EMAIL, IP, CARD, PHONE, IBAN, NAME = range(6)
BASE_KINDS = KINDS[:4]

#: Probability from which on a candidate is added.
LEAST = 0.9
#: Hash buckets of each feature.
BUCKETS = 1_024

# Fixed values of the gazetteers: top-level domains, telephone country codes (the North American code first),
# letters that account numbers start with, first names.
_TOP_LEVEL = set(
    "com org net edu gov mil int info biz io dev app eu de at ch fr be nl es pt it uk ie us ca mx br ar cl co au nz jp cn in"
    " ru pl cz se no fi dk gr tr za".split()
)
_CALLING = (
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91"
    " 92 93 94 95 98 351 352 353 354 358 420 421".split()
)
_BANK_LENGTHS = {"DE": 22, "FR": 27, "ES": 24, "IT": 27, "GB": 22, "NL": 18, "BE": 16, "AT": 20, "CH": 21, "PT": 25, "PL": 28, "SE": 24}
_FIRST_NAMES = set(
    "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph Jessica"
    " Thomas Sarah Charles Karen Daniel Nancy Matthew Lisa Anthony Margaret Mark Sandra Paul Ashley Steven Emily Andrew"
    " Peter Hans Klaus Jürgen Wolfgang Stefan Ursula Monika Petra Sabine Heike Anna Maria Julia Jean Pierre Michel"
    " Philippe Alain Nicolas Marie Nathalie Isabelle Sylvie Catherine Françoise Jacques Luc José Antonio Manuel Francisco"
    " Juan Carlos Carmen Ana Isabel Pilar Lucía Javier Miguel Pedro Sofía Laura Elena Diego Pablo Alice Emma Oliver"
    " Sophie Lucas Marco Giulia".split()
)

# Cue words by kind, for it and against it, in the four languages of the tables.
_CUES = {
    EMAIL: "mail email e-mail contact write kontakt schreiben courriel contacter correo contacto address adresse",
    IP: "ip address host server from login client adresse serveur servidor dirección rechner",
    CARD: "card visa mastercard amex credit debit karte kreditkarte carte tarjeta crédito pan",
    PHONE: "phone tel telephone call mobile cell fax telefon handy anruf téléphone appeler portable teléfono llamar móvil",
    IBAN: "iban account bank konto compte banque cuenta banco bic swift",
    NAME: "mr mrs ms dr prof name named herr frau monsieur madame señor señora signed author contact nombre nom",
}
_AGAINST = set(
    "version v release section figure fig table page isbn issn order invoice hash sha md5 token key secret password id serial"
    " sku part build commit".split()
)
_CUE_SETS = {kind: set(words.split()) for kind, words in _CUES.items()}

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")  # without the group it passes over a number
_CARD = re.compile(r"[0-9](?:[\x20-]?+[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = int(c) << (place & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each address starts with the run of letters before its @, as far as it is free."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind and start: leftmost matches of each kind that do not overlap, without
    those that fail the kind's check. Every search takes linear time."""
    spans = [(EMAIL, a, b) for a, b in _emails(text)] if "@" in text else []
    spans += [(IP, *m.span()) for m in _IP.finditer(text) if m[1] and _octets(m[0])]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0]) if m.end() - m.start() >= 16 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append((CARD, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                spans.append((PHONE, *m.span()))
    return spans


#: Kind, pattern, and what must not stand before a match. Patterns start with a set or a letter, which are
#: searched much faster than what begins with a look behind.
_WIDER: tuple[tuple[int, re.Pattern, re.Pattern], ...] = tuple(
    (kind, re.compile(pattern), re.compile(left))
    for kind, pattern, left in (
        (
            EMAIL,
            r"[A-Za-z0-9._%+-]{1,64}\x20?(?:\[at\]|\(at\)|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}"
            r"(?:\x20?(?:\[dot\]|\(dot\)|\x20dot\x20)\x20?[A-Za-z0-9-]{2,63}){1,4}",
            r"[A-Za-z0-9._%+-]",
        ),
        (IP, r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])", r"[0-9A-Fa-f:]"),
        (
            CARD,
            r"[0-9](?:[0-9]{12,18}|[0-9]{3}(?:[\x20-][0-9]{4}){3}|[0-9]{3}[\x20-][0-9]{6}[\x20-][0-9]{5})(?![0-9A-Za-z])",
            r"[0-9A-Za-z]",
        ),
        (
            PHONE,
            r"\+[0-9]{1,3}[\x20-]?\(?[0-9]{2,4}\)?[\x20-]?[0-9]{3}[\x20-]?[0-9]{4}(?![0-9A-Za-z])",
            r"[0-9A-Za-z]",
        ),
        (
            PHONE,
            r"[(0-9](?:(?<=\()[0-9]{3}|(?<=[0-9])[0-9]{2})\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z])",
            r"[0-9A-Za-z+]",
        ),
        (
            PHONE,
            r"00[1-9][0-9]{0,2}[\x20-][0-9]{2,4}[\x20-][0-9]{3,4}[\x20-]?[0-9]{2,4}(?![0-9A-Za-z])",
            r"[0-9A-Za-z+]",
        ),
        (
            IBAN,
            r"[A-Z][A-Z][0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
            r"[0-9A-Za-z]",
        ),
        (
            NAME,
            r"[A-ZÀ-Þ][a-zà-ÿ]{1,20}(?=((?:\x20[A-ZÀ-Þ]\.)?(?:\x20[A-ZÀ-Þ][a-zà-ÿ]{2,20}){1,2})(?![^\W_]))",
            r"[^\W_]",
        ),
    )
)


def candidates(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, whether it is a base span) of all that is worth a vote."""
    found = [(*span, True) for span in base_spans(text)]
    taken = sorted((a, b) for _, a, b, _ in found)
    skipped = {k for k, can_be in ((EMAIL, "dot" in text), (IP, text.count(":") >= 7)) if not can_be}
    for kind, pattern, left in _WIDER:
        if kind in skipped:
            continue
        for m in pattern.finditer(text):
            if m.start() and left.match(text, m.start() - 1):
                continue
            if kind == NAME and m[0] not in _FIRST_NAMES:
                continue
            end = m.end(1) if kind == NAME else m.end()  # a name may start within what looks like one
            if not _meets(taken, m.start(), end):
                found.append((kind, m.start(), end, False))
    return found


def _meets(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether one of the spans, which are in order, overlaps this one. Base spans of different kinds may
    overlap each other, so a few before the last that starts in time are looked at."""
    low, high = 0, len(taken)
    while low < high:
        middle = (low + high) // 2
        low, high = (middle + 1, high) if taken[middle][0] < end else (low, middle)
    return any(b > start for _, b in taken[max(0, low - len(BASE_KINDS)) : low])


@dataclass(frozen=True)
class Span:
    """What labelers look at: the span, its digits, what touches it, and words around it."""

    kind: int
    text: str
    digits: str
    left: str
    right: str
    before: list[str]
    after: list[str]


def _words(text: str) -> list[str]:
    return [w.strip(".,;:!?()[]\"'").lower() for w in text.split()]


def _seen(text: str, kind: int, start: int, end: int) -> Span:
    inside = text[start:end]
    return Span(
        kind,
        inside,
        _NOT_DIGIT.sub("", inside),
        text[start - 1 : start],
        text[end : end + 1],
        _words(text[max(0, start - 48) : start])[-4:],
        _words(text[end : end + 32])[:2],
    )


# Usual forms by kind, for whole spans.
_FORMS = {
    EMAIL: re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}"),
    IP: re.compile(r"(?:(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7})"),
    CARD: re.compile(r"[0-9]{16}|[0-9]{4}(?:[\x20-][0-9]{4}){3}|3[0-9]{3}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}"),
    PHONE: re.compile(r"(?:\+[0-9]{1,3}[\x20-]?)?\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}|(?:\+|00)[1-9][0-9\x20-]{7,18}"),
    IBAN: re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"),
    NAME: re.compile(r"[A-ZÀ-Þ][a-zà-ÿ]+(?:\x20[A-ZÀ-Þ]\.)?(?:\x20[A-ZÀ-Þ][a-zà-ÿ]+){1,2}"),
}


def votes_form(s: Span) -> int:
    return 1 if _FORMS[s.kind].fullmatch(s.text) else -1


def votes_check(s: Span) -> int:
    """Checksums and ranges."""
    if s.kind == CARD:
        return 1 if 13 <= len(s.digits) <= 19 and luhn(s.digits) else -1
    if s.kind == IP:
        try:
            return 1 if ipaddress.ip_address(s.text) else -1
        except ValueError:
            return -1
    if s.kind == IBAN:
        code = s.text.replace(" ", "")
        return 1 if int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1 else -1
    if s.kind == PHONE:
        return 1 if 10 <= len(s.digits) <= 15 and len(set(s.digits)) > 2 else -1
    return 0


def _issuer(digits: str) -> bool:
    """Prefixes and lengths of the large card networks."""
    two, four = int(digits[:2]), int(digits[:4])
    if len(digits) == 15:
        return two in (34, 37)
    return len(digits) in (13, 16, 19) and (
        digits[0] == "4" or 51 <= two <= 55 or 2221 <= four <= 2720 or four == 6011 or two in (35, 62, 65)
    )


def votes_gazetteer(s: Span) -> int:
    if s.kind == EMAIL:
        top = re.split(r"[^A-Za-z0-9-]+", s.text.rstrip(")]"))[-1].lower()
        return 1 if top in _TOP_LEVEL else -1
    if s.kind == CARD:
        return 1 if len(s.digits) >= 4 and _issuer(s.digits) else -1
    if s.kind == PHONE and (s.text[0] == "+" or s.text[:2] == "00"):
        return 1 if s.digits.lstrip("0").startswith(tuple(_CALLING)) else -1
    if s.kind == IBAN:
        return 1 if _BANK_LENGTHS.get(s.text[:2]) == len(s.text.replace(" ", "")) else -1
    if s.kind == NAME:
        return 1 if s.text.split(" ", 1)[0] in _FIRST_NAMES else -1
    return 0


def votes_cue(s: Span) -> int:
    return 1 if any(w in _CUE_SETS[s.kind] for w in s.before) else 0


def votes_other_cue(s: Span) -> int:
    return -1 if any(w in _AGAINST for w in s.before[-2:]) else 0


def votes_edges(s: Span) -> int:
    """A span in the middle of something longer is rarely what it looks like."""
    glued = s.left.isalnum() or s.right.isalnum() or s.left in tuple("=/_#") or s.right == "_"
    return -1 if glued else 1


LABELERS: tuple[Callable[[Span], int], ...] = (
    votes_form,
    votes_check,
    votes_gazetteer,
    votes_cue,
    votes_other_cue,
    votes_edges,
)

#: How often the votes of each are expected to be right, before any were seen: a checksum nearly always.
EXPECTED = (0.7, 0.99, 0.8, 0.8, 0.8, 0.8)

_SHAPES = ((re.compile(r"[0-9]+"), "9"), (re.compile(r"[A-ZÀ-Þ]+"), "A"), (re.compile(r"[a-zà-ÿ]+"), "a"))


def features(s: Span) -> list[int]:
    """One hash bucket per feature: shape, length, neighbours, words before and after."""
    shape = s.text
    for pattern, mark in _SHAPES:
        shape = pattern.sub(mark, shape)
    values = (
        shape[:40],
        f"{len(s.text) // 4} {len(s.digits)}",
        f"{s.left!r} {s.right!r}",
        s.before[-1] if s.before else "",
        s.before[-2] if len(s.before) > 1 else "",
        s.after[0] if s.after else "",
    )
    return [n * BUCKETS + zlib.crc32(v.encode()) % BUCKETS for n, v in enumerate(values)]


_CANDIDATE = "kind int, start long, end long, base boolean, votes string, features array<int>"


def _candidates_of(text: str | None) -> list[dict]:
    out = []
    for kind, start, end, base in candidates(text) if text else ():
        span = _seen(text, kind, start, end)
        votes = "".join("-0+"[label(span) + 1] for label in LABELERS)
        out.append({"kind": kind, "start": start, "end": end, "base": base, "votes": votes, "features": features(span)})
    return out


def with_candidates(docs: DataFrame, text_col: str, to: str) -> DataFrame:
    @F.pandas_udf(f"array<struct<{_CANDIDATE.replace(' ', ': ').replace(',:', ',')}>>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([_candidates_of(t) for t in texts], dtype=object)

    return docs.withColumn(to, run(docs[text_col]))


@dataclass(frozen=True)
class Reliability:
    """Of one kind: share of personal data, and the chance that a labeler's vote is right."""

    share: float
    right: tuple[float, ...]

    def odds(self, votes: str) -> float:
        """Logarithm of the odds that a candidate with these votes is personal data."""
        total = math.log(self.share / (1 - self.share))
        for vote, right in zip(votes, self.right):
            total += {"-": -1, "0": 0, "+": 1}[vote] * math.log(right / (1 - right))
        return total


def _probability(odds: float) -> float:
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))


def reliabilities(patterns: dict[str, int], rounds: int = 50, prior: float = 4.0) -> Reliability:
    """By expectation-maximisation over the numbers of candidates with each pattern of votes.

    The prior counts as `prior` votes of which a share `EXPECTED` is right, and as many candidates of which half are
    personal data. A reliability stays between 0.55 and 0.99, so votes keep their meaning.
    """
    found = Reliability(0.5, EXPECTED)
    for _ in range(rounds):
        chance = {p: _probability(found.odds(p)) for p in patterns}
        yes = sum(n * chance[p] for p, n in patterns.items())
        share = (yes + prior / 2) / (sum(patterns.values()) + prior)
        right = []
        for at in range(len(LABELERS)):
            hits = sum(n * (chance[p] if p[at] == "+" else 1 - chance[p]) for p, n in patterns.items() if p[at] != "0")
            votes = sum(n for p, n in patterns.items() if p[at] != "0")
            right.append(min(0.99, max(0.55, (hits + EXPECTED[at] * prior) / (votes + prior))))
        found = Reliability(min(0.98, max(0.02, share)), tuple(right))
    return found


@dataclass(frozen=True)
class Model:
    labelers: dict[int, Reliability]
    #: By kind: the logarithm of how much likelier each feature is among personal data.
    weights: dict[int, np.ndarray]

    def probability(self, kind: int, votes: str, features: list[int]) -> float:
        odds = self.labelers[kind].odds(votes)
        # Features of a span depend on each other; their mean counts as one more labeler does.
        return _probability(odds + float(np.mean(self.weights[kind][features])))


def trained(found: DataFrame, to: str, smoothing: float = 4.0) -> Model:
    """A model from the candidates in column `to`."""
    spans = found.select(F.explode(to).alias("c")).select("c.kind", "c.votes", "c.features")
    patterns: dict[int, dict[str, int]] = {}
    for kind, votes, n in spans.groupBy("kind", "votes").count().collect():
        patterns.setdefault(kind, {})[votes] = n
    labelers = {k: reliabilities(patterns.get(k, {})) for k in range(len(KINDS))}
    chances = [(k, v, _probability(labelers[k].odds(v))) for k, seen in patterns.items() for v in seen]
    if not chances:
        return Model(labelers, {})
    # One row per kind and pattern of votes, 6 * 3^6 at most.
    known = found.sparkSession.createDataFrame(chances, "kind int, votes string, chance double")
    soft = spans.join(F.broadcast(known), ["kind", "votes"]).select("kind", "chance", F.explode("features").alias("f"))
    soft = soft.groupBy("kind", "f").agg(F.sum("chance").alias("yes"), F.sum(1 - F.col("chance")).alias("no"))
    counts = np.zeros((len(KINDS), 2, 6 * BUCKETS))
    for kind, f, yes, no in soft.collect():
        counts[kind, :, f] = yes, no
    weights = {}
    for kind, (yes, no) in enumerate(counts):
        slots = (yes + no).reshape(6, BUCKETS).sum(axis=1).repeat(BUCKETS)
        expected = np.divide(yes + no, slots, out=np.zeros_like(slots), where=slots > 0)
        all_yes, all_no = (c.reshape(6, BUCKETS).sum(axis=1).repeat(BUCKETS) for c in (yes, no))
        ratio = np.ones_like(expected)
        a = (yes + smoothing * expected) / (all_yes + smoothing)
        b = (no + smoothing * expected) / (all_no + smoothing)
        np.divide(a, b, out=ratio, where=expected > 0)
        weights[kind] = np.log(np.clip(ratio, 1e-3, 1e3))
    return Model(labelers, weights)


_CHECKED, _CHECK = (CARD, IBAN), LABELERS.index(votes_check)


def _decided(spans: list[dict], model: Model, least: float) -> list[dict]:
    """Base spans and what is added to them, by kind and start."""
    out = [(s["kind"], s["start"], s["end"], True, 1.0) for s in spans if s["base"]]
    scored = []
    for s in spans:
        if s["kind"] in _CHECKED and s["votes"][_CHECK] == "-":
            continue
        if not s["base"] and (p := model.probability(s["kind"], s["votes"], s["features"])) >= least:
            scored.append((s["start"] - s["end"], -p, s["start"], s["kind"], s["end"]))
    taken: list[tuple[int, int]] = []
    for _, p, start, kind, end in sorted(scored):
        if all(b <= start or end <= a for a, b in taken):
            taken.append((start, end))
            out.append((kind, start, end, False, -p))
    return [{"kind": KINDS[k], "start": a, "end": b, "base": base, "chance": p} for k, a, b, base, p in sorted(out)]


def find_personal_data(docs: DataFrame, carried: list[str], text_col: str = "text", to: str = "spans") -> DataFrame:
    """Columns `carried` of `docs` and the spans of each text as an array of (kind, start, end, base, chance);
    a base span's chance is 1. A carried column named `to` is replaced."""
    carried = [c for c in carried if c != to]
    found = staged(with_candidates(docs, text_col, "__candidates").select(*carried, "__candidates"), "candidates")
    model = trained(found, "__candidates")

    @F.pandas_udf("array<struct<kind: string, start: long, end: long, base: boolean, chance: double>>")
    def run(candidates: pd.Series) -> pd.Series:
        return pd.Series([_decided(list(spans), model, LEAST) for spans in candidates], dtype=object)

    return found.withColumn(to, run("__candidates")).drop("__candidates")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    base = F.filter("spans", lambda s: s["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, BASE_KINDS),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )
