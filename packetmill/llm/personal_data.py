"""Personal data by weak supervision: labelers vote on candidate spans, EM learns their reliability, a classifier decides.

Candidates are the base patterns' matches and broader ones. Regex, gazetteer and context labelers each vote for,
against or not at all. Spans with equal features are counted over the whole corpus before anything is
learned, so the counts, not the spans, reach the driver; their number is bounded by the feature values.
Expectation-maximisation estimates every labeler's reliability per kind and the posterior of each row of counts, and a
logistic span classifier is trained on the posteriors. Base matches always stay; the classifier adds spans.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import arrow_rows

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("ssn", "iban", "secret", "name", "local_phone", "access_key", "birth_date", "street", "person")
KINDS = BASE_KINDS + ADDED_KINDS
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT, _NUMBER, _DIGITS = re.compile(r"[0-9]"), re.compile(r"[0-9]+"), "0123456789"
# Given names, words that end or begin street names, and words that follow a greeting without being a name.
GIVEN = frozenset(
    "adam agnes alan albert alex alexander alice alicia amanda amy ana andrea andreas andrew angela anita anja anna anne annette anthony antonio barbara beatriz benjamin bernard bernd brian bruno camille carla carlos carmen "
    "carol caroline catherine charles charlotte christian christina christine christoph christopher claire claudia craig cristina daniel daniela david deborah denise dennis diana diego dieter dominique donald dorothy edward "
    "elena elizabeth emily emma eric erik esther eva felix fernando florian francesca francis francisco frank franz friedrich gabriel gabriele george gerald gerhard gloria gregory hannah hans heike heinz helen helga henri "
    "henry holger ignacio ines ingrid irene isabel jack jacques james jan jane javier jean jennifer jessica joan joachim johannes john jonas jorge jose joseph joshua juan judith julia julie karen karin karl katharina kevin "
    "klaus kurt larry laura lisa louis luca lucas luis luise manuel marc marco margaret maria marie mark markus martha martin mary matthew michael michel miguel monika nancy nicole nina olivier oscar pablo patricia paul pedro "
    "peter philippe pierre rachel ralf raul rebecca richard robert rosa ruth samuel sandra sarah sebastian sofia stefan stephen susan sylvie thomas ursula victor walter william wolfgang".split()
)
_GIVEN = "|".join(sorted(n.capitalize() for n in GIVEN))
_WAYS = "Street|St|Avenue|Ave|Road|Rd|Boulevard|Blvd|Lane|Ln|Drive|Court|Ct|Way|Place|Terrace|Square|Highway|Parkway"
_DATE = r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{4}|[0-9]{1,2}\.?\x20(?:de\x20)?[^\W\d_]{3,10}\x20(?:de\x20)?[0-9]{4}|[^\W\d_]{3,10}\x20[0-9]{1,2},?\x20[0-9]{4}"
COMMON = frozenset("street road park university college institute museum school hospital church foundation award prize day model method theorem algorithm airport station river county city island bridge".split())
_ADDED = (
    ("ssn", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("secret", re.compile(r"(?i)(?:password|passwd|secret|api[_-]?key|token)\s?[=:]\s?[\"']?([^\s,;\"']{6,})")),
    ("name", re.compile(r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.?\x20((?:[A-Z][^\W\d_]+\x20){0,2}[A-Z][^\W\d_]+)")),
    ("local_phone", re.compile(r"(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")),
    ("access_key", re.compile(r"(?<![A-Za-z0-9_-])(?:AKIA[0-9A-Z]{16}|gh[opsu]_[A-Za-z0-9]{30,}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})(?![A-Za-z0-9_])")),
    ("birth_date", re.compile(rf"(?i)(?<![a-z])(?:born(?:\x20on)?|birth|birthday|birthdate|d\.?o\.?b\.?|geboren(?:\x20am)?|geburtsdatum|née?\x20le|nacid[oa]\x20el|nacimiento|naissance)(?:\x20?:)?\x20({_DATE})(?![0-9])")),
    ("street", re.compile(rf"(?<![0-9A-Za-z.,-])(?:[0-9]{{1,5}}\x20(?:[NSEW]\.?\x20)?(?:[A-Z][^\W\d_]+\x20){{1,3}}(?:{_WAYS})(?![^\W\d_])|[A-ZÄÖÜ][^\W\d_]*(?:straße|strasse|gasse|allee|weg|platz)\x20[0-9]{{1,4}}[a-z]?(?![0-9A-Za-z])|[0-9]{{1,4}},?\x20(?:rue|avenue|boulevard|chemin|quai)(?:\x20(?:de|du|des|la|le|les))*(?:\x20[A-ZÉ][^\W\d_]+){{1,3}}|(?:Calle|Avenida|Plaza|Paseo)(?:\x20(?:de|del|la|las|los))*(?:\x20[A-ZÁÉÍÓÚ][^\W\d_]+){{1,3}},?\x20[0-9]{{1,4}}(?![0-9]))")),
    ("person", re.compile(rf"(?<![^\W\d_])(?:(?:{_GIVEN})(?:\x20[A-Z]\.)?(?:\x20(?:von|van|de|del|da|di))?\x20[A-Z][^\W\d_]+|(?<=my\x20name\x20is\x20)[A-Z][^\W\d_]+(?:\x20[A-Z][^\W\d_]+){{1,2}}|(?<=signed\x20by\x20)[A-Z][^\W\d_]+(?:\x20[A-Z][^\W\d_]+){{1,2}}|(?<=me\x20llamo\x20)[A-Z][^\W\d_]+(?:\x20[A-Z][^\W\d_]+){{1,2}}|(?<=ich\x20heiße\x20)[A-Z][^\W\d_]+(?:\x20[A-Z][^\W\d_]+){{1,2}}|(?<=je\x20m'appelle\x20)[A-Z][^\W\d_]+(?:\x20[A-Z][^\W\d_]+){{1,2}})")),
)
#: Every match of the pattern holds one of them; those that are folded, in the case-folded text.
_FOLDED_HINTS = {"secret": ("passw", "secret", "key", "token"), "birth_date": ("born", "rth", "dob", "d.ob", "do.b", "d.o.b", "geb", "né", "nac", "ssance")}
_HINTS = {"name": ("Mr", "Ms", "Dr", "Prof", "Herr", "Frau", "Mme", "Sr"), "access_key": ("AKIA", "gh", "k_live_", "k_test_", "xox", "AIza", "eyJ"),
    "street": (*(f"\x20{w}" for w in _WAYS.split("|")), "straße", "strasse", "gasse", "allee", "weg\x20", "platz\x20", "\x20rue\x20", "\x20avenue\x20", "\x20boulevard\x20", "\x20chemin\x20", "\x20quai\x20", "Calle\x20", "Avenida\x20", "Plaza\x20", "Paseo\x20"),
}
_INTRODUCED, _CAPITAL = ("my name is ", "signed by ", "me llamo ", "ich heiße ", "je m'appelle "), re.compile(r"[A-Z][a-z]+")
_FIRST = frozenset(n.capitalize() for n in GIVEN)
# Words that stand near such data, by kind, and gazetteers.
CONTEXT = {
    "email": ("mail", "email", "contact", "write", "reply", "from", "to", "correo", "kontakt", "courriel", "adresse"),
    "ip": ("ip", "host", "server", "address", "client", "login", "from", "gateway", "dns", "router", "servidor", "adresse"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "payment", "charge", "tarjeta", "karte", "carte", "kreditkarte"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "cell", "fax", "whatsapp", "telefon", "handy", "portable", "movil"),
    "local_phone": ("phone", "tel", "telephone", "call", "mobile", "cell", "fax", "whatsapp", "telefon", "handy", "portable", "movil"),
    "ssn": ("ssn", "social", "security", "taxpayer", "insurance", "number"),
    "iban": ("iban", "bank", "account", "transfer", "konto", "cuenta", "compte", "bic", "swift"),
    "secret": ("password", "passwd", "pwd", "secret", "key", "token", "login", "credential", "auth", "bearer", "config", "env", "export"),
    "access_key": ("key", "token", "aws", "secret", "bearer", "authorization", "credential", "export", "header", "jwt"),
    "birth_date": ("born", "birth", "birthday", "birthdate", "dob", "geboren", "geburtsdatum", "né", "née", "nacido", "nacida", "nacimiento", "naissance"),
    "street": ("address", "lives", "live", "at", "home", "ship", "deliver", "residence", "wohnt", "adresse", "wohnhaft", "domicilio", "vive", "habite", "dirección", "anschrift"),
    "person": ("dear", "signed", "by", "from", "is", "patient", "client", "customer", "contact", "mr", "mrs", "heiße", "appelle", "llamo", "employee", "applicant", "attn", "name", "sincerely", "regards", "kunde", "cliente"),
    "name": ("dear", "signed", "by", "from", "patient", "client", "customer", "lieber", "liebe", "cher", "estimado", "sincerely"),
}
AGAINST = ("version", "release", "isbn", "issn", "doi", "page", "pages", "figure", "table", "section", "chapter", "order", "ticket", "part", "model", "serial", "build")
TLDS = frozenset(
    "com org net edu gov mil int info biz name pro io ai app dev me tv cc co eu de at ch fr es it pt nl be lu uk ie us ca mx br ar cl pe ve uy ec bo py cu cr pa do gt "
    "dk se no fi is ee lv lt pl cz sk hu ro bg gr cy mt si hr rs ba mk al ua by ru tr il ae sa qa kw eg ma tn dz za ng ke gh in pk bd lk np cn hk tw jp kr sg my th vn id ph au nz".split()
)
#: Share of personal data that is taken for granted among candidates of a kind; without a vote a span is none.
BALANCE = 0.4
LABELERS = ("pattern", "checksum", "gazetteer", "context", "counter_context", "shape")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    base: bool


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of local part, @ and dotted domain; linear, since only the run before an @ can be a local part."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Base matches by start, then kind in the order of ``BASE_KINDS``; failing matches are dropped without retries."""
    out = [Span("email", a, b, True) for a, b in emails(text)]
    if _DIGIT.search(text):
        out += [Span("ip", m.start(), m.end(), True) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(Span("card", m.start(), m.end(), True))
        for m in _PHONE.finditer(text) if "+" in text else ():
            if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out.append(Span("phone", m.start(), m.end(), True))
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind)))


def _merged(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of the disjoint intervals that spans, by start, cover."""
    starts: list[int] = []
    ends: list[int] = []
    for s in spans:
        if ends and s.start < ends[-1]:
            ends[-1] = max(ends[-1], s.end)
        else:
            starts.append(s.start)
            ends.append(s.end)
    return starts, ends


def added_matches(text: str, gated: bool = True) -> Iterator[tuple[str, int, int]]:
    """Matches of the added patterns, one pattern after the other. The gate passes over patterns that cannot match."""
    digit, folded = bool(_DIGIT.search(text)), None
    for kind, pattern in _ADDED:
        if gated and kind in _FOLDED_HINTS:
            folded = text.casefold() if folded is None else folded
            if not any(h in folded for h in _FOLDED_HINTS[kind]) or not digit and kind == "birth_date":
                continue
        elif gated and kind in _HINTS:
            if not any(h in text for h in _HINTS[kind]) or not digit and kind == "street":
                continue
        elif gated and kind == "person":
            if _FIRST.isdisjoint(_CAPITAL.findall(text)) and not any(h in text for h in _INTRODUCED):
                continue
        elif gated and not digit:
            continue
        for m in pattern.finditer(text):
            yield kind, *(m.span(1) if pattern.groups else m.span())


def candidates(text: str, gated: bool = True) -> list[Span]:
    """Base matches, then matches of the added patterns that overlap none of them nor an earlier one."""
    out = base_spans(text)
    starts, ends = _merged(out)
    for kind, a, b in added_matches(text, gated):
        k = bisect_left(starts, b)
        if k and ends[k - 1] > a:
            continue
        starts.insert(k, a)
        ends.insert(k, b)
        out.append(Span(kind, a, b, False))
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def votes(text: str, span: Span) -> tuple[int, ...]:
    """For (1), against (-1) or no vote (0) of every labeler."""
    value = text[span.start : span.end]
    before = set(re.findall(r"[^\W\d_]+", text[max(0, span.start - 40) : span.start].lower())[-4:])
    digits = "".join(c for c in value if "0" <= c <= "9")
    pattern = 1 if span.base else 0
    checksum = {"card": 1 if luhn(digits or "1") else -1}.get(span.kind, 0)
    if span.kind == "iban":
        moved = (value[4:] + value[:4]).replace(" ", "")
        checksum = 1 if int("".join(str(int(c, 36)) for c in moved)) % 97 == 1 else -1
    if span.kind == "ssn":
        checksum = -1 if value[:3] in ("000", "666") or value[0] == "9" or value[4:6] == "00" or value[7:] == "0000" else 1
    gazetteer = 0
    if span.kind == "email":
        gazetteer = 1 if value.rpartition(".")[2].lower() in TLDS else -1
    if span.kind == "name":
        gazetteer = 1 if value.split()[0].lower() in GIVEN else 0
    context = 1 if before.intersection(CONTEXT[span.kind]) else 0
    counter = -1 if before.intersection(AGAINST) else 0
    if span.kind == "person":
        gazetteer = -1 if value.split()[-1].lower() in COMMON else int(value.split()[0].lower() in GIVEN)
    if span.kind == "street":
        gazetteer = 1 if len(value.split()[-1]) > 3 or value[-1] in _DIGITS else 0
    if span.kind == "birth_date":
        numbers = [int(x) for x in _NUMBER.findall(value)]
        year, rest = max(numbers), sorted(numbers)[:-1]
        checksum = 1 if 1880 <= year <= 2100 and rest and 1 <= rest[0] <= (12 if len(rest) > 1 else 31) and rest[-1] <= 31 else -1
    if span.kind == "access_key":
        checksum = 1 if len(set(value)) > 6 else -1
    shape = 0
    if span.kind in ("street", "person", "access_key", "birth_date"):
        shape = 1
    elif span.kind == "secret":
        shape = 1 if digits and len(value) >= 8 else -1
    elif len(set(digits)) <= 1 and digits:
        shape = -1
    elif span.kind in ("phone", "local_phone", "card"):
        shape = 1
    return pattern, checksum, gazetteer, context, counter, shape


def features(text: str, span: Span) -> str:
    """What the classifier sees, as text with few values: kind, votes, length and digit share in steps, neighbours."""
    value = text[span.start : span.end]
    share = sum("0" <= c <= "9" for c in value) * 4 // len(value)
    left = text[span.start - 1] if span.start else " "
    right = text[span.end] if span.end < len(text) else " "
    return "|".join([span.kind, ",".join(map(str, votes(text, span))), str(min(len(value).bit_length(), 6)), str(share), str(int(left.isalnum())), str(int(right.isalnum()))])


def vector(feature: str) -> np.ndarray:
    kind, vote, length, share, left, right = feature.split("|")
    v = [int(x) for x in vote.split(",")]
    return np.array([1.0, *(kind == k for k in KINDS), *(x > 0 for x in v), *(x < 0 for x in v), int(length) / 6, int(share) / 4, int(left), int(right)], float)


def posteriors(kinds: list[str], vote: np.ndarray, weight: np.ndarray, rounds: int = 30, balance: float = BALANCE) -> np.ndarray:
    """EM over labelers of unknown reliability: P(span is personal data) of each row. Votes are trusted at 0.8, and the data weigh as much as that trust.

    A labeler that votes alike on all spans of a kind tells none of them from another and counts only where no labeler does. The
    share of personal data among candidates is given: learned along, it would drown labelers that stand alone on their spans.
    """
    out = np.full(len(kinds), 0.5)
    for kind in sorted(set(kinds)):
        at = np.array([k == kind for k in kinds])
        v, w = vote[at], weight[at]
        if (varying := (v != v[0]).any(axis=0)).any():
            v = v[:, varying]
        right = np.full(v.shape[1], 0.8)
        for _ in range(rounds):
            right = np.clip(right, 0.55, 0.98)
            odds = np.log(balance / (1 - balance)) + (v * np.log(right / (1 - right))).sum(axis=1)
            p = 1 / (1 + np.exp(-odds))
            agree = (w[:, None] * ((v > 0) * p[:, None] + (v < 0) * (1 - p)[:, None])).sum(axis=0)
            n = (w[:, None] * (v != 0)).sum(axis=0)
            right = (agree + 0.8 * (n + 10)) / (2 * n + 10)
        out[at] = p
    return out


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 400) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by gradient descent; rows count by the logarithm of their number."""
    w, weight = np.zeros(x.shape[1]), np.log1p(weight) / np.log1p(weight).sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        w -= 2.0 * (x.T @ (weight * (p - y)) + 1e-3 * w)
    return w


def fit(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Weights of the span classifier, from feature counts over all candidate spans of all documents."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}
        for batch in arrow_rows(batches, 1024):
            for text in batch.column("text").to_pylist():
                for span in candidates(text or ""):
                    f = features(text, span)
                    seen[f] = seen.get(f, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["feature", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas().sort_values("feature")
    return weights_of(dict(zip(rows["feature"], rows["n"], strict=True)))


def weights_of(counts: dict[str, int]) -> np.ndarray:
    """Weights of the span classifier from counts by feature: EM for the posterior of each, then regression on them; zeros without any."""
    if not counts:
        return np.zeros(len(vector("name|0,0,0,0,0,0|0|0|0|0")))
    names = list(counts)
    vote = np.array([[int(x) for x in f.split("|")[1].split(",")] for f in names])
    weight = np.array([counts[f] for f in names], float)
    p = posteriors([f.split("|")[0] for f in names], vote, weight)
    return train(np.array([vector(f) for f in names]), p, weight)


def decided(text: str, weights: np.ndarray) -> list[Span]:
    """Base matches and the added spans that the classifier takes for personal data."""
    return [s for s in candidates(text) if s.base or vector(features(text, s)) @ weights >= 0]


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", weights: np.ndarray | None = None) -> DataFrame:
    """One row per input row: id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans (of all kinds).

    Whole texts are searched; positions are code points, ends exclusive; lists are ordered by start, then kind. Null and
    empty texts have no spans. Repeated rows, null ids and extra columns are harmless; no rows give no rows. Without
    ``weights`` they are learned from ``docs`` first.
    """
    learned = fit(docs, text_col) if weights is None else weights
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, 1024):
            spans = [decided(t or "", learned) for t in batch.column("text").to_pylist()]
            counts = [pa.array([sum(s.kind == k for s in row) for row in spans], pa.int64()) for k in BASE_KINDS]
            digest = pa.array([hashlib.sha256(_listed([s for s in row if s.base]).encode()).hexdigest() for row in spans], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), *counts, digest, pa.array([_listed(r) for r in spans], pa.string()), pa.array([len(r) for r in spans], pa.int64())], ["id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "n_spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long").withColumnRenamed("id", id_col)


def mask(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans the union is replaced once."""
    out, done = [], 0
    for s in spans:
        if s.start >= done:
            out += [text[done : s.start], f"[{s.kind.upper()}]"]
        done = max(done, s.end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, *, text_col: str = "text", length_col: str | None = "n_chars", weights: np.ndarray | None = None) -> DataFrame:
    """The same rows and columns with personal data masked; ``length_col``, if there, gets the new length. Null texts stay null."""
    learned = fit(docs, text_col) if weights is None else weights

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, 1024):
            at = batch.schema.get_field_index("__text")
            texts = [None if t is None else mask(t, decided(t, learned)) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, "__text", pa.array(texts, pa.string()))

    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    place = docs.columns.index(text_col)
    schema = T.StructType([T.StructField("__text" if i == place else n, f.dataType) for i, (n, f) in enumerate(zip(names, docs.schema, strict=True))])
    out = plain.withColumnRenamed(names[place], "__text").mapInArrow(run, schema)
    if length_col in docs.columns:
        k = docs.columns.index(length_col)
        out = out.withColumn(names[k], F.coalesce(F.length("__text").cast(docs.schema[length_col].dataType), F.col(names[k])))
    return out.toDF(*docs.columns)
