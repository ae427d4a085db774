"""Personal data in texts: e-mail and network addresses, card and phone numbers.

Method: weak supervision. Candidates are the matches of four base patterns, valid or not, and of
narrower or looser layouts (a number inside a longer row of digits, spelled-out addresses,
national phone numbers). LABELERS vote on each candidate: yes, no or nothing. Some check the
form, some look values up in gazetteers, some read the context. Votes are counted by
(kind, votes) over all documents; expectation-maximisation on these counts finds how
reliable each labeler is for each kind, and how probable each pattern of votes makes personal
data. With these probabilities as labels a logistic classifier is trained for each kind
on what the span looks like (SHAPES hashed shapes, length, neighbouring characters, cue words,
check digit, first or last part). It decides on all candidates that are no valid base match; those it
takes are added unless they overlap a span found before. Valid base matches always stay.

Texts are read once. Candidates are written with their votes and looks as two numbers; their counts
are at most KINDS * 3^LABELERS and KINDS * LOOKS rows, whatever the corpus, and are the only
thing that reaches the driver.

Defined results: a null text is empty and has no spans; equal rows get equal results; spans are
[start, end) in code points; of added candidates that overlap the longest stays, then the earlier
one, then the kind listed first; without any candidate nothing is trained; an empty table
gives an empty table; columns other than doc_id and text are not read. Candidates of one text
are held together; the time for a text follows its length, also for long runs of one character.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import words as w
from tarmac.llm.store import Scratch

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
MIN_PROBABILITY = 0.5

# --- fixed values ---------------------------------------------------------------------------
TOP_DOMAINS = frozenset(
    "com org net edu gov mil int info biz io ai app dev co me tv eu uk us ca au nz ie in jp cn kr br mx ar cl pe ve es pt fr be nl lu de at ch it "
    "se no dk fi is pl cz sk hu ro bg gr tr ru ua za ng ke eg ma il sa ae sg hk tw th vn id my ph".split()
)
#: First digits of payment card numbers, as ranges of their first four.
ISSUERS = ((2221, 2720), (3000, 3059), (3400, 3499), (3528, 3589), (3600, 3699), (3700, 3799), (3800, 3999), (4000, 4999), (5100, 5599), (6011, 6011), (6221, 6229), (6440, 6599))
CALLING_CODES = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 "
    "211 212 213 216 218 220 221 234 251 254 255 256 260 263 350 351 352 353 354 355 356 357 358 359 370 371 372 373 374 375 380 381 385 386 387 389 "
    "420 421 423 852 853 855 880 886 960 961 962 963 964 965 966 967 968 971 972 973 974 975 976 977 992 993 994 995 996 998".split()
)
#: Networks that name no person's machine, by first and second number.
RESERVED = ((0, None), (10, None), (127, None), (169, 254), (172, 16), (192, 168), (224, None), (239, None), (255, None))
YES_CUES: tuple[frozenset[str], ...] = (
    frozenset("mail email e-mail contact contacto kontakt correo courriel write an from to".split()),
    frozenset("ip address host server client peer login adresse dirección".split()),
    frozenset("card visa mastercard amex credit debit payment karte carte tarjeta cc".split()),
    frozenset("tel phone call mobile cell fax telefon handy téléphone teléfono móvil".split()),
)
NO_CUES = frozenset("version v release build section chapter id token password secret key hash sha isbn issn serial order invoice sku uuid doi page pages".split())
# ---------------------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_QUADS = re.compile(r"[0-9]++(?:\.[0-9]++\.[0-9]++\.[0-9]++)?")  # takes whole rows of digits, so no row is read twice
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_CALLS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Rows of characters that the further layouts are made of; these are looked for there alone.
_NUMERIC = re.compile(r"[0-9+(][0-9 ().+-]{8,}")
_LAYOUTS = (
    (CARD, re.compile(r"(?<![0-9])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])")),
    (CARD, re.compile(r"(?<![0-9])3[47][0-9]{2}([ -]?)[0-9]{6}\1[0-9]{5}(?![0-9])")),
    (CARD, re.compile(r"(?<![0-9])[0-9]{13,19}(?![0-9])")),
    (PHONE, re.compile(r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-][0-9]{4}(?![0-9])")),
    (PHONE, re.compile(r"(?<![0-9+])\([0-9]{2,4}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])")),
    (PHONE, re.compile(r"(?<![0-9.+-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9.-])")),
    (PHONE, re.compile(r"(?<![0-9])00[1-9][0-9]{8,12}(?![0-9])")),
)
_GROUPS = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])")
_SPELLED = re.compile(r"[\[({] ?(?:at|AT) ?[\])}]")
_SPELLED_DOMAIN = re.compile(r" ?[A-Za-z0-9-]{1,63}(?:(?: ?[\[({] ?(?:dot|DOT) ?[\])}] ?|\.)[A-Za-z0-9-]{1,63}){1,8}")
_NUMBER = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


def passes_luhn(digits: str) -> bool:
    values = [int(d) for d in digits[::-1]]
    return (sum(values[::2]) + sum(sum(divmod(2 * d, 10)) for d in values[1::2])) % 10 == 0


def _local_start(text: str, at: int, least: int) -> int:
    while at > least and text[at - 1] in _LOCAL:
        at -= 1
    return at


def base_matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, end, valid) of the leftmost matches of the four base patterns, by kind and start."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain and (start := _local_start(text, at, done)) < at:
            done = domain.end()
            yield EMAIL, start, done, True
            at = text.find("@", done)
        else:
            done = at + 1
            at = text.find("@", at + 1)
    for m in _QUADS.finditer(text):
        if "." in m[0]:
            parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
            yield IP, *m.span(), all(len(p) <= 3 and int(p) <= 255 for p in parts)
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 13:
            digits = re.sub("[ -]", "", m[0]) if m.end() - m.start() < 40 else ""
            if 13 <= len(digits):
                yield CARD, *m.span(), len(digits) <= 19 and passes_luhn(digits)
    for m in _CALLS.finditer(text):
        yield PHONE, *m.span(), 9 <= sum(map(str.isdigit, m[0])) <= 15


def candidates(text: str) -> dict[tuple[int, int, int], bool]:
    """Every candidate (kind, start, end) of a text, and whether it is a valid base match."""
    found: dict[tuple[int, int, int], bool] = {}
    if "@" not in text and not _NUMBER.search(text) and not _SPELLED.search(text):
        return found
    for kind, start, end, valid in base_matches(text):
        found[kind, start, end] = valid
    for row in _NUMERIC.finditer(text):
        for kind, layout in _LAYOUTS:
            for m in layout.finditer(text, *row.span()):
                found.setdefault((kind, *m.span()), False)
    if text.count(":") >= 7:
        for m in _GROUPS.finditer(text):
            found.setdefault((IP, *m.span()), False)
    done = 0
    for m in _SPELLED.finditer(text):
        domain, stop = _SPELLED_DOMAIN.match(text, m.end()), m.start() - (text[m.start() - 1 : m.start()] == " ")
        if domain and (start := _local_start(text, stop, max(done, stop - 64))) < stop:
            done = domain.end()
            found.setdefault((EMAIL, start, done), False)
    return found


@dataclass
class Span:
    """A candidate with what labelers and classifier look at."""

    kind: int
    text: str
    before: str
    after: str

    def __post_init__(self) -> None:
        self.digits = "".join(c for c in self.text if "0" <= c <= "9")
        self.cues = {x.lower() for x in _WORD.findall(self.before)[-3:]}


def _yes(true: bool) -> int:
    return 1 if true else -1


def _form(s: Span) -> int:
    if s.kind == EMAIL:
        labels = re.split(r"@|\.|[\[({] ?(?:dot|DOT|at|AT) ?[\])}]", s.text)[1:]
        return _yes(all(x.strip() and x.strip()[0] != "-" != x.strip()[-1] for x in labels) and labels[-1].strip().isalpha())
    if s.kind == IP:
        return _yes(":" in s.text or all(len(p) < 4 and int(p) <= 255 and str(int(p)) == p for p in s.text.split(".")))
    if s.kind == CARD:
        return _yes(len(s.digits) <= 19 and passes_luhn(s.digits))
    return _yes(9 <= len(s.digits) <= 15)


def _layout(s: Span) -> int:
    if s.kind == EMAIL:
        return _yes(s.text[0].isalnum() and ".." not in s.text)
    if s.kind == IP:
        return _yes(s.before[-1:] != "." and s.after[:1] != "." or s.after[1:2].isspace())
    if s.kind == CARD:
        return _yes([len(p) for p in re.split("[ -]", s.text)] in ([4, 4, 4, 4], [4, 6, 5], [13], [14], [15], [16], [19]))
    balanced = s.text.count("(") == s.text.count(")") <= 1
    groups = re.findall("[0-9]+", s.text)
    return _yes(balanced and len(groups) <= 5 and (len(groups) == 1 or max(map(len, groups)) <= 10) and not re.search(r"[ ().-]{3}", s.text))


def _gazetteer(s: Span) -> int:
    if s.kind == EMAIL:
        return _yes(re.split(r"[^A-Za-z0-9-]+", s.text)[-1].lower() in TOP_DOMAINS)
    if s.kind == IP:
        first = s.text.split(".")[:2]
        return 0 if ":" in s.text or any(len(p) > 3 for p in first) else -1 if any(int(first[0]) == a and b in (None, int(first[1])) for a, b in RESERVED) else 1
    if s.kind == CARD:
        return _yes(any(a <= int(s.digits[:4]) <= b for a, b in ISSUERS))
    number = s.digits if s.text[0] == "+" else s.digits[2:] if s.digits.startswith("00") else ""
    return _yes(any(number[:n] in CALLING_CODES for n in (1, 2, 3))) if number else 0


def _cue(s: Span) -> int:
    return 1 if s.cues & YES_CUES[s.kind] else -1 if s.cues & NO_CUES else 0


def _boundary(s: Span) -> int:
    left, right = s.before[-1:], s.after[:1]
    return _yes(not (left.isalnum() or right.isalnum() or left in tuple("=_/@\\") or right in tuple("=_/@\\")))


def _variety(s: Span) -> int:
    return 0 if s.kind == EMAIL or len(set(s.digits)) > 2 else -1


LABELERS: tuple[Callable[[Span], int], ...] = (_form, _layout, _gazetteer, _cue, _boundary, _variety)

#: P(vote on form | truth) where form is arithmetic: a check digit is right by chance once in ten, a number has 9 to 15 digits
#: and an address parts up to 255 by chance more often, and what is real breaks these rules by a slip alone. Votes by
#: themselves cannot tell which labelers to trust where most candidates are real, so each counts as much as all candidates.
CHECK_DIGIT = np.array([[0.88, 0.02, 0.10], [0.02, 0.02, 0.96]])
COUNTED = np.array([[0.48, 0.02, 0.50], [0.02, 0.02, 0.96]])
#: By kind, labelers whose reliability is known beforehand.
KNOWN = {CARD: {LABELERS.index(_form): CHECK_DIGIT}, PHONE: {LABELERS.index(_form): COUNTED}, IP: {LABELERS.index(_form): COUNTED}}

SHAPES, LENGTHS, SIDES = 32, 4, 6
#: Sizes of the classifier's categories: shape, length, character before and after, cue words, form, gazetteer.
CATEGORIES = (SHAPES, LENGTHS, SIDES, SIDES, 3, 3, 3)
LOOKS = int(np.prod(CATEGORIES))


def _side(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4 if c in ".,;:!?()" else 5


def look(s: Span) -> int:
    """The classifier's categories as one number."""
    shape = re.sub(r"[^\W\d_]+", "a", re.sub("[0-9]+", lambda m: f"{min(len(m[0]), 20)}d", s.text))
    where = (zlib.crc32(shape.encode()) % SHAPES, min(len(s.text) // 8, LENGTHS - 1), _side(s.before[-1:]), _side(s.after[:1]), *(f(s) + 1 for f in (_cue, _form, _gazetteer)))
    return int(np.ravel_multi_index(where, CATEGORIES))


def vote(s: Span) -> int:
    """The labelers' votes as one number, three values each."""
    code = 0
    for labeler in LABELERS:
        code = 3 * code + labeler(s) + 1
    return code


def votes(code: np.ndarray) -> np.ndarray:
    """Votes by row and labeler: 0 no, 1 nothing, 2 yes."""
    return np.stack([code // 3 ** (len(LABELERS) - 1 - i) % 3 for i in range(len(LABELERS))], 1)


CANDIDATE = "struct<kind: int, start: int, end: int, base: boolean, votes: int, look: int>"


def candidate_table(docs: DataFrame) -> DataFrame:
    """doc_id and found, the candidates of every row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ends = [], [0]
            for text in batch["text"]:
                text = text.as_py() or ""
                for (kind, start, end), base in sorted(candidates(text).items()):
                    s = Span(kind, text[start:end], text[max(start - 40, 0) : start], text[end : end + 2])
                    rows.append((kind, start, end, base, vote(s), look(s)))
                ends.append(len(rows))
            columns = list(zip(*rows)) or [()] * 6
            names = ["kind", "start", "end", "base", "votes", "look"]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.int32()]
            spans = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)], names=["doc_id", "found"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(w.tidy(run), f"doc_id long, found array<{CANDIDATE}>")


#: What the labelers' reliabilities start from, as so many candidates: an honest labeler votes for the truth.
_PRIOR = np.array([[4.0, 2.0, 1.0], [1.0, 2.0, 4.0]])


def reliabilities(patterns: np.ndarray, counts: np.ndarray, known: dict[int, np.ndarray] | None = None, rounds: int = 50) -> tuple[float, np.ndarray]:
    """(share of personal data, P(vote | truth) by labeler, truth and vote) from counted patterns of votes.

    known has by labeler a table that counts as much as all candidates.
    """
    seen = np.eye(3)[patterns]  # pattern, labeler, vote
    prior = np.repeat(_PRIOR[None], patterns.shape[1], 0)
    for i, rates in (known or {}).items():
        prior[i] += counts.sum() / 2 * rates
    believed = 1 / (1 + np.exp(-(patterns.sum(1) - patterns.shape[1])))  # to begin with, the majority's
    for _ in range(rounds):
        mass = np.stack([counts * (1 - believed), counts * believed])
        table = np.einsum("yp,plv->lyv", mass, seen) + prior
        table /= table.sum(2, keepdims=True)
        share = (mass[1].sum() + 1) / (counts.sum() + 2)
        believed = posterior(patterns, share, table)
    return share, table


def posterior(patterns: np.ndarray, share: float, table: np.ndarray) -> np.ndarray:
    """How probable each pattern of votes makes personal data."""
    logs = np.log(table)
    odds = np.log(share / (1 - share)) + sum(logs[i, 1, patterns[:, i]] - logs[i, 0, patterns[:, i]] for i in range(patterns.shape[1]))
    return 1 / (1 + np.exp(-odds))


def _columns(looks: np.ndarray) -> np.ndarray:
    """By row the columns of a design matrix that are 1: one for each category, and one for all rows."""
    parts = np.stack(np.unravel_index(looks, CATEGORIES), 1) + np.concatenate(([0], np.cumsum(CATEGORIES)[:-1]))
    return np.concatenate((parts, np.full((len(looks), 1), sum(CATEGORIES))), 1)


def classifier(looks: np.ndarray, counts: np.ndarray, believed: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic regression on counted looks and their probabilities, by Newton's method."""
    n = sum(CATEGORIES) + 1
    ones = np.zeros((len(looks), n))
    np.put_along_axis(ones, _columns(looks), 1.0, 1)
    weights = np.zeros(n)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(ones @ weights)))
        slope = ones.T @ (counts * (believed - p)) - ridge * weights
        curve = (ones * (counts * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ ones + ridge * np.eye(n)
        step = np.linalg.solve(curve, slope)
        weights += step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-9:
            break
    return weights


def probability(looks: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-weights[_columns(looks)].sum(1)))


def train(counted: DataFrame) -> dict[int, np.ndarray]:
    """Weights by kind from (kind, votes, look, n); kinds without a candidate have none."""
    by_votes = counted.groupBy("kind", "votes").agg(F.sum("n").alias("n")).orderBy("kind", "votes").toArrow()  # 4 * 3^6 rows at most
    kind, code, n = (by_votes[c].to_numpy() for c in ("kind", "votes", "n"))
    believed: dict[tuple[int, int], float] = {}
    for k in np.unique(kind).tolist():
        own = kind == k
        patterns = votes(code[own])
        share, table = reliabilities(patterns, n[own].astype(float), KNOWN.get(k))
        believed |= {(k, int(c)): float(p) for c, p in zip(code[own], posterior(patterns, share, table))}
    spark = counted.sparkSession
    beliefs = spark.createDataFrame([(*key, p) for key, p in believed.items()], "kind int, votes int, p double") if believed else None
    if beliefs is None:
        return {}
    looks = counted.join(F.broadcast(beliefs), ["kind", "votes"]).groupBy("kind", "look")  # the broadcast has 4 * 3^6 rows at most
    looks = looks.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("p")).alias("mass")).orderBy("kind", "look").toArrow()  # 4 * LOOKS at most
    kind, code, n, mass = (looks[c].to_numpy() for c in ("kind", "look", "n", "mass"))
    out = {}
    for k in np.unique(kind).tolist():
        own = kind == k
        out[k] = classifier(code[own], n[own].astype(float), mass[own] / n[own])
    return out


class Taken:
    """Stretches that are taken, as sorted ones that do not overlap."""

    def __init__(self, spans: list[tuple[int, int]]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def add(self, start: int, end: int) -> bool:
        """Takes a stretch if it overlaps none."""
        at = bisect_right(self.starts, start)
        if (at and self.ends[at - 1] > start) or (at < len(self.starts) and self.starts[at] < end):
            return False
        self.starts.insert(at, start)
        self.ends.insert(at, end)
        return True


def chosen(found: list[dict], score: Callable[[int, int], float]) -> list[tuple[str, int, int, bool, float]]:
    """The spans among a text's candidates, by kind and start: all valid base matches, and added ones that overlap nothing.

    score gives the classifier's probability of a kind and look.
    """
    spans = [(c["kind"], c["start"], c["end"], c["base"], score(c["kind"], c["look"])) for c in found]
    kept = [s for s in spans if s[3]]
    taken = Taken([s[1:3] for s in kept])
    more = [s for s in spans if not s[3] and s[4] >= MIN_PROBABILITY]
    for s in sorted(more, key=lambda s: (s[1] - s[2], s[1], s[0])):
        if taken.add(s[1], s[2]):
            kept.append(s)
    return [(KINDS[kind], *rest) for kind, *rest in sorted(kept)]


SPANS = "array<struct<kind: string, start: long, end: long, base: boolean, score: double>>"


def find_personal(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, end, base, score) for every row of docs, by kind as in KINDS, then start."""
    found = Scratch(docs.sparkSession).save(candidate_table(docs), "candidates")
    each = found.select(F.explode("found").alias("c")).select("c.kind", "c.votes", "c.look")
    weights = train(each.groupBy("kind", "votes", "look").agg(F.count("*").alias("n")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, int], float] = {}  # at most 4 * LOOKS

        def score(kind: int, look: int) -> float:
            if (kind, look) not in known:
                known[kind, look] = float(probability(np.array([look]), weights[kind])[0])
            return known[kind, look]

        names = ["kind", "start", "end", "base", "score"]
        for batch in batches:
            spans = [[dict(zip(names, s)) for s in chosen(row.as_py(), score)] for row in batch["found"]]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(spans, kind)], names=["doc_id", "spans"])

    return found.mapInArrow(w.tidy(run), f"doc_id long, spans {SPANS}")


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the union goes, under the first one's kind."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join((*out, text[at:]))
