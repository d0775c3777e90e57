"""Personal data by weak supervision.

Base spans come from fixed patterns. Looser patterns propose further candidates. On every candidate,
base or not, labelers vote yes, no or nothing: patterns, checks of form, gazetteers and the context.
Spark counts how often each combination of votes and features occurs (a bounded table). From these
counts expectation-maximisation estimates, kind by kind, how reliable each labeler is and how likely
each combination is personal data; these soft labels train the final classifier, a logistic
regression over votes and features, which accepts or refuses the candidates that are not base spans.
"""

import bisect
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joined_sha, per_text, small_batches, written

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "form", "gazetteer", "context", "edges", "shape")
FEATURES = ("separated", "long", "line_start")
# Votes take a base-3 digit each, features a bit each: so many combinations at most per kind.
COMBINATIONS = 3 ** len(LABELERS) * 2 ** len(FEATURES)
ACCEPT = 0.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3,}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){11,}")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_LOOSE = (
    ("email", re.compile(
        r"[A-Za-z0-9._%+-]{1,64} ?(?:@|[\[({] ?at ?[\])}]) ?[A-Za-z0-9-]{1,63}"
        r"(?: ?(?:\.|[\[({] ?dot ?[\])}]) ?[A-Za-z0-9-]{2,63}){1,5}", re.I)),
    ("ip", re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{4}(?:[./_][0-9]{4}){3}(?![0-9])")),
    ("phone", re.compile(
        r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
        r"|(?<![0-9A-Za-z+.-])00[1-9][0-9]?(?:[ .-]?[0-9]{2,4}){3,4}(?![0-9A-Za-z])")),
)

# Gazetteers.
COMMON_ENDINGS = frozenset(
    "com org net edu gov int info biz io co uk de fr es it nl eu us ca au in jp cn br ru ch at se".split()
)
CONTEXT_FOR = {
    "email": "mail contact write address reach correo courriel kontakt",
    "ip": "ip address host server client addr login adresse",
    "card": "card visa mastercard amex credit debit pay karte carte tarjeta",
    "phone": "phone tel call mobile fax contact cell telefon telefono appelez",
}
CONTEXT_AGAINST = "version isbn issn order invoice serial build release section figure sku part doi".split()
_WORD = re.compile(r"\w+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _emails(text: str):
    done = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            done = domain.end()
            yield begin, done
        at = text.find("@", max(at + 1, done))


def _ips(text: str):
    for chunk in _DOTTED.finditer(text):
        begin, parts = chunk.start(), chunk.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = begin + sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in four):
                yield begin, end
            begin = end + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), by start, then kind."""
    out = []
    if "@" in text:
        out += [(b, 0, e) for b, e in _emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            out += [(b, 1, e) for b, e in _ips(text)]
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def loose_spans(text: str, taken: list) -> list[tuple[int, int, int]]:
    """Further candidates that touch no base span and not each other."""
    out, has_digit = [], _DIGIT.search(text)
    # Base spans may overlap: of those that start before a place, how far the furthest reaches.
    starts = sorted(b for b, _, _ in taken)
    reach = [0, *itertools.accumulate((e for _, _, e in sorted(taken)), max)]
    mine: list[tuple[int, int]] = []  # disjoint, in order
    for kind, pattern in _LOOSE:
        number = KINDS.index(kind)
        if number == 0 and "dot" not in text and "@" not in text and "DOT" not in text:
            continue
        if number and not has_digit:
            continue
        if number == 1 and text.count(":") < 7:
            continue
        for m in pattern.finditer(text):
            begin, end = m.span()
            at = bisect.bisect_left(mine, (end,))
            free = reach[bisect.bisect_left(starts, end)] <= begin
            if free and (at == 0 or mine[at - 1][1] <= begin):
                out.append((begin, number, end))
                mine.insert(at, (begin, end))
    return out


def _issuer(d: str) -> bool:
    return (
        d[0] == "4" and len(d) in (13, 16, 19)
        or len(d) == 16 and ("51" <= d[:2] <= "55" or "2221" <= d[:4] <= "2720")
        or len(d) == 15 and d[:2] in ("34", "37")
        or len(d) == 16 and (d[:4] == "6011" or d[:2] == "65")
    )


def votes(text: str, start: int, kind: int, end: int, base: bool) -> int:
    """The combination of a candidate: its labelers' votes (0 none, 1 yes, 2 no) and features."""
    span = text[start:end]
    digits = "".join(c for c in span if "0" <= c <= "9")
    ending = re.split(r"[^A-Za-z0-9-]+", span.strip(")]} "))[-1].lower()
    if kind == 0:
        form = 1 if ending.isalpha() and 2 <= len(ending) <= 12 else 2
        gazetteer = 1 if ending in COMMON_ENDINGS else 0
        shape = 2 if ".." in span or len(span) > 120 else 1
    elif kind == 1:
        parts = span.split(".")
        form = 1 if ":" in span or all(x == "0" or x[0] != "0" for x in parts) else 2
        gazetteer = 2 if digits == "" or parts[0] in ("0", "127", "255") else 1
        shape = 2 if len(set(digits)) == 1 else 0
    elif kind == 2:
        form = 1 if luhn(digits) else 2
        gazetteer = 1 if digits and _issuer(digits) else 2
        shape = 2 if len(set(digits)) < 3 else 0
    else:
        form = 1 if 10 <= len(digits) <= 14 else 2
        area = digits[-10:-7]
        gazetteer = 1 if span[0] == "+" or digits[:2] == "00" else 2 if area[:1] in "01" else 1
        shape = 2 if len(set(digits)) < 3 else 0
    near = {w.lower() for w in _WORD.findall(text[max(0, start - 32) : start])}
    context = (
        1 if near & set(CONTEXT_FOR[KINDS[kind]].split()) else 2 if near & set(CONTEXT_AGAINST) else 0
    )
    around = text[max(0, start - 1) : start] + text[end : end + 1]
    edges = 2 if any(c.isalnum() or c in "_@/" for c in around) else 1
    code = 0
    for vote in (1 if base else 0, form, gazetteer, context, edges, shape):
        code = code * 3 + vote
    for feature in (
        any(c in " ()-" for c in span),
        len(span) > 24,
        start == 0 or text[start - 1] == "\n",
    ):
        code = code * 2 + bool(feature)
    return code


_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int8()), ("end", pa.int32()), ("code", pa.int32())])
FOUND = "base array<struct<start:int,kind:byte,end:int,code:int>>, more array<struct<start:int,kind:byte,end:int,code:int>>"


def candidates(texts: pa.Array):
    base, more = [], []
    for value in texts:
        text = value.as_py()
        found = base_spans(text)
        loose = loose_spans(text, found)
        base.append([(b, k, e, votes(text, b, k, e, True)) for b, k, e in found])
        more.append([(b, k, e, votes(text, b, k, e, False)) for b, k, e in sorted(loose)])
    names = ("start", "kind", "end", "code")
    return [
        pa.array([[dict(zip(names, x, strict=True)) for x in row] for row in rows], pa.list_(_SPAN))
        for rows in (base, more)
    ]


def unpacked(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Votes [n, labelers] and features [n, features] of combinations."""
    features = codes[:, None] >> np.arange(len(FEATURES))[::-1] & 1
    packed = codes >> len(FEATURES)
    return packed[:, None] // 3 ** np.arange(len(LABELERS))[::-1] % 3, features


def reliabilities(votes_: np.ndarray, counts: np.ndarray, rounds: int = 60):
    """EM over counted vote combinations: chance of each being true, and P(vote | truth) as
    [truth, labeler, vote]."""
    yes, no = (votes_ == 1).sum(axis=1), (votes_ == 2).sum(axis=1)
    truth = (yes + 0.5) / (yes + no + 1.0)
    one_hot = np.stack([votes_ == v for v in range(3)], axis=2).astype(float)
    for _ in range(rounds):
        table = []
        for weight in ((1 - truth) * counts, truth * counts):
            seen = np.einsum("n,nlv->lv", weight, one_hot) + 1.0
            table.append(seen / seen.sum(axis=1, keepdims=True))
        table = np.stack(table)
        prior = (truth @ counts + 1) / (counts.sum() + 2)
        logs = np.einsum("nlv,tlv->nt", one_hot, np.log(table)) + np.log([1 - prior, prior])
        truth = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))
    return truth, table


def classifier(x: np.ndarray, soft: np.ndarray, counts: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Weights of a logistic regression on soft labels (gradient steps, ridge)."""
    share = counts / counts.sum()
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ w))
        w -= 1.0 * (x.T @ (share * (p - soft)) + 1e-3 * w)
    return w


def accepted(found: DataFrame) -> list[int]:
    """kind * COMBINATIONS + code of every combination the classifier accepts.

    The counts gathered are at most len(KINDS) * COMBINATIONS rows.
    """
    both = found.select(F.explode(F.concat("base", "more")).alias("x"))
    rows = both.groupBy("x.kind", "x.code").agg(F.count(F.lit(1)).alias("n")).collect()
    out = []
    for kind in range(len(KINDS)):
        mine = [(r["code"], r["n"]) for r in rows if r["kind"] == kind]
        if mine:
            codes, counts = (np.array(x) for x in zip(*sorted(mine), strict=True))
            given, features = unpacked(codes)
            soft, _ = reliabilities(given, counts.astype(float))
            x = np.hstack([given == 1, given == 2, features, np.ones((len(codes), 1))]).astype(float)
            w = classifier(x, soft, counts.astype(float))
            good = 1 / (1 + np.exp(-x @ w)) >= ACCEPT
            out += [int(kind * COMBINATIONS + c) for c in codes[good]]
    return out


def personal_data(docs: DataFrame, keep=("doc_id",)) -> DataFrame:
    """Rows of ``docs`` (columns ``keep``) with ``base`` and ``spans``: arrays of (start, kind, end)
    in code points, end exclusive, kind a number into KINDS, by start, then kind.

    ``spans`` has all base spans and the accepted candidates. Null and empty texts have none.
    Repeated rows each get their spans; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    found = written(per_text(docs, FOUND, candidates, keep), "candidates")
    good = accepted(found)
    known = F.array(*(F.lit(x) for x in good)) if good else F.expr("cast(array() as array<int>)")

    def place(x):
        return F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))

    wanted = F.filter(
        "more", lambda x: F.array_contains(known, x["kind"].cast("int") * COMBINATIONS + x["code"])
    )
    return found.select(
        *keep,
        F.transform("base", place).alias("base"),
        F.array_sort(F.transform(F.concat("base", wanted), place)).alias("spans"),
    )


def named(spans):
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.transform(
        spans, lambda x: F.concat_ws(":", F.get(names, x["kind"].cast("int")), x["start"], x["end"])
    )


def digest(found: DataFrame) -> DataFrame:
    counts = [_count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(
        "doc_id",
        *counts,
        joined_sha(named("base")).alias("base_sha256"),
        F.array_join(named("spans"), ",").alias("spans"),
    )


def _count(kind: int):
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
