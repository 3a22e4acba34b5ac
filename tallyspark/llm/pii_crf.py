"""Personal data by patterns and a skip-chain conditional random field.

Base spans come from fixed patterns.  The tokens that hold a digit or an @
form the variables of a linear chain per document; neighbouring digit groups
that together repeat the last digits of a base span, whatever their grouping,
are one variable whose label rests on its skip edges alone (the patterns that
label the sample never see it).  Variables that repeat or
resemble an earlier one share a skip edge with it, so an entity found once
carries its label to its other mentions.  Variables inside base spans are
observed; beliefs of the others come from loopy sum-product message passing.
Weights are fitted piecewise (token classifier, then transition and agreement
counts) on a bounded sample of documents with base spans as labels.

Documents are independent: one pass over whole texts, no shuffle.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm import common

KINDS = ("email", "ip", "card", "phone")
#: Email and IP also match a bare leading run (then group 1 is missing): every
#: start within a run fails alike, so the run is passed over at once and a very
#: long one costs its length, not its square.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+)?")
IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"\S+")
DIGIT = re.compile(r"[0-9]")
EDGE = ".,;:!?()[]{}<>|\"'"
HASHED = 1 << 13
#: A token that may be a part of a number, and one that may stand between two.
GROUP = re.compile(r"\+?\(?\+?[0-9][0-9().-]*")
JOINT = re.compile(r"[().\u2010-\u2015-]+")
#: Last digits that make two numbers similar.
SUFFIX = 7
#: Feature of such grouped digits; its weights stay 0.
GROUPED = HASHED
#: Least weight of an edge that ties grouped digits to a number.
SAME_NUMBER = 4.0
#: Digits of the longest base span of a kind that can be grouped, and a prefix.
MOST_DIGITS = 24

LABELS = len(KINDS) + 1  # label 0: none
TRAIN_DOCS = 2000
#: Training documents are no longer than this (UTF-8 bytes), so what reaches the
#: driver is bounded by TRAIN_DOCS times a token count.
TRAIN_BYTES = 8192
EPOCHS = 30
ROUNDS = 8
#: Belief from which a token that skip edges tie to an observed one becomes a span.
BELIEF = 0.8
CLAMP = 50.0

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _octet(digits: str) -> bool:
    """Whether a part without its leading zeros is at most 255."""
    return len(digits) <= 3 and int(digits or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """All base spans, by kind as listed, then start (code points)."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", *m.span()) for m in EMAIL.finditer(text) if m.group(1)]
    if DIGIT.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text)
                if m.group(1) and all(_octet(p.lstrip("0")) for p in m.group().split("."))]
        for m in CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in PHONE.finditer(text)
                    if 8 <= sum(map(str.isdecimal, m.group())) <= 15]
    return out


def encode(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def shape(token: str) -> str:
    token = re.sub("[0-9]+", "d", token)
    return re.sub("[^\\W\\d_]+", "a", token)[:24].replace("ad", "w").replace("da", "w") if token else ""


def keys(token: str) -> list[str]:
    """Tokens that share a key are similar."""
    bare = token.strip(EDGE).lower()
    digits = re.sub("[^0-9]", "", bare)
    out = []
    if len(bare) >= 5 and bare != digits[-SUFFIX:]:
        out.append(bare)
    if len(digits) >= SUFFIX:
        out.append("#" + digits[-SUFFIX:])
    if "@" in bare and len(bare.split("@")[0]) >= 3:
        out.append("@" + bare.split("@")[0])
    return out


def units(text: str, tokens: list[re.Match], spans: list[Span]) -> list[tuple[int, int, set[str]]]:
    """(first token, last token, own keys) of every variable in order:
    neighbouring digit groups whose digits end a base span's, and each other
    token with a digit or an @; the last token of a base span of digits has
    the key of the whole span."""
    held: list[tuple[int, int]] = []  # tokens of base spans; those that meet in a token are one
    own: dict[int, set[str]] = {}
    ends: dict[str, set[str]] = {}
    at = 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        while at and tokens[at].start() > a:
            at -= 1
        while tokens[at].end() <= a:
            at += 1
        last = at
        while last + 1 < len(tokens) and tokens[last + 1].start() < b:
            last += 1
        if held and at <= held[-1][1]:
            held[-1] = (held[-1][0], max(last, held[-1][1]))
        else:
            held.append((at, last))
        digits = re.sub("[^0-9]", "", text[a:b])
        if kind in ("card", "phone"):
            ends.setdefault(digits[-SUFFIX:], set()).add(digits)
            own.setdefault(last, set()).add("#" + digits[-SUFFIX:])

    def groups_before(last: int, floor: int):
        """Digit groups that neighbour each other, from ``last`` backwards."""
        i = last
        while i >= floor:
            token = tokens[i].group()
            if not JOINT.fullmatch(token):
                bare = token.strip(EDGE)
                if not GROUP.fullmatch(bare):
                    return
                head, tail = token[:token.index(bare)], token[token.index(bare) + len(bare):]
                if head.strip("(") or (i < last and tail.strip(")")):
                    return
                yield i, re.sub("[^0-9]", "", bare)
                if head.startswith("(") and "+" in bare or bare.startswith("+"):
                    return
            elif i == last or JOINT.fullmatch(tokens[i + 1].group()):
                return
            i -= 1

    def first_of(last: int, floor: int) -> int:
        """Where the digit groups up to ``last`` that repeat the end of a base
        span begin, -1 when they do not; a number's leading zeros may differ."""
        joined, best = "", -1
        for i, digits in groups_before(last, floor):
            joined = digits + joined
            if len(joined) > MOST_DIGITS:
                break
            known = ends.get(joined[-SUFFIX:]) if len(joined) >= SUFFIX else ()
            bare = joined.lstrip("0")
            if len(joined) >= SUFFIX and not known:
                break
            if any(d.endswith(joined) or len(bare) >= SUFFIX and d.lstrip("0").endswith(bare) for d in known):
                best = i
        return best

    out: list[tuple[int, int, set[str]]] = []
    floor = 0
    for a, b in [*held, (len(tokens), len(tokens))]:
        low = floor  # grouped digits do not overlap
        for i in range(floor, a):
            token = tokens[i].group()
            if "@" not in token and not DIGIT.search(token):
                continue
            first = first_of(i, low) if ends else i
            if 0 <= first < i:
                while out and out[-1][0] >= first:
                    out.pop()
                out.append((first, i, set()))
                low = i + 1
            else:
                out.append((i, i, set()))
        for i in range(a, min(b + 1, len(tokens))):
            if "@" in tokens[i].group() or DIGIT.search(tokens[i].group()):
                out.append((i, i, own.get(i, set())))
        floor = b + 1
    return out


class Graph:
    """The tokens of one or more documents as variables (see ``units``)."""

    def __init__(self):
        self.features: list[list[int]] = []
        self.label: list[int] = []  # of the base span that holds the token, else 0
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []
        self.place: list[tuple[int, int, int]] = []  # document, start, end

    def add(self, doc: int, text: str, spans: list[Span]) -> None:
        tokens = [m for m in TOKEN.finditer(text)]
        last: dict[str, int] = {}
        before, at_before = -1, -2
        marks = sorted((a, b, KINDS.index(k) + 1) for k, a, b in spans)
        next_mark = 0
        for first, end, own in units(text, tokens, spans):
            a, b = tokens[first].start(), tokens[end].end()
            token = text[a:b]
            while next_mark < len(marks) and marks[next_mark][1] <= a:
                next_mark += 1
            label = next((k for x, y, k in marks[next_mark:next_mark + 4] if x < b and a < y), 0)
            node = len(self.label)
            around = [tokens[j].group() if 0 <= j < len(tokens) else "" for j in (first - 1, end + 1)]
            n_digits = sum(map(str.isdecimal, token))
            names = (f"s{shape(token)}", f"n{min(n_digits, 20)}", f"p{shape(around[0])}", f"q{shape(around[1])}",
                     f"l{min(len(token), 24)}", "bias")
            grouped = end > first
            self.features.append([GROUPED if grouped else zlib.crc32(x.encode()) % HASHED for x in names])
            self.label.append(label)
            self.place.append((doc, a, b))
            if not grouped:
                if at_before == first - 1:
                    self.chain.append((before, node))
                before, at_before = node, end
            for key in sorted({*keys(token), *own}):
                if key in last:
                    self.skip.append((last[key], node))
                last[key] = node


class SkipChain:
    def __init__(self):
        self.unary = np.zeros((HASHED + 1, LABELS))
        self.transition = np.zeros((LABELS, LABELS))
        self.agree = 2.0
        self.same_number = SAME_NUMBER

    def fit(self, graphs: list[tuple]) -> SkipChain:
        """``graphs``: (features, label, chain, skip) arrays of the sample."""
        x = np.concatenate([g[0] for g in graphs])
        y = np.concatenate([g[1] for g in graphs])
        want = np.eye(LABELS)[y]
        step = np.full_like(self.unary, 1e-6)
        for _ in range(EPOCHS):  # full-batch Adagrad on the token classifier
            s = self.unary[x].sum(axis=1)
            p = np.exp(s - s.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            g = np.zeros_like(self.unary)
            for k in range(x.shape[1]):
                np.add.at(g, x[:, k], (p - want) / len(y))
            step += g * g
            self.unary -= 0.5 * g / np.sqrt(step)
        self.unary[GROUPED] = 0.0
        pairs, same, other, both = np.ones((LABELS, LABELS)), 1.0, 1.0, np.ones(2)
        for features, label, chain, skip in graphs:
            if len(chain):
                np.add.at(pairs, (label[chain[:, 0]], label[chain[:, 1]]), 1)
            if len(skip):
                skip = skip[~(features[skip, 0] == GROUPED).any(axis=1)]
                equal = label[skip[:, 0]] == label[skip[:, 1]]
                named = (label[skip[:, 0]] > 0) | (label[skip[:, 1]] > 0)
                same += (equal & named).sum()
                other += (~equal).sum()
                seen = (label[skip] > 0).all(axis=1)
                both += (equal & seen).sum(), (~equal & seen).sum()
        expected = pairs.sum(axis=1, keepdims=True) * pairs.sum(axis=0, keepdims=True) / pairs.sum()
        self.transition = np.clip(np.log(pairs / expected), -2, 2)
        self.agree = float(np.clip(np.log(same / other), 2.0, 6.0))
        self.same_number = float(np.clip(np.log(both[0] / both[1]), SAME_NUMBER, 6.0))
        return self

    def beliefs(self, features, label, chain, skip) -> np.ndarray:
        """Marginals of every token; those with a base label are observed."""
        score = self.unary[features].sum(axis=1)
        score -= score.max(axis=1, keepdims=True)
        score = np.maximum(score, -8.0)  # a pattern's miss is evidence, not proof
        seen = label > 0
        score[seen] = -CLAMP
        score[seen, label[seen]] = 0.0
        edges = np.concatenate([chain.reshape(-1, 2), skip.reshape(-1, 2)]).astype(np.int64)
        if not len(edges):
            return _normal(score)
        agree = np.eye(LABELS)
        agree[0, 0] = 0.0  # two unnamed mentions say nothing
        grouped = (features[skip.reshape(-1, 2), 0] == GROUPED).any(axis=1)
        kind = np.r_[np.zeros(len(chain), np.int64), 1 + grouped.astype(np.int64)]
        skips = [agree * self.agree, agree * self.same_number]
        forth, back = np.stack([self.transition, *skips])[kind], np.stack([self.transition.T, *skips])[kind]
        src = np.r_[edges[:, 0], edges[:, 1]]
        dst = np.r_[edges[:, 1], edges[:, 0]]
        potential = np.exp(np.concatenate([forth, back]))
        opposite = np.r_[np.arange(len(edges)) + len(edges), np.arange(len(edges))]
        message = np.zeros((len(src), LABELS))
        for _ in range(ROUNDS):
            total = score.copy()
            np.add.at(total, dst, message)
            out = total[src] - message[opposite]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            new = np.log(np.einsum("ea,eab->eb", out, potential) + 1e-300)
            message = 0.5 * message + 0.5 * (new - new.max(axis=1, keepdims=True))
        total = score.copy()
        np.add.at(total, dst, message)
        return _normal(total)


def _normal(score: np.ndarray) -> np.ndarray:
    p = np.exp(score - score.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _arrays(g: Graph):
    return (np.array(g.features, np.int64).reshape(-1, 6), np.array(g.label, np.int64),
            np.array(g.chain, np.int64).reshape(-1, 2), np.array(g.skip, np.int64).reshape(-1, 2))


def added_spans(model: SkipChain | None, texts: list[str], found: list[list[Span]]) -> list[list[Span]]:
    """What the field adds to the base spans of each text."""
    out: list[list[Span]] = [[] for _ in texts]
    graph = Graph()
    for i, (text, spans) in enumerate(zip(texts, found, strict=True)):
        if spans:  # without an entity there is no label to carry over
            graph.add(i, text, spans)
    if model is None or not graph.skip:
        return out
    features, label, chain, skip = _arrays(graph)
    belief = model.beliefs(features, label, chain, skip)
    # Only mentions that skip edges tie to an observed entity can be named.
    linked = label > 0
    while True:
        new = skip[linked[skip[:, 0]] != linked[skip[:, 1]]].ravel()
        if not len(new):
            break
        linked[new] = True
    best = belief.argmax(axis=1)
    for node in np.flatnonzero(linked & (label == 0) & (best > 0) & (belief.max(axis=1) >= BELIEF)):
        doc, a, b = graph.place[node]
        token = texts[doc][a:b]
        a += len(token) - len(token.lstrip(EDGE))
        b -= len(token) - len(token.rstrip(EDGE))
        if a < b:
            out[doc].append((KINDS[best[node] - 1], a, b))
    return out


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS, seed: int = 1, train_bytes: int = TRAIN_BYTES
          ) -> SkipChain | None:
    """Fitted on at most ``train_docs`` documents of at most ``train_bytes``
    each that hold a digit or an @, those with the smallest seeded hash; None
    when there is none."""
    rows = common.with_identity(docs, F.col("doc_id"), F.col("text").cast("string").alias("__text"))
    key = ["__h", "__f", "__r"]
    small = F.octet_length("__text") <= train_bytes
    near = rows.where(small & F.col("__text").rlike("[0-9@]")).withColumn("__h", F.xxhash64(F.lit(seed), "__f", "__r", "doc_id"))
    picked = common.smallest(near.select(*key), train_docs, *key)  # bounded by train_docs
    chosen = rows.join(F.broadcast(picked), ["__f", "__r"]).select("__text")

    def graphs(batches):
        for b in batches:
            rows = []
            for t in b.column(0).to_pylist():
                g = Graph()
                g.add(0, t, base_spans(t))
                rows.append([a.ravel().tolist() for a in _arrays(g)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.list_(pa.int64())) for i in range(4)], list("abcd"))

    got = chosen.mapInArrow(graphs, "a array<long>, b array<long>, c array<long>, d array<long>").collect()
    got.sort()
    if not got:
        return None
    sample = [(np.array(r.a, np.int64).reshape(-1, 6), np.array(r.b, np.int64),
               np.array(r.c, np.int64).reshape(-1, 2), np.array(r.d, np.int64).reshape(-1, 2)) for r in got]
    return SkipChain().fit(sample) if sum(len(s[1]) for s in sample) else None


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind in brackets; overlapping
    spans become one."""
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


FOUND = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, __redacted string")


def find(docs: DataFrame, model: SkipChain | None, *keep) -> DataFrame:
    """``keep`` columns plus ``FOUND`` for the whole ``text`` of each row
    (null: empty; ``__redacted`` is null where nothing was found).  Whole rows
    are kept as one struct (``common.whole_row``), so no name can clash."""
    common.ready(docs.sparkSession)
    rows = docs.select(*keep, common.text_or_empty(F.col("text").cast("string")).alias("__text"))
    kept = rows.drop("__text").schema
    names = [x.split()[0] for x in FOUND.split(", ")]
    types = [pa.int64()] * 4 + [pa.string()] * 3

    def run(batches):
        for b in batches:
            texts = b.column("__text").to_pylist()
            base = [base_spans(t) for t in texts]
            more = added_spans(model, texts, base)
            rows = []
            for text, own, added in zip(texts, base, more, strict=True):
                every = sorted([*own, *added], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
                rows.append([*(sum(s[0] == k for s in own) for k in KINDS),
                             hashlib.sha256(encode(own).encode()).hexdigest(), encode(every),
                             redact(text, every) if every else None])
            new = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*b.drop_columns(["__text"]).columns, *new], [*kept.names, *names])

    return rows.mapInArrow(run, T.StructType([*kept.fields, *T.StructType.fromDDL(FOUND).fields]))


def personal_data(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """The contract's row per document.  Counts and ``base_sha256`` are of the
    base spans, ``spans`` also has the field's.  A null text has no spans; a
    null doc_id stays null; repeated rows each give a row."""
    common.ready(docs.sparkSession)
    return find(docs, train(docs, train_docs), F.col("doc_id").cast("long").alias("doc_id")).drop("__redacted")
