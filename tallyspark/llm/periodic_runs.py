"""Periodic runs of words, by seeds and extension along diagonals.

A run of period q and at least ``max(least, exponent * q)`` words repeats
itself at lag q over at least ``max(least - q, (exponent - 1) * q)`` positions:
the overlap any run of that lag is guaranteed to have.  Lags are taken in
classes (1 to 5, 6 to 18, 19 to 57, ... for the usual limits); the k-grams of a
class's guaranteed overlap are indexed, and each occurrence is paired with the
next one in the same document.  For a k-gram no shorter than the lag that pair
lies on the diagonal of the run's smallest period, so every run has a seed and
no document's repeats are enumerated in all pairs.  A seed is extended to both
sides while the words q apart are equal, unless the per-lag table of furthest
covered positions shows that an earlier extension has passed it.

k-grams are told apart by exact numbers, not by hashes: those of one class are
built from those of the class before, at the positions alone whose shorter
k-grams occur again.  Documents are independent, so nothing is shuffled; a
task works on ``BATCH_BYTES`` of whole texts, or one longer text, at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import common
from tallyspark.llm.token_archive import in_slices

LEAST_WORDS, EXPONENT = 6, 4
BATCH_BYTES = 2 << 20

RUN = "struct<start:bigint,length:bigint,period:bigint>"
#: What ``find`` adds to the kept columns.
FOUND = f"n_words bigint, runs array<{RUN}>, strongest {RUN}, collapsed string"


def overlap(q: int, least: int = LEAST_WORDS, exponent: int = EXPONENT) -> int:
    """The positions at which a run of period ``q`` at least equals itself."""
    return max(least - q, (exponent - 1) * q)


def lag_classes(words: int, least: int = LEAST_WORDS, exponent: int = EXPONENT) -> Iterator[tuple[int, int, int]]:
    """(smallest lag, largest lag, k) of each class that ``words`` words allow:
    k is the least overlap of any lag from the smallest one on, and the largest
    lag is k, as a k-gram of a run recurs first at its period only if it is no
    shorter than that."""
    if exponent < 2:
        raise ValueError("an exponent of 2 or more is needed")
    low, turn = 1, least // exponent
    while max(least, exponent * low) <= words:
        k = min(overlap(q, least, exponent) for q in (low, max(low, turn), max(low, turn + 1)))
        yield low, k, k
        low = k + 1


def numbered(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal pairs (a, b) of numbers get equal numbers, others different ones."""
    return np.unique(a * (b.max(initial=0) + 1) + b, return_inverse=True)[1]


def next_same(at: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """The next position in ``at`` (ascending) of the same k-gram; 0: none."""
    out = np.zeros(len(at), np.int64)
    order = np.argsort(gram, kind="stable")
    same = gram[order[1:]] == gram[order[:-1]]
    out[order[:-1][same]] = at[order[1:][same]]
    return out


class GramIndex:
    """Positions whose k-gram occurs more than once, for growing k."""

    def __init__(self, words: np.ndarray):
        self.words, self.k = words, 1
        self.at = np.arange(len(words))
        self.gram = words
        self._keep_repeated()

    def _keep_repeated(self) -> None:
        if len(self.at):
            kept = np.bincount(self.gram)[self.gram] > 1
            self.at, self.gram = self.at[kept], self.gram[kept]

    def grow(self, k: int) -> None:
        """To the k-grams: each is covered by shorter ones one after another,
        and repeats only if all of them do."""
        while self.k < k and len(self.at):
            step = min(self.k, k - self.k)  # where the second of two overlapping grams starts
            row = np.full(len(self.words) + 1, -1)
            row[self.at] = np.arange(len(self.at))
            second = row[np.minimum(self.at + step, len(self.words))]
            both = second >= 0
            at, gram = self.at[both], numbered(self.gram[both], self.gram[second[both]])
            self.at, self.gram, self.k = at, gram, self.k + step
            self._keep_repeated()
        self.k = k


def extend(words: np.ndarray, i: int, q: int, begin: int, end: int) -> tuple[int, int]:
    """The furthest [from, to) around ``i`` in which words[t] == words[t + q],
    inside the document [begin, end); compared in growing strides."""
    low, stride = i, 16
    while low > begin:
        at = max(begin, low - stride)
        unequal = np.flatnonzero(words[at:low] != words[at + q:low + q])
        if len(unequal):
            low = at + int(unequal[-1]) + 1
            break
        low, stride = at, 2 * stride
    high, stride = i, 16
    while high < end - q:
        to = min(end - q, high + stride)
        unequal = np.flatnonzero(words[high:to] != words[high + q:to + q])
        if len(unequal):
            high += int(unequal[0])
            break
        high, stride = to, 2 * stride
    return low, high


def runs(words: np.ndarray, starts: np.ndarray, least: int = LEAST_WORDS, exponent: int = EXPONENT
         ) -> list[tuple[int, int, int, int]]:
    """(document, start, length, period) of every run, by document, start and
    period.  ``words`` numbers the words of all documents, those of different
    documents differently; document d is words[starts[d]:starts[d + 1]]."""
    index, out = GramIndex(words), []
    longest = int(np.diff(starts).max(initial=0))
    for low, high, k in lag_classes(longest, least, exponent):
        index.grow(k)
        if not len(index.at):
            break
        lag = next_same(index.at, index.gram) - index.at
        seed = (lag >= low) & (lag <= high)
        at, lags = index.at[seed], lag[seed]
        # a seed right after one of the same lag is covered by that one's extension
        inner = np.zeros(len(at), bool)
        inner[1:] = (at[1:] == at[:-1] + 1) & (lags[1:] == lags[:-1])
        covered: dict[int, int] = {}
        for i, q in zip(at[~inner].tolist(), lags[~inner].tolist(), strict=True):
            if covered.get(q, -1) > i:
                continue
            doc = int(np.searchsorted(starts, i, side="right")) - 1
            begin, end = int(starts[doc]), int(starts[doc + 1])
            first, last = extend(words, i, q, begin, end)
            covered[q] = last
            if last + q - first >= max(least, exponent * q):
                out.append((doc, first - begin, last + q - first, q))
    return sorted(out, key=lambda r: (r[0], r[1], r[3]))


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words that no run (start, length, period) holds after its first
    period, joined by one space."""
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    if not found:
        return b" ".join(words)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest exact length / period; of equal ones the first, then
    the shortest period."""
    best = None
    for r in found:  # by start, then period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def find(docs: DataFrame, *keep: Column, text: Column | None = None, least: int = LEAST_WORDS,
         exponent: int = EXPONENT) -> DataFrame:
    """``keep`` columns plus the number of words, all runs by start and period,
    the strongest one (null: none) and the text without what runs repeat.

    Words are what ASCII white space separates.  Whole rows are kept as one
    struct (``common.whole_row``), so no name can clash.  A null or empty text
    has no words and no run; repeated rows are rows of their own; a very long
    text is worked on alone, its words in about 100 times its bytes."""
    common.ready(docs.sparkSession)
    body = common.text_or_empty((F.col("text") if text is None else text).cast("string")).cast("binary")
    rows = docs.select(*keep, body.alias("__text"))
    kept = rows.columns[:-1]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]), FOUND])
    run_type = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def work(batches):
        for batch in batches:
            for part in in_slices(batch, "__text", BATCH_BYTES):
                split = [t.split() for t in part.column("__text").to_pylist()]
                starts = np.cumsum([0, *map(len, split)])
                numbers, used = [], 0
                for words in split:
                    own = {w: n for n, w in enumerate(set(words), used)}
                    numbers += map(own.__getitem__, words)
                    used += len(own)
                found = [[] for _ in split]
                for doc, start, length, period in runs(np.array(numbers, np.int64), starts, least, exponent):
                    found[doc].append((start, length, period))
                dicts = [[dict(zip(("start", "length", "period"), r)) for r in f] for f in found]
                best = [b and dict(zip(("start", "length", "period"), b)) for b in map(strongest, found)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in range(len(kept))), pa.array([len(w) for w in split], pa.int64()),
                     pa.array(dicts, pa.list_(run_type)), pa.array(best, run_type),
                     pa.array([collapse(w, f).decode() for w, f in zip(split, found)], pa.string())],
                    [*kept, "n_words", "runs", "strongest", "collapsed"])

    return rows.mapInArrow(work, schema)


def with_planted_periods(doc_id: Column, text: Column) -> Column:
    """``text`` with the contract's planted repetition: where h = crc32 of the
    decimal doc_id is divisible by 10 and there are words, each word i >= a
    becomes word a + (i - a) % p.  A null doc_id plants nothing."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(text, F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))

    def planted(w):
        n = F.nullif(F.size(w).cast("long"), F.lit(0).cast("long"))
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        index = F.transform(F.sequence(F.lit(0).cast("long"), n - 1),
                            lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.coalesce(F.array_join(F.transform(index, lambda i: F.get(w, i.cast("int"))), " "), F.lit(""))

    kept = F.element_at(F.transform(F.array(words), planted), 1)
    return F.when(h % 10 == 0, kept).otherwise(text)


def run_digest(docs: DataFrame) -> DataFrame:
    """The contract's row per document."""
    text = with_planted_periods(F.col("doc_id"), common.text_or_empty(F.col("text").cast("string")))
    got = find(docs, F.col("doc_id"), text=text)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    joined = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return got.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("strongest.start").alias("start"),
        F.col("strongest.length").alias("length"), F.col("strongest.period").alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(joined.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
