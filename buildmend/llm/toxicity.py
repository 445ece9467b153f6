"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens and their beginnings get log-odds between toxic and clean text under an
informative Dirichlet prior. A linear-time scan finds every maximal segment of
a text, extreme-value statistics of clean texts say how surprising it is, and
a logistic curve turns that into the chance of a toxic label.
"""

from __future__ import annotations

import re
from collections import Counter
from math import exp, log, log1p, sqrt

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buildmend.llm.common import bounded_sample, by_batch
from buildmend.session import durable

WORD = re.compile(r"[^\W\d_]+")
#: Lengths of word beginnings that stand in for words never learned.
STEMS = (7, 6, 5, 4, 3)
#: Weight of the prior in units, its least for one unit, and what every unremarkable token costs.
PRIOR, LEAST_PRIOR, DRIFT = 500.0, 0.5, 0.1
#: Least z value of a lexicon entry, and least number and share of the toxic texts that have it.
LEAST_Z, LEAST_TEXTS, LEAST_SHARE = 2.5, 3, 0.005
#: Surprise in nats from which a passage is significant.
SIGNIFICANT = 3.0
#: Most that a text without any passage can score.
NO_PASSAGE = 0.1
#: Words whose scores a task keeps.
CACHE = 150_000


def units(words: list[str]) -> set[str]:
    """Distinct words, and their beginnings marked by a star."""
    own = set(words)
    return own | {word[:k] + "*" for word in own for k in STEMS if len(word) > k}


def counts(sample: DataFrame) -> DataFrame:
    """Texts that have each unit, by half and label; the null unit has the sums and ``n`` the texts.

    A text counts once for a unit however often it repeats it, so that one
    text that says a word a thousand times weighs no more than another.
    """

    def make():
        def batch(rows: dict[str, list]) -> dict[str, list]:
            texts, total, n = Counter(), Counter(), Counter()
            for body, toxic, half in zip(rows["body"], rows["toxic"], rows["half"]):
                own, slot = units(WORD.findall((body or "").lower())), half * 2 + toxic
                texts.update((unit, slot) for unit in own)
                total[slot] += len(own)
                n[slot] += 1
            keys = [*texts, *((None, slot) for slot in total)]
            return {
                "unit": [u for u, _ in keys], "slot": [s for _, s in keys],
                "texts": [texts[k] if k[0] is not None else total[k[1]] for k in keys],
                "n": [0 if k[0] is not None else n[k[1]] for k in keys],
            }

        return batch

    rows = by_batch(sample, make, "unit string, slot int, texts long, n long")

    def one(column: str, slot: int) -> Column:
        return F.sum(F.when(F.col("slot") == slot, F.col(column)).otherwise(0)).alias(f"{column}{slot}")

    return rows.groupBy("unit").agg(*[one(c, s) for c in ("texts", "n") for s in range(4)])


def lexicon(rows: list, totals, halves: tuple[int, ...]) -> dict[str, float]:
    """Log-odds of the units that lean to toxic text, from some halves.

    The prior of a unit is its share of all text; odds are those of the unit
    in toxic text against clean text, with their z value as the test.
    """
    n_clean, n_toxic = (float(sum(totals[f"texts{2 * h + s}"] for h in halves)) + 1 for s in (0, 1))
    least = max(LEAST_TEXTS, LEAST_SHARE * sum(totals[f"n{2 * h + 1}"] for h in halves))
    found = {}
    for r in rows:
        clean, toxic = (sum(r[f"texts{2 * h + s}"] for h in halves) for s in (0, 1))
        if toxic < least:
            continue
        prior = PRIOR * (clean + toxic) / (n_clean + n_toxic) + LEAST_PRIOR
        y, x = toxic + prior, clean + prior
        odds = log(y / (n_toxic + PRIOR - toxic)) - log(x / (n_clean + PRIOR - clean))
        if odds > 1 and odds / sqrt(1 / y + 1 / x) >= LEAST_Z:
            found[r["unit"]] = odds
    return found


class Scores(dict):
    """Score of each word: its own, that of its longest known beginning, or the drift."""

    def __init__(self, known: dict[str, float]):
        super().__init__()
        self.known = known

    def __missing__(self, word: str) -> float:
        known = self.known
        score = known.get(word)
        for k in STEMS if score is None else ():
            if len(word) > k and (score := known.get(word[:k] + "*")) is not None:
                break
        if len(self) >= CACHE:
            self.clear()
        self[word] = score = -DRIFT if score is None else score
        return score


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), end exclusive, in linear time."""
    total, stack = 0.0, []  # entries: start, end, sum before, sum behind
    for at, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        entry = [at, at + 1, before, total]
        while True:
            k = len(stack) - 1
            while k >= 0 and stack[k][2] >= entry[2]:
                k -= 1
            if k < 0 or stack[k][3] >= entry[3]:
                stack.append(entry)
                break
            entry = [stack[k][0], entry[1], stack[k][2], entry[3]]
            del stack[k:]
    return [(a, b, right - left) for a, b, left, right in stack]


def condensed(scores: list[float]) -> tuple[list[float], list[int], list[int]]:
    """Scores with every run of drift as one number, and where each begins and ends."""
    array = np.fromiter(scores, dtype=np.float64, count=len(scores))
    at = np.flatnonzero(array > 0)
    out, starts, ends, last = [], [], [], 0
    for p in at.tolist():
        if p > last:
            out.append(-DRIFT * (p - last))
            starts.append(last)
            ends.append(p)
        out.append(scores[p])
        starts.append(p)
        ends.append(p + 1)
        last = p + 1
    return out, starts, ends


def passages(words: list[str], scores: Scores) -> list[tuple[int, int, float]]:
    """Maximal segments of a text in words."""
    values = list(map(scores.__getitem__, words))
    if not values or max(values) <= 0:
        return []
    line, starts, ends = condensed(values)
    return [(starts[a], ends[b - 1], score) for a, b, score in segments(line)]


def decay(share: dict[float, float]) -> float:
    """The positive root x of E[exp(x * score)] = 1 over clean tokens."""
    low, high = 0.0, 50.0
    for _ in range(100):
        mid = (low + high) / 2
        if sum(p * exp(min(600, mid * s)) for s, p in share.items()) > 1:
            high = mid
        else:
            low = mid
    return max(low, 1e-3)


class Model:
    """Lexicon, rate of decay and size of the extreme-value law, logistic curve."""

    def __init__(self, known: dict[str, float], rate: float, size: float = 1.0, curve=(0.0, 0.0, 0.0)):
        self.known, self.rate, self.size, self.curve = known, rate, size, curve

    def surprise(self, score: float, n_words: int) -> float:
        """-ln of the chance that clean text of this length has such a segment."""
        p = -np.expm1(-self.size * max(n_words, 1) * exp(-min(600.0, self.rate * score)))
        return float(min(60.0, -log(p))) if p > 0 else 60.0

    def features(self, found: list[tuple[int, int, float]], n_words: int) -> tuple[float, float]:
        each = [self.surprise(s, n_words) for _, _, s in found]
        return (max(each), log1p(sum(e > SIGNIFICANT for e in each))) if each else (0.0, 0.0)

    def chance(self, x: tuple[float, float]) -> float:
        z = self.curve[0] + self.curve[1] * x[0] + self.curve[2] * x[1]
        p = float(1 / (1 + exp(-max(-30.0, min(30.0, z)))))
        return p if x[0] else min(p, NO_PASSAGE)


def size_of(clean: list[tuple[float, int]], rate: float) -> float:
    """Size K of the law: as many clean texts with a segment as were seen.

    ``clean`` has the best score (0: none) and the number of words of each text.
    """
    scores = sorted(s for s, _ in clean if s > 0)
    if not scores:
        return 1.0
    at = scores[len(scores) // 2]
    share, words = sum(s >= at for s, _ in clean) / len(clean), np.array([max(n, 1) for _, n in clean])
    low, high = 1e-9, 1e6
    for _ in range(100):
        mid = sqrt(low * high)
        if np.mean(-np.expm1(-mid * words * exp(-rate * at))) < share:
            low = mid
        else:
            high = mid
    return low


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Weighted ridge logistic regression by Newton steps."""
    design, w = np.column_stack([np.ones(len(x)), x]), np.zeros(x.shape[1] + 1)
    penalty = ridge * np.diag([0.01] + [1.0] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        g = design.T @ (weight * (p - y)) + penalty @ w
        h = (design * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ design + penalty
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def learned(docs: DataFrame, labels: DataFrame, learn: Column, doc_id: str, text: str, label: str, rows: int, entries: int) -> Model | None:
    """Fit on a bounded sample of labelled rows; None without both labels.

    The lexicon of one half of the sample scores the other half, so that the
    extreme-value fit and the curve see texts as unknown as those to come.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.max(label).cast("int").alias("toxic")).filter(learn)
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    picked = bounded_sample(known, rows, "toxic", sizes, 5, doc_id)
    half = F.pmod(F.xxhash64(F.lit(6), doc_id), F.lit(2)).cast("int")
    sample = docs.select(doc_id, F.col(text).alias("body")).join(
        F.broadcast(picked), doc_id  # at most about 2 * rows ids, by the sample's bound
    ).select("body", "toxic", half.alias("half"))

    table = durable(counts(sample))
    totals = table.filter("unit IS NULL").first()
    if totals is None:
        return None
    toxic, clean = F.col("texts1") + F.col("texts3"), F.col("texts0") + F.col("texts2")
    kept = table.filter(F.col("unit").isNotNull() & (toxic >= LEAST_TEXTS) & (toxic * sizes[0] >= clean * sizes[1])).orderBy(
        (toxic / (clean + 1)).desc(), toxic.desc(), "unit"
    ).limit(entries).collect()
    whole, halves = lexicon(kept, totals, (0, 1)), [lexicon(kept, totals, (1,)), lexicon(kept, totals, (0,))]

    sent = docs.sparkSession.sparkContext.broadcast(halves)

    def make():
        scores = [Scores(known) for known in sent.value]

        def batch(cells: dict[str, list]) -> dict[str, list]:
            out = {"toxic": cells["toxic"], "n": [], "positive": [], "found": []}
            for body, half_no in zip(cells["body"], cells["half"]):
                words = WORD.findall((body or "").lower())
                found = passages(words, scores[half_no])
                out["n"].append(len(words))
                out["positive"].append([s for w in words if (s := scores[half_no][w]) > 0])
                out["found"].append([s for _, _, s in found])
            return out

        return batch

    drawn = by_batch(sample, make, "toxic int, n long, positive array<double>, found array<double>").collect()
    clean = [r for r in drawn if r["toxic"] == 0]
    n_clean = sum(r["n"] for r in clean) + 1
    seen = Counter(round(s, 1) for r in clean for s in r["positive"])
    for s in {round(v, 1) for v in whole.values()}:
        seen[s] += 1 / max(1, len(whole))  # what is not seen in clean text is not impossible there
    share = {s: n / n_clean for s, n in seen.items()}
    share[-DRIFT] = max(0.0, 1 - sum(share.values()))
    model = Model(whole, decay(share))
    model.size = size_of([(max(r["found"], default=0.0), r["n"]) for r in clean], model.rate)
    x = np.array([model.features([(0, 0, s) for s in r["found"]], r["n"]) for r in drawn])
    y = np.array([float(r["toxic"]) for r in drawn])
    true = np.array([sizes[0], sizes[1]], dtype=float)
    got = np.maximum(1, np.array([(y == 0).sum(), (y == 1).sum()], dtype=float))
    weight = (true / got)[y.astype(int)]
    model.curve = logistic(x, y, weight * len(y) / weight.sum())
    return model


def scored(
    docs: DataFrame, labels: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    keep: list[str] | None = None, rows: int = 5000, entries: int = 50_000, threshold: float = 0.3,
) -> DataFrame:
    """Score every whole text for toxicity and name its toxic passages.

    ``learn`` chooses labelled rows by columns of ``labels``. About ``rows``
    rows of each label are learned from, and the lexicon has at most
    ``entries`` units: these bound the model. Null and empty texts have no
    passages and get the lowest score. Repeated labels of an id: the highest
    holds. Without labelled rows of both kinds, every score is 0. Repeated
    rows are scored each. Columns other than ``keep`` are dropped, so extra
    columns cannot clash.

    Returns: ``keep`` (default: the id), score, predicted, passages (start and
    end in code points, score in nats of surprise).
    """
    keep = keep or [doc_id]
    model = learned(docs, labels, learn, doc_id, text, label, rows, entries)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        fitted = sent.value
        scores = Scores(fitted.known) if fitted else None

        def batch(cells: dict[str, list]) -> dict[str, list]:
            out = {k: cells[k] for k in keep} | {"score": [], "predicted": [], "passages": []}
            for body in cells["_body"]:
                low = (body or "").lower()
                words = WORD.findall(low)
                found = passages(words, scores) if fitted else []
                chance = fitted.chance(fitted.features(found, len(words))) if fitted else 0.0
                named = []
                if found:
                    at = [m.span() for m in WORD.finditer(low)]
                    named = [
                        {"start": at[a][0], "end": at[b - 1][1], "surprise": x}
                        for a, b, s in found if (x := fitted.surprise(s, len(words))) > SIGNIFICANT
                    ]
                out["score"].append(chance)
                out["predicted"].append(int(chance >= threshold))
                out["passages"].append(named)
            return out

        return batch

    given = docs.select(*keep, F.col(text).alias("_body"))
    schema = ", ".join(f"`{k}` {given.schema[k].dataType.simpleString()}" for k in keep)
    return by_batch(given, make, f"{schema}, score double, predicted int, passages array<struct<start: int, end: int, surprise: double>>")
