"""Language identification with error-correcting output codes.

Each language has a codeword. One binary classifier over hashed character
n-grams predicts each bit, and loss-weighted decoding picks the language whose
codeword costs least; a small lead over the second is flagged as ambiguous.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buildmend.llm.common import bounded_sample, by_batch

#: Buckets of hashed n-grams of one to three characters.
BUCKETS = 1 << 15
#: Most languages for which every split into two sides is a bit of the code.
EXHAUSTIVE = 5
#: Lead in mean loss below which the second language could be it as well.
AMBIGUOUS = 0.1


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """A k x bits matrix of -1 and 1.

    Few languages take all different splits; more take the random code with
    the largest least distance out of 64 draws. One language has no bits.
    """
    if k < 2:
        return np.zeros((k, 0))
    if k <= EXHAUSTIVE:
        splits = [s for n in range(1, k) for s in combinations(range(k), n) if 0 in s]
        return np.array([[1.0 if row in s else -1.0 for s in splits] for row in range(k)])
    rng, bits, best, most = np.random.default_rng(seed), int(np.ceil(12 * np.log2(k))), None, -1.0
    for _ in range(64):
        code = rng.choice([-1.0, 1.0], size=(k, bits))
        code = code[:, np.abs(code.sum(axis=0)) < k]
        far = min(float((code[i] != code[j]).sum()) for i, j in combinations(range(k), 2))
        if far > most:
            best, most = code, far
    return best


#: Characters of a text that are in arrays at a time.
PIECE = 1 << 20
LETTER = np.array([not 0xD800 <= c < 0xE000 and chr(c).isalpha() for c in range(0x110000)])
SHIFT = np.uint32(32 - int(np.log2(BUCKETS)))


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed n-grams of a text in lower case, by bucket.

    A run of other characters counts as one space. All are 0 for a text
    without letters. Long texts are counted piece by piece.
    """
    total, has = np.zeros(BUCKETS, dtype=np.int64), False
    for start in range(0, len(text), PIECE):
        part = " " + text[start : start + PIECE].lower() + " "
        code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = LETTER[code]
        has = has or bool(letter.any())
        kept = letter.copy()
        kept[1:] |= letter[:-1]
        code = np.where(letter, code, np.uint32(32))[kept]
        h1 = code * np.uint32(0x9E3779B1)
        h2 = (h1[:-1] ^ (code[1:] * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35)
        h3 = (h2[:-1] ^ (code[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
        for h in (h1[code != 32], h2, h3):
            total += np.bincount(h >> SHIFT, minlength=BUCKETS)
    return total if has else total * 0


def shares(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(counts / max(1, counts.sum())) * 4


def counted(docs: DataFrame) -> DataFrame:
    """Buckets of each text and what they count."""

    def make():
        def batch(rows: dict[str, list]) -> dict[str, list]:
            out = {"lang": rows["lang"], "buckets": [], "values": []}
            for text in rows["body"]:
                n = gram_counts(text or "")
                at = np.flatnonzero(n)
                out["buckets"].append(at.astype(np.int32))
                out["values"].append(shares(n)[at].astype(np.float32))
            return out

        return batch

    return by_batch(docs, make, "lang string, buckets array<int>, values array<float>")


def train(rows: list, langs: list[str], steps: int = 60, rate: float = 2.0, decay: float = 1e-6) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codewords, weights (buckets x bits) and offsets of the bit classifiers.

    Logistic regression on square roots of n-gram shares, balanced by
    language, with AdaGrad over whole passes.
    """
    code = codewords(len(langs))
    at = np.concatenate([np.array(r["buckets"], dtype=np.int64) for r in rows])
    value = np.concatenate([np.array(r["values"], dtype=np.float64) for r in rows])
    sizes = np.array([len(r["buckets"]) for r in rows])
    row = np.repeat(np.arange(len(rows)), sizes)
    y = np.array([langs.index(r["lang"]) for r in rows])
    balance = 1.0 / np.maximum(1, np.bincount(y, minlength=len(langs)))[y] / len(langs)
    used, at = np.unique(at, return_inverse=True)
    weights, offsets = np.zeros((len(used), code.shape[1])), np.zeros(code.shape[1])
    for bit in range(code.shape[1]):
        target, w, b, seen, seen_b = code[y, bit], np.zeros(len(used)), 0.0, np.full(len(used), 1e-8), 1e-8
        for _ in range(steps):
            margin = np.bincount(row, weights=value * w[at], minlength=len(rows)) + b
            slope = -target * balance / (1 + np.exp(np.clip(target * margin, -30, 30)))
            g = np.bincount(at, weights=value * slope[row], minlength=len(used)) + decay * w
            seen += g * g
            w -= rate * 0.1 * g / np.sqrt(seen)
            seen_b += slope.sum() ** 2
            b -= rate * 0.1 * slope.sum() / np.sqrt(seen_b)
        weights[:, bit], offsets[bit] = w, b
    full = np.zeros((BUCKETS, code.shape[1]))
    full[used] = weights
    return code, full.astype(np.float32), offsets


def losses(margins: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Mean logistic loss of each codeword, each bit weighted by its certainty."""
    certain = np.abs(np.tanh(margins / 2)) + 1e-3
    cost = np.log1p(np.exp(-np.clip(margins[:, None, :] * code[None, :, :], -30, 30)))
    return (cost * certain[:, None, :]).sum(axis=2) / certain.sum(axis=1)[:, None]


def predict(texts: list[str], langs: list[str], code: np.ndarray, weights: np.ndarray, offsets: np.ndarray):
    """(language, score, ambiguous) of each text."""
    found = []
    for text in texts:
        n = gram_counts(text)
        if not langs or not n.any():
            found.append(("und", 0.0, False))
        elif len(langs) == 1:
            found.append((langs[0], 1.0, False))
        else:
            at = np.flatnonzero(n)
            margins = (shares(n)[at].astype(np.float32) @ weights[at]).astype(np.float64) + offsets
            cost = losses(margins[None, :], code)[0]
            share = np.exp(-4 * (cost - cost.min()))
            best, second = np.argsort(cost, kind="stable")[:2]
            found.append((langs[best], float(share[best] / share.sum()), bool(cost[second] - cost[best] < AMBIGUOUS)))
    return found


def languages(
    docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    keep: list[str] | None = None, rows: int = 500, most_languages: int = 200,
) -> DataFrame:
    """Predict the language of every whole text.

    The classifiers learn from rows for which ``learn`` holds and ``lang`` is
    given: about ``rows`` of each language (a bound on what reaches the
    driver, with at most ``BUCKETS`` numbers a row). Null texts and texts
    without a letter are ``und`` with score 0. With nothing to learn from all
    are ``und``. Ties go to the language first in order. Repeated rows are
    predicted each. Columns other than ``keep`` are dropped, so extra columns
    cannot clash.

    Returns: ``keep`` (default: the id), lang_pred, score, ambiguous.
    """
    keep = keep or [doc_id]
    known = docs.filter(learn & F.col(lang).isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).limit(most_languages + 1).collect()}
    if len(sizes) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    sample = bounded_sample(known, rows, lang, sizes, 11, doc_id) if sizes else known.limit(0)
    drawn = [r for r in counted(sample.select(F.col(lang).alias("lang"), F.col(text).alias("body"))).collect() if r["buckets"]] if sizes else []
    langs = sorted({r["lang"] for r in drawn})
    code, weights, offsets = train(drawn, langs) if drawn else (np.zeros((0, 0)), np.zeros((BUCKETS, 0)), np.zeros(0))
    model = docs.sparkSession.sparkContext.broadcast((langs, code, weights, offsets))

    def make():
        learned = model.value

        def batch(cells: dict[str, list]) -> dict[str, list]:
            found = predict([t or "" for t in cells["_body"]], *learned)
            out = {k: cells[k] for k in keep}
            return out | {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found], "ambiguous": [f[2] for f in found]}

        return batch

    given = docs.select(*keep, F.col(text).alias("_body"))
    schema = ", ".join(f"`{k}` {given.schema[k].dataType.simpleString()}" for k in keep)
    return by_batch(given, make, f"{schema}, lang_pred string, score double, ambiguous boolean")
