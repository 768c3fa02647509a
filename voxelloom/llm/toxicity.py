"""Toxicity: a counterfactual-regularised classifier.

Logistic regression on words and their beginnings of 4 to 7 letters (hashed): whether they occur, in two different words or more, and in a
fiftieth of the different words or more; with the penalty
COUNTERFACTUAL x mean of (logit of a text that names a group - logit of the text that names another)^2 and of (logit of a text that names a group - logit of the text that names none)^2
beside an L2 penalty. A labelled text with identity terms is compared with itself after its terms are swapped, and after they are taken out; one without gets a mention, of a row of the lexicon that
the text's hash picks, and is compared with itself after that mention is swapped, and with itself as it is. So every labelled text takes part, and the words and word beginnings that only name a group
lose their influence, whatever the labels' correlation with them: neutral mentions of groups aren't taken for attacks. The lexicon is a parameter; IDENTITY has one for each of four languages.

Fitting uses a bounded sample: the FIT_ROWS labelled rows with the smallest hash of their id, out of those whose crc32(doc_id as text)
mod 4 is not 2; of several texts of an id it takes the one of the least hash. Features whose association with the label could be chance (G² below LEAST_G2) are left out but for identity terms, and
at most MOST_FEATURES are weighed, those of the strongest association (ties: the lower hash). Scoring reads every whole text, of any length, in one scan without a shuffle; only the weights go to the tasks.

Cases: an empty table gives no rows; a null text is the empty text, and scores like any text without known features; labels that are null are left out; of several labels
of a document the highest counts; without labels of both kinds the score is the smoothed share of toxic ones, 0 where there are none.
Repeated rows get equal scores. Extra columns are kept; those named like the score or the prediction are replaced.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, columns, ddl, others, texts

#: Labelled rows that the fit uses at most, and features at most (those of the strongest association).
FIT_ROWS, MOST_FEATURES = 8000, 3000
BITS, LEAST_G2, L2, COUNTERFACTUAL, THRESHOLD = 20, 12.0, 3e-5, 10.0, 0.3
#: Lengths of the beginnings of words, and one of how many words makes a feature dense. They, LEAST_G2 and L2 made the fewest errors at THRESHOLD in a cross-validation over rows to learn from.
BEGINNINGS, DENSE = (4, 5, 6, 7), 50

#: Identity terms by language. A swap puts the next of its row in a term's place.
IDENTITY = {
    "en": [
        ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"), ("wife", "husband"),
        ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
        ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"), ("black", "white", "asian", "latino"),
        ("african", "european", "american", "mexican", "chinese", "indian", "arab"), ("immigrants", "natives"), ("immigrant", "native"),
        ("old", "young"), ("elderly", "teenagers"), ("deaf", "blind", "disabled"), ("rich", "poor"), ("refugees", "residents"),
    ],
    "de": [
        ("frauen", "männer"), ("frau", "mann"), ("mädchen", "jungen"), ("muslime", "christen", "juden"), ("muslimisch", "christlich", "jüdisch"), ("schwule", "lesben", "heterosexuelle"),
        ("ausländer", "einheimische"), ("flüchtlinge", "anwohner"), ("türken", "polen", "deutsche", "franzosen"), ("alte", "junge"), ("blinde", "gehörlose", "behinderte"), ("reiche", "arme"),
    ],
    "fr": [
        ("femmes", "hommes"), ("femme", "homme"), ("filles", "garçons"), ("musulmans", "chrétiens", "juifs"), ("homosexuels", "lesbiennes", "hétérosexuels"), ("noirs", "blancs", "asiatiques"),
        ("étrangers", "habitants"), ("réfugiés", "riverains"), ("africains", "européens", "américains", "arabes"), ("vieux", "jeunes"), ("aveugles", "sourds", "handicapés"), ("riches", "pauvres"),
    ],
    "es": [
        ("mujeres", "hombres"), ("mujer", "hombre"), ("niñas", "niños"), ("musulmanes", "cristianos", "judíos"), ("homosexuales", "lesbianas", "heterosexuales"), ("negros", "blancos", "asiáticos"),
        ("extranjeros", "vecinos"), ("refugiados", "residentes"), ("africanos", "europeos", "americanos", "árabes"), ("viejos", "jóvenes"), ("ciegos", "sordos", "discapacitados"), ("ricos", "pobres"),
    ],
}
_WORD = re.compile(r"[^\W_]+")


def rows_of(identity: dict[str, list[tuple[str, ...]]]) -> list[tuple[str, ...]]:
    """The rows of all languages; a term counts in the first row that has it."""
    seen: set[str] = set()
    out = []
    for row in (r for language in identity.values() for r in language):
        out.append(tuple(t for t in row if t not in seen))
        seen.update(row)
    return [r for r in out if len(r) > 1]


def swapped(ws: set[str], rows: list[tuple[str, ...]], swap: dict[str, str], h: int) -> tuple[set[str], set[str], set[str]]:
    """A text's words without a mention of groups, with one, and with one of other groups; h (the text's hash) picks the mention of a text that has none."""
    if ws & swap.keys():
        return ws - swap.keys(), ws, {swap.get(w, w) for w in ws}
    row = rows[h % len(rows)]
    i = (h >> 20) % len(row)
    return ws, ws | {row[i]}, ws | {row[(i + 1) % len(row)]}


def _change(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The features that b has and a has not, and, as -1 - feature, those that only a has."""
    return np.concatenate([np.setdiff1d(b, a, assume_unique=True), -1 - np.setdiff1d(a, b, assume_unique=True)])


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def slots(word: str) -> list[int]:
    """The hashes of a word and its beginnings."""
    names = [f"w:{word}", *(f"{n}:{word[:n]}" for n in BEGINNINGS if len(word) > n)]
    return [xxhash.xxh32_intdigest(x.encode("utf-8", "surrogatepass")) >> (32 - BITS) for x in names]


_known_slots = functools.lru_cache(50_000)(slots)


def _planes(count: int, total: int) -> tuple[int, ...]:
    """Of a slot that count of a text's total different words have: the planes of its features (present, repeated, dense)."""
    return (0, *((1,) if count > 1 else ()), *((2,) if DENSE * count >= total else ()))


def features(ws: set[str]) -> np.ndarray:
    """The features of a text with these words: slot + plane << BITS."""
    counts = Counter(itertools.chain.from_iterable(map(_known_slots, ws)))
    return np.unique(np.array([s + (p << BITS) for s, c in counts.items() for p in _planes(c, len(ws))], np.int32))


@dataclass
class Model:
    """weights by feature, the intercept, how many comparisons the penalty made, in how many a known feature differs, and the mean square of the logits' differences."""

    weights: dict[int, float]
    bias: float
    n_compared: int = 0
    n_differing: int = 0
    gap: float = 0.0

    def __post_init__(self) -> None:
        self._slots = {f & ((1 << BITS) - 1) for f in self.weights}

    def logit(self, ws: set[str], known: dict[str, tuple[int, ...]]) -> float:
        found: Counter[int] = Counter()
        for w in ws:
            if (k := known.get(w)) is None:
                if len(known) >= 100_000:
                    known.clear()
                known[w] = k = tuple(s for s in slots(w) if s in self._slots)
            if k:
                found.update(k)
        return self.bias + sum(self.weights.get(s + (p << BITS), 0.0) for s, c in sorted(found.items()) for p in _planes(c, len(ws)))


def _parts(x: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """The rows of a matrix of small numbers as floats, a few hundred at a time: the driver never holds the whole as floats."""
    for i in range(0, len(x), 500):
        yield slice(i, i + 500), x[i : i + 500].astype(np.float32)


def _conjugate_gradients(a: np.ndarray, b: np.ndarray, rounds: int = 300, tolerance: float = 1e-4) -> np.ndarray:
    """x with a x near b, for a positive definite matrix, scaled by its diagonal; nothing of the matrix's size is made."""
    scale = 1 / a.diagonal().astype(float)
    x, r = np.zeros(len(b)), b.copy()
    z = scale * r
    d, now, end = z, float(r @ z), tolerance**2 * float(b @ (scale * b))
    for _ in range(rounds):
        if now <= end:
            break
        moved = (a @ d.astype(np.float32)).astype(float)
        step = now / float(d @ moved)
        x, r = x + step * d, r - step * moved
        z = scale * r
        before, now = now, float(r @ z)
        d = z + now / before * d
    return x


def _solve(x: np.ndarray, delta: np.ndarray, at: np.ndarray, y: np.ndarray, counterfactual: float) -> tuple[np.ndarray, float]:
    """Newton's method on mean log loss + L2 |w|² / 2 + counterfactual x mean over all texts of (delta w[at])² / 2. x, delta: a byte per feature; the last column of x is all ones; delta has the columns at of x, those that any comparison changes.

    The curvature is held in single precision and its equations are solved nearly: steps are close to Newton's, the loss and its slope are exact."""
    n, k = x.shape
    w = np.zeros(k)
    w[-1] = np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    block = np.zeros((len(at), len(at)))
    for _, part in _parts(delta):
        block += counterfactual / n * (part.T @ part)
    ridge = np.where(np.arange(k) < k - 1, L2, 1e-9)

    def pull(w: np.ndarray) -> np.ndarray:
        out = ridge * w
        out[at] += block @ w[at]
        return out

    logits = lambda w: np.concatenate([part @ w for _, part in _parts(x)])
    loss = lambda w, z: float((np.logaddexp(0, z) - y * z).mean() + w @ pull(w) / 2)
    z = logits(w)
    now = loss(w, z)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
        grad, curve = pull(w), np.zeros((k, k), np.float32)
        for rows, part in _parts(x):
            grad += part.T @ (p - y)[rows] / n
            weighed = part * (p * (1 - p) / n)[rows, None].astype(np.float32)
            for j in range(0, k, 400):  # the product in strips: no second matrix of k x k
                curve[:, j : j + 400] += part.T @ weighed[:, j : j + 400]
        curve[np.ix_(at, at)] += block
        curve[np.diag_indices(k)] += ridge
        step = _conjugate_gradients(curve, grad)
        del curve
        # Far from the optimum a whole step can raise the loss: halve it until it falls enough.
        size, along = 1.0, logits(step)
        while (then := loss(w - size * step, z - size * along)) > now - 1e-4 * size * (grad @ step) and size > 1e-6:
            size /= 2
        gain = now - then
        w, z, now = w - size * step, z - size * along, min(now, then)
        if np.abs(step).max() * size < 1e-6 or gain < 1e-9 * abs(now):
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", counterfactual: float = COUNTERFACTUAL, identity: dict[str, list[tuple[str, ...]]] | None = None) -> Model:
    """The classifier, from at most FIT_ROWS of the rows with labels. identity: rows of identity terms by language (IDENTITY unless given)."""
    rows_ = rows_of(IDENTITY if identity is None else identity)
    swap = {t: row[(i + 1) % len(row)] for row in rows_ for i, t in enumerate(row)}
    learn = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & (F.crc32(F.col(doc_id).cast("string")) % 4 != 2))
    sample = learn.groupBy(F.col(doc_id).alias("d")).agg(F.max(label).cast("int").alias("y")).orderBy(F.xxhash64("d"), "d").limit(FIT_ROWS)
    rows = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).join(F.broadcast(sample), "d")  # at most FIT_ROWS pairs of numbers
    # One text of an id, however many rows repeat it: the driver gets FIT_ROWS rows at most.
    rows = rows.groupBy("d", "y").agg(F.min(F.struct(F.xxhash64("t").alias("h"), "t")).alias("one")).select("y", "one.t")

    def one(batch: pa.RecordBatch):
        plain, named, swaps = [], [], []
        for t in texts(batch, "t"):
            ws = set(words(t))
            plain.append(features(ws))
            without, one_group, other = swapped(ws, rows_, swap, xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass"))) if rows_ else (ws, ws, ws)
            none, a, b = (plain[-1] if x is ws else features(x) for x in (without, one_group, other))
            named.append(_change(none, a))
            swaps.append(_change(a, b))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.list_(pa.int32())) for x in (plain, named, swaps))], names=["y", "plain", "named", "swaps"])

    got = arrow_map(rows, one, "y int, plain array<int>, named array<int>, swaps array<int>").toArrow()
    y = got.column("y").to_numpy().astype(float)
    n, pos = len(y), y.sum()
    if not 0 < pos < n:
        return Model({}, float(np.log((pos + 0.5) / (n - pos + 0.5))) if n else -40.0)
    plain, named, swaps = (_lists(got.column(c)) for c in ("plain", "named", "swaps"))
    # Rows in a fixed order, so that sums don't depend on how the tasks ran.
    order = sorted(range(n), key=lambda i: (y[i], len(plain[i]), xxhash.xxh3_64_intdigest(plain[i].tobytes())))
    del got
    identity_features = np.array(sorted({s + (p << BITS) for t in swap for s in slots(t) for p in range(3)}), np.int64)
    plain, changes = [plain[i] for i in order], [x[i] for i in order for x in (named, swaps)]
    del named, swaps
    return train(y[order], plain, changes, identity_features, counterfactual)


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column as views of its values."""
    out: list[np.ndarray] = []
    for chunk in column.chunks:
        values, ends = chunk.values.to_numpy(), chunk.offsets.to_numpy()
        out += [values[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    return out


def train(y: np.ndarray, plain: list[np.ndarray], changes: list[np.ndarray], named: np.ndarray, counterfactual: float = COUNTERFACTUAL) -> Model:
    """The classifier of rows with labels y (both kinds occur) and features (both lists are emptied on the way, to hold less); changes: of each comparison the features that come and, as -1 - feature, those that go; named: the features of identity terms."""
    n, pos = len(y), y.sum()
    a, b = np.zeros(3 << BITS, np.int32), np.zeros(3 << BITS, np.int32)
    for f, label in zip(plain, y, strict=True):
        (a if label else b)[f] += 1  # a text's features are distinct
    seen = np.flatnonzero(a + b)
    g2 = np.zeros(len(seen))
    for part, total in ((a[seen], pos), (b[seen], n - pos)):
        for got, have in ((part, a[seen] + b[seen]), (total - part, n - a[seen] - b[seen])):
            g2 += 2 * np.where(got > 0, got * np.log(np.maximum(got, 1e-12) / np.maximum(total * have / n, 1e-12)), 0)
    strong = seen[g2 >= LEAST_G2]
    strong = strong[np.lexsort((strong, -g2[g2 >= LEAST_G2]))][:MOST_FEATURES]
    chosen = np.unique(np.concatenate([strong, named[a[named] + b[named] > 0]]).astype(np.int64))
    del a, b, seen, g2, strong
    if not len(chosen):
        return Model({}, float(np.log((pos + 0.5) / (n - pos + 0.5))))
    place = np.full(3 << BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    x = np.zeros((n, len(chosen) + 1), np.int8)
    x[:, -1] = 1
    for i, s in enumerate(plain):
        here = place[s]
        x[i, here[here >= 0]] = 1
    plain.clear()
    # Comparisons change few features: only those columns are kept.
    at = place[np.unique(np.concatenate([np.where(s >= 0, s, -1 - s) for s in changes]))] if changes else np.empty(0, np.int32)
    at = np.sort(at[at >= 0])
    column = np.full(len(chosen), -1, np.int32)
    column[at] = np.arange(len(at))
    delta = np.zeros((len(changes), len(at)), np.int8)
    for i, s in enumerate(changes):
        here = place[np.where(s >= 0, s, -1 - s)]
        known = here >= 0
        delta[i, column[here[known]]] = np.where(s >= 0, 1, -1)[known]
    n_changes = len(changes)
    changes.clear()
    del place, column
    w, bias = _solve(x, delta, at, y, counterfactual)
    gaps = delta @ w[at] if len(at) else np.zeros(n_changes)
    return Model(dict(zip(chosen.tolist(), w.tolist(), strict=True)), bias, n_changes, int(delta.any(1).sum()), float((gaps**2).sum() / max(1, n_changes)))


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """docs with the score (0 to 1) and the prediction (1 from the threshold on)."""
    kept = others(docs, *names)
    known: dict[str, tuple[int, ...]] = {}

    def one(batch: pa.RecordBatch):
        z = np.array([model.logit(set(words(t)), known) for t in texts(batch, text)])
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        yield pa.RecordBatch.from_arrays([*columns(batch, kept), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=[*(f.name for f in kept), *names])

    return arrow_map(docs, one, ddl(kept, f"`{names[0]}` double", f"`{names[1]}` int"))
