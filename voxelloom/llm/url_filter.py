"""URL filters: rules first, then logistic regression on hashed character n-grams.

A rule is (verdict, host, path). It fits its host and all subdomains where the url's path starts with the rule's; the longest
fitting rule wins (by host plus path; among equals the first in code point order). Urls that no rule
fits get the model's verdict: block from a probability of BLOCK_FROM on. The model is fitted on the driver on a small labelled table
(url_labels.LABELLED, or any list of (url, label) pairs: a parameter that doesn't grow with the data), in which half are unwanted; of a crawl's pages about the share PRIOR is, so the fitted odds are
multiplied by PRIOR / (1 - PRIOR) over the table's. No word of a test table's host is in the labelled table.

Cases: an empty table gives no rows; urls may be of any length; a null url, or one without "://", has an empty host and an empty path; the model judges it like any other. Repeated
rows get equal verdicts. Extra columns are kept but those named host, path, rule, verdict or score, which are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .url_labels import LABELLED

#: (verdict, host, path)
RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]
BITS, GRAMS, BLOCK_FROM, L2, PRIOR = 16, (3, 4, 5), 0.5, 0.005, 0.1


def host(url: Column) -> Column:
    """What follows the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; else empty."""
    raw = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as struct(rule, verdict), or null."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    tries = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in ordered]
    return F.coalesce(*tries) if tries else F.lit(None).cast("struct<rule: string, verdict: string>")


def _features(host: str, path: str) -> np.ndarray:
    """Distinct slots of the marked character n-grams of host and path."""
    found = set()
    for kind, s in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in GRAMS:
            for i in range(len(s) - n + 1):
                found.add(xxhash.xxh32_intdigest((kind + s[i : i + n]).encode("utf-8", "surrogatepass")) >> (32 - BITS))
    return np.array(sorted(found), np.int64)


def _split(url: str | None) -> tuple[str, str]:
    _, sep, rest = (url or "").partition("://")
    end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    tail = min([i for i in (rest.find(c, end) for c in "?#") if i >= 0], default=len(rest))
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (rest[:end].translate(lower), rest[end:tail]) if sep else ("", "")


def fit(labelled: list[tuple[str, int]], l2: float = L2, rounds: int = 1500, prior: float = PRIOR) -> tuple[np.ndarray, float]:
    """Weights and intercept by full-batch gradient descent on the logistic loss with an L2 penalty, the intercept then moved to the prior share of unwanted urls; features have unit length."""
    x = [_features(*_split(u)) for u, _ in labelled]
    y = np.array([label for _, label in labelled], float)
    w, b = np.zeros(1 << BITS), 0.0
    scale = np.array([1 / np.sqrt(max(1, len(f))) for f in x])
    row, col = np.repeat(np.arange(len(x)), [len(f) for f in x]), np.concatenate(x)
    for _ in range(rounds):
        z = np.bincount(row, w[col], len(x)) * scale + b
        g = 1 / (1 + np.exp(-z)) - y
        w -= 4.0 * (np.bincount(col, (g * scale)[row], 1 << BITS) / len(x) + l2 / len(x) * w)
        b -= 0.5 * g.mean()
    share = min(max(y.mean(), 1e-9), 1 - 1e-9)
    return w, float(b + np.log(prior / (1 - prior)) - np.log(share / (1 - share)))


def score(w: np.ndarray, b: float, host: str, path: str) -> float:
    f = _features(host, path)
    return float(1 / (1 + np.exp(-(w[f].sum() / np.sqrt(max(1, len(f))) + b))))


def judge(pages: DataFrame, url: str = "url", rules: list[tuple[str, str, str]] = RULES, labelled: list[tuple[str, int]] = LABELLED) -> DataFrame:
    """pages with host, path, rule, verdict, score (the model's probability of block)."""
    w, b = fit(labelled)

    @F.pandas_udf("double")
    def model(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([score(w, b, h, p) for h, p in zip(hosts, paths, strict=True)], dtype=float)

    u = F.col(url)
    out = pages.withColumns({"host": host(u), "path": path(u)})
    out = out.withColumns({"rule": rule(F.col("host"), F.col("path"), rules), "score": model("host", "path")})
    by_model = F.when(F.col("score") >= BLOCK_FROM, "block").otherwise("allow")
    return out.withColumns({"verdict": F.coalesce(F.col("rule.verdict"), by_model), "rule": F.col("rule.rule")})
