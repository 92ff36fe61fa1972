"""URL filter: rules on host and path first, then logistic regression on hashed character n-grams.

The classifier is fitted on a small labelled table of URLs. At most ``max_rows`` of it are used, different ones
with the smallest hash of the URL; they and the weights (2 ** ``bits`` numbers) are all that the driver holds. Scoring is one
pass over the URLs without a shuffle.

Defined cases: a null URL, and one without ``://``, has an empty host and path, fits no rule, and is judged by the
model from its bias. Repeated rows are judged alike. Of rules that fit, the one with the longest text wins; of equally
long ones that with the longer host. With no labelled rows, or of one kind only, the model gives the kind at hand, and
``allow`` if there is none. Other columns are kept out of the result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activitymill.llm.words import mix
from activitymill.llm.work import bounded_sample

# Letters lower-cased in hosts.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def longest_rule(rules: Sequence[Rule]) -> Column:
    """The winning rule as a struct of text and verdict, from ``host`` and ``path``; null where none fits."""
    found = F.lit(None).cast("struct<text:string, verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text)):  # the last to fit wins
        under = (F.col("host") == r.host) | F.col("host").endswith("." + r.host)
        hit = F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))
        found = F.when(under & F.col("path").startswith(r.path), hit).otherwise(found)
    return found


def features(host: Sequence[str], path: Sequence[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed 3-, 4- and 5-grams of bytes of all hosts and paths: feature numbers, and the row of each."""
    found, rows = [], []
    for kind, values in enumerate((host, path)):
        parts = [b"\x02" + v.encode() + b"\x03" for v in values]
        data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        gram = data.copy()
        for n in range(2, 6):
            gram = gram[:-1] * np.uint64(0x100000001B3) + data[n - 1:] if len(gram) else gram
            if n > 2 and len(gram):
                inside = owner[:len(gram)] == owner[n - 1:]
                found.append(mix(gram[inside] + np.uint64(n * 2 + kind << 56)) & np.uint64((1 << bits) - 1))
                rows.append(owner[:len(gram)][inside])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found).astype(np.int64), np.concatenate(rows)


@dataclass(frozen=True)
class UrlModel:
    weights: np.ndarray
    bias: float
    bits: int

    def score(self, host: Sequence[str], path: Sequence[str]) -> np.ndarray:
        """Log-odds of ``block``."""
        idx, rows = features(host, path, self.bits)
        size = np.bincount(rows, minlength=len(host))
        total = np.bincount(rows, self.weights[idx], minlength=len(host))
        return total / np.sqrt(np.maximum(size, 1)) + self.bias


def fit(
    labelled: DataFrame, *, max_rows: int = 4096, bits: int = 16, rounds: int = 200, penalty: float = 1e-4
) -> UrlModel:
    """``labelled`` has ``url`` and ``block`` (boolean); rows without either are left out."""
    given = labelled.filter(F.col("url").isNotNull() & F.col("block").isNotNull()).select("url", "block")
    url = F.col("url")
    rows = bounded_sample(given, max_rows).select(
        host_of(url).alias("host"), path_of(url).alias("path"), "block"
    ).toPandas()
    weights, kinds = np.zeros(1 << bits), rows["block"].nunique()
    if kinds < 2:
        return UrlModel(weights, 1.0 if kinds and rows["block"].iloc[0] else -1.0, bits)
    y = rows["block"].to_numpy(float)
    idx, owner = features(rows["host"].tolist(), rows["path"].tolist(), bits)
    scale = (1 / np.sqrt(np.bincount(owner, minlength=len(y))))[owner]
    balance = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    bias, slope, step = 0.0, np.zeros(1 << bits), 2.0
    for t in range(rounds):  # accelerated gradient steps
        ahead = weights + slope * (t / (t + 3))
        margin = np.bincount(owner, ahead[idx] * scale, minlength=len(y)) + bias
        error = (1 / (1 + np.exp(-margin)) - y) * balance
        new = ahead - step * (np.bincount(idx, error[owner] * scale, minlength=1 << bits) + penalty * ahead)
        slope, weights = new - weights, new
        bias -= step * error.sum()
    return UrlModel(weights, float(bias), bits)


def judge(pages: DataFrame, model: UrlModel, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per page: page_id, host, path, the text of the rule that decides, the verdict, and the model's score."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # 2 ** bits numbers

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        own = shared.value
        for host, path in batches:
            yield pd.Series(own.score(host.tolist(), path.tolist()), dtype="float64")

    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    split = parts.select("page_id", F.coalesce("host", F.lit("")).alias("host"),
                         F.coalesce("path", F.lit("")).alias("path"))
    judged = split.withColumn("rule", longest_rule(rules)).withColumn("score", score("host", "path"))
    own = F.when(F.col("score") > 0, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("rule.text").alias("rule"),
        F.coalesce(F.col("rule.verdict"), own).alias("verdict"), "score",
    )


def labelled_by_rules(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """URLs that a rule decides, as a labelled table."""
    url = F.col("url")
    parts = pages.select("url", host_of(url).alias("host"), path_of(url).alias("path"))
    decided = parts.select("url", longest_rule(rules)["verdict"].alias("verdict"))
    return decided.filter(F.col("verdict").isNotNull()).select("url", (F.col("verdict") == "block").alias("block"))
