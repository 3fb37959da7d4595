"""URL filter: rules, and for the other urls logistic regression on hashed character n-grams.

A rule is ``host/path``: it fits its host and all subdomains of it when the url's
path starts with the rule's; of several the longest text wins.  Urls without a
fitting rule are judged by a logistic regression on the hashed n-grams (with their
ends marked) of host and path.  It learns from a small labelled url table; when none
is given, from the urls that rules decide: at most ``SAMPLE`` of each verdict,
chosen by a hash of the url.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histlens.llm.common import hash_sample, slices

ALLOW, BLOCK = "allow", "block"
Rules = list[tuple[str, str]]       # (verdict, "host/path")
SAMPLE = 2000
SLOTS = 1 << 14
SIZES = (3, 4, 5)
L2 = 1e-4


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; without :// empty."""
    rest = _rest(url)
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Rules) -> Column:
    """The text of the longest fitting rule, or null."""
    out = F.lit(None).cast("string")
    for _, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        h, _, p = text.partition("/")
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit("/" + p))
        out = F.when(fits, F.lit(text)).otherwise(out)
    return out


def grams(host: str, path: str, slots: int = SLOTS) -> np.ndarray:
    """Distinct hash slots of the n-grams of host and path."""
    out = set()
    for tag, s in (("h", host), ("p", path)):
        s = f"^{s}$"
        for n in SIZES:
            for i in range(max(1, len(s) - n + 1)):
                out.add(zlib.crc32(f"{tag}{s[i:i + n]}".encode("utf-8", "replace")) % slots)
    return np.fromiter(sorted(out), np.int64, len(out))


class Model:
    """Weights and bias; probability() that a url is to be blocked."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def probability(self, host: str, path: str) -> float:
        at = grams(host, path, len(self.weights))
        z = self.bias + self.weights[at].sum() / np.sqrt(max(1, len(at)))
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def fit(labelled: list[tuple[str, str, str]], slots: int = SLOTS, rounds: int = 300) -> Model:
    """Full-batch logistic regression on (host, path, verdict) rows; rows of both verdicts weigh alike.

    Without rows of one verdict all urls get the other one; without any, allow.
    """
    y = np.array([v == BLOCK for _, _, v in labelled], np.float64)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(slots), 1.0 if len(y) and y[0] else -1.0)
    rows = [grams(h, p, slots) for h, p, _ in labelled]
    col, row = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    val = np.repeat([1 / np.sqrt(len(r)) for r in rows], [len(r) for r in rows])
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w, bias = np.zeros(slots), 0.0
    m1, m2 = np.zeros(slots + 1), np.zeros(slots + 1)
    for t in range(1, rounds + 1):
        z = np.bincount(row, val * w[col], len(rows)) + bias
        e = (1 / (1 + np.exp(-z)) - y) * weight
        g = np.append(np.bincount(col, val * e[row], slots) + L2 * w, e.sum())
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        step = 0.1 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-9)
        w, bias = w - step[:-1], bias - step[-1]
    return Model(w, bias)


def decided_sample(urls: DataFrame, rules: Rules, per_verdict: int = SAMPLE) -> list[tuple[str, str, str]]:
    """A small labelled table: (host, path, verdict) of urls that rules decide, at most per_verdict of each."""
    verdicts = {text: v for v, text in rules}
    known = (urls.filter(F.col("rule").isNotNull()).select("host", "path", "rule").distinct()
             .withColumn("verdict", F.element_at(F.create_map(*[F.lit(x) for kv in verdicts.items() for x in kv]), F.col("rule"))))
    known = known.withColumn("h", F.xxhash64("host", "path"))
    pick = Window.partitionBy("verdict").orderBy(F.pmod("h", F.lit(1 << 31)), "host", "path")
    got = hash_sample(known, ["verdict"], "h", per_verdict).withColumn("k", F.row_number().over(pick)).filter(F.col("k") <= per_verdict)
    return [(r.host, r.path, r.verdict) for r in got.orderBy("verdict", "k").collect()]


def parts(pages: DataFrame, rules: Rules, url_col: str = "url", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns, host, path, rule."""
    out = pages.select(*[F.col(c) for c in keep], F.coalesce(host_of(F.col(url_col)), F.lit("")).alias("host"),
                       F.coalesce(path_of(F.col(url_col)), F.lit("")).alias("path"))
    return out.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))


def judge(pages: DataFrame, rules: Rules, labelled: list[tuple[str, str, str]] | None = None,
          url_col: str = "url", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``keep`` columns, host, path, rule, verdict and p_block (null where a rule decides), a row a page.

    A null url and one without :// have an empty host and path, fit no rule and are
    judged by the model like any other; an empty table gives an empty result.
    """
    split = parts(pages, rules, url_col, keep)
    model = fit(decided_sample(split, rules) if labelled is None else labelled)
    verdicts = {text: v for v, text in rules}
    shared = pages.sparkSession.sparkContext.broadcast((model.weights, model.bias, verdicts))       # SLOTS numbers and the rules
    out = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in split.schema.fields) + "verdict string, p_block double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, verdicts = shared.value
        model = Model(weights, bias)
        for b in slices(batches):
            host, path, rule = (b.column(b.num_columns - i).to_pylist() for i in (3, 2, 1))
            p = [None if r is not None else model.probability(h, q) for h, q, r in zip(host, path, rule)]
            v = [verdicts[r] if r is not None else BLOCK if x >= 0.5 else ALLOW for r, x in zip(rule, p)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(v, pa.string()), pa.array(p, pa.float64())], [*b.schema.names, "verdict", "p_block"])
    return split.mapInArrow(run, out)
