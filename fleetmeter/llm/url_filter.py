"""URL filter: rules by host and path, and a logistic regression for all other urls.

The regression is over hashed character n-grams of host and path, fitted on a small table of
labelled urls. Its score is a sum over n-grams, so a url is scored by adding up weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmeter.llm.arrow_text import Text, mix, text_runs
from fleetmeter.workers import map_batches

NGRAMS = (3, 4, 5)
BITS = 14
BLOCK, ALLOW = "block", "allow"
# A labelled table is read by the driver, at most this many rows of it.
MAX_LABELLED = 100_000


class Rule(NamedTuple):
    """Fits a host and its subdomains, for paths that begin with ``path``."""

    host: str
    path: str
    verdict: str

    def __str__(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = [
    Rule("net", "/", BLOCK),
    Rule("example.net", "/en/", ALLOW),
    Rule("example.com", "/de/", BLOCK),
    Rule("org", "/fr/", ALLOW),
]

# Words of unwanted and of ordinary site names.
UNWANTED = """casino poker bets betting gambling jackpot slots lottery roulette adult porn xxx sex
escort webcam pills viagra pharmacy cheap free win bonus spam farm click track tracker ads adserver
loans payday crack warez torrent replica hack malware phishing scam""".split()
ORDINARY = """news docs wiki library museum school college science physics history garden
kitchen recipes travel maps weather music cinema theatre sports health doctor clinic nature animals
forest river mountain city council court law energy water bridge road train airport market bakery
flowers books letters poems language grammar dictionary university institute academy journal
archive gallery studio workshop factory harbour island village castle church temple bank insurance
house family children student teacher writer painter engineer software hardware network database
computer mobile camera radio television newspaper magazine festival concert orchestra football
tennis bicycle running swimming hiking cooking knitting drawing heating rentals""".split()
# The most frequent letter groups of English: names made of them are ordinary too.
LETTER_GROUPS = """th he in er an re nd on en at ou ed ha to or it is hi es ng st ti al ar te se
the and ing ion tio ent ati for her ter hat tha ere ate his con res ver all""".split()
MADE_UP = 2_400


def labelled_urls() -> list[tuple[str, int]]:
    """The small labelled table: urls and 1 for those to block. Unwanted words stand alone, in
    pairs and with a suffix; ordinary ones in the same forms, so that forms tell nothing. Made-up
    names of two to four letter groups show the model that an unknown name is ordinary."""
    pages = ["/", "/en/12", "/de/204.html", "/fr/7?page=2", "/es/990/", "/a/b/c.html"]
    tops = ["com", "org", "net", "example.com", "example.org", "example.net"]
    front = ["", "www.", "blog.", "m."]
    rows = []
    for label, words in ((1, UNWANTED), (0, ORDINARY)):
        for i, word in enumerate(words):
            other = words[(i * 7 + 3) % len(words)]
            for j, name in enumerate((word, f"{word}-{other}", f"{other}-{word[0]}", word + other)):
                for k, before in enumerate(front, i + j):
                    rows.append((f"https://{before}{name}.{tops[k % 6]}{pages[k // 6 % 6]}", label))
    draws = mix(np.arange(MADE_UP * 4, dtype=np.uint64)).reshape(MADE_UP, 4) >> np.uint64(40)
    for k, draw in enumerate(draws.tolist()):
        name = "".join(LETTER_GROUPS[d % len(LETTER_GROUPS)] for d in draw[: 2 + k % 3])
        rows.append((f"https://{front[k % 4]}{name}.{tops[k % 6]}{pages[k // 3 % 6]}", 0))
    return rows


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty for
    a null url or one without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty like the host."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[Rule] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both NULL if none does. A few rules are a
    chain of conditions, from the longest to the shortest; ties by name."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(str(r)), str(r))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule = F.when(fits, F.lit(str(r))).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def _features(run: Text, salt: int, ngrams: tuple[int, ...], bits: int) -> tuple[np.ndarray, ...]:
    """Row and hashed feature of every n-gram of the bytes, with a mark at both ends."""
    n = run.rows
    size = np.diff(run.edges) + 2
    begin = np.concatenate([[0], np.cumsum(size)])
    data = np.full(begin[-1], 2, dtype=np.uint64)  # a byte that no text has
    inside = np.ones(begin[-1], dtype=bool)
    inside[begin[:-1]] = inside[begin[1:] - 1] = False
    data[inside] = run.data
    row = np.repeat(np.arange(n), size)
    rows, features = [], []
    for width in ngrams:
        count = len(data) - width + 1
        if count <= 0:
            continue
        value = np.zeros(count, dtype=np.uint64)
        for i in range(width):
            value = value * np.uint64(257) + data[i : i + count]
        whole = row[:count] == row[width - 1 :]
        hashed = mix(value[whole] + np.uint64(salt * 64 + width) * np.uint64(1 << 56))
        rows.append(row[:count][whole])
        features.append((hashed >> np.uint64(64 - bits)).astype(np.int64))
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *rows]), np.concatenate([none, *features])


class UrlModel(NamedTuple):
    weights: np.ndarray
    bias: float
    ngrams: tuple[int, ...]
    bits: int

    def scores(self, hosts: pa.Array, paths: pa.Array) -> np.ndarray:
        """The probability that each url is to be blocked."""
        total = np.full(len(hosts), self.bias)
        for salt, column in enumerate((hosts, paths)):
            for run in text_runs(column):
                row, feature = _features(run, salt, self.ngrams, self.bits)
                total[run.first : run.first + run.rows] += np.bincount(
                    row, self.weights[feature], run.rows
                )
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(
    hosts: list[str],
    paths: list[str],
    labels: list[int],
    ngrams: tuple[int, ...] = NGRAMS,
    bits: int = BITS,
    penalty: float = 0.02,
    rounds: int = 600,
    blocked_weight: float = 1.0,
) -> UrlModel:
    """Logistic regression with an L2 penalty by gradient descent with step sizes per weight.
    A url to block counts ``blocked_weight`` times. No row may lack a label."""
    rows, features = [], []
    for salt, values in enumerate((hosts, paths)):
        for run in text_runs(pa.array(values, pa.large_string())):
            row, feature = _features(run, salt, ngrams, bits)
            rows.append(row + run.first)
            features.append(feature)
    row, feature = np.concatenate(rows), np.concatenate(features)
    y = np.array(labels, dtype=float)
    share = np.where(y == 1, blocked_weight, 1.0) / max(len(y), 1)
    weights, bias, seen = np.zeros(1 << bits), 0.0, np.full(1 << bits, 1e-8)
    for _ in range(rounds):
        z = bias + np.bincount(row, weights[feature], len(y))
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * share
        gradient = np.bincount(feature, error[row], 1 << bits) + penalty * weights / len(y)
        seen += gradient**2
        weights -= 0.1 * gradient / np.sqrt(seen)
        bias -= 0.5 * error.sum()
    return UrlModel(weights.astype(np.float32).astype(float), bias, ngrams, bits)


@lru_cache(maxsize=1)
def _default_model() -> UrlModel:
    return _fit_urls(labelled_urls())


def _fit_urls(rows: list[tuple[str, int]]) -> UrlModel:
    cut = [(url.split("://", 1)[1], label) for url, label in rows if url and "://" in url]
    hosts, paths = [], []
    for rest, _ in cut:
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        hosts.append(rest[:end].lower())
        paths.append(rest[end:].split("?")[0].split("#")[0])
    return fit(hosts, paths, [label for _, label in cut])


def train(labelled: DataFrame, url: str = "url", label: str = "label") -> UrlModel:
    """A model from a table of urls labelled 1 (block) or 0, of which the driver reads at most
    ``MAX_LABELLED`` rows, those of smallest hash. Null urls or labels are left out."""
    rows = labelled.select(F.col(url), F.col(label).cast("int")).dropna()
    rows = rows.orderBy(F.xxhash64(url), url).limit(MAX_LABELLED).collect()
    return _fit_urls([(r[0], r[1]) for r in rows])


def judged(
    pages: DataFrame,
    rules: list[Rule] = RULES,
    model: UrlModel | None = None,
    url: str = "url",
    limit: float = 0.5,
) -> DataFrame:
    """All rows and columns of ``pages`` with ``host``, ``path``, ``rule`` (null if none fits),
    ``score`` (probability to be unwanted, by the model) and ``verdict``: the rule's, else block
    from ``limit`` on. Columns of these names are replaced. A url that is null or has no ``://``
    has an empty host and path, which no rule fits and the model scores as any other."""
    model = model or _default_model()
    added = ["host", "path", "rule", "score", "verdict"]
    kept = [c for c in pages.columns if c not in added]
    rows = pages.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(batch.column("host"), batch.column("path"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "score"],
            )

    schema = T.StructType([*rows.schema, T.StructField("score", T.DoubleType())])
    rows = map_batches(rows, score, schema)
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("score") >= limit, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return rows.select(
        *kept, "host", "path", rule.alias("rule"), "score", F.coalesce(verdict, learned).alias("verdict")
    )
