"""Quality rules by weak supervision.

Each rule looks at one measure of a text and votes good (1), bad (-1) or abstains (0). How often
each rule is right is unknown; expectation-maximisation estimates it from how the rules agree,
together with the share of good texts. The posterior probability that a text is good then decides,
in place of a filter that every rule must pass.

EM only needs the number of texts with each pattern of votes, counted over all rows: at most
3 ** (number of rules) rows reach the driver, whatever the input. A rule that never votes keeps
its prior accuracy. Words are runs of anything but space and U+0009 to U+000D.

A null or empty text has no words: all measures 0, `base_failed` true, not kept. Repeated rows and
ids come back as often as they occur; an empty table gives no rows. Other columns pass through
`filtered` untouched; the measures travel in one column with a name of its own.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from hirefunnel.llm.common import BLANKS, STOP_WORDS, each_batch, stored, utf8, without

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_lower",
    "n_stop_words",
)
OWN = "__quality"
_BLANK = BLANKS.encode()
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_STOP = frozenset(w.encode() for w in STOP_WORDS)


def measures(text: bytes) -> list[int]:
    """The measures of one text, in the order of MEASURES."""
    words = text.split()
    n = len(words)
    if not n:
        return [0, 0, len(text) - len(text.translate(None, _SYMBOLS)), 0, 0, 0, 0, 0, 0]
    points = len(text.decode("utf-8", "replace"))
    ids: dict[bytes, int] = {}
    sequence = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    lines = [line for line in text.split(b"\n") if line.strip()]
    stop = np.bincount(sequence)[[i for w, i in ids.items() if w in _STOP]].sum()
    return [
        n,
        points - (len(text) - len(text.translate(None, _BLANK))),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(sequence),
        len(lines),
        len(text) - len(text.translate(None, _UPPER)),
        len(text) - len(text.translate(None, _LOWER)),
        int(stop),
    ]


def repeated_words(sequence: np.ndarray, window: int = 8) -> int:
    """Words that lie in a window of `window` words (a power of two) which occurs again."""
    n = len(sequence)
    if n <= window:
        return 0
    # Prefix doubling: equal numbers stand for equal windows of 1, 2, 4, ... words.
    size, same = 1, sequence
    while size < window:
        pairs = same[:-size] * np.int64(n + 1) + same[size:]
        _, same = np.unique(pairs, return_inverse=True)
        size *= 2
    found = np.flatnonzero(np.bincount(same)[same] > 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, found, 1)
    np.add.at(edge, found + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


@dataclass(frozen=True)
class Rule:
    """Votes good where `good` holds, else bad where `bad` holds, else abstains."""

    name: str
    good: Column
    bad: Column

    def vote(self) -> Column:
        return F.when(self.good, 1).when(self.bad, -1).otherwise(0).alias(self.name)


def rules() -> list[Rule]:
    m = {k: F.col(f"{OWN}.{k}") for k in MEASURES}
    words = F.greatest(m["n_words"], F.lit(1))
    letters = F.greatest(m["n_upper"] + m["n_lower"], F.lit(1))
    return [
        Rule("length", m["n_words"] >= 40, m["n_words"] < 20),
        Rule("symbols", m["n_symbols"] * 50 <= words, m["n_symbols"] * 10 > words),
        Rule("dup_lines", m["n_dup_lines"] * 20 <= m["n_lines"], m["n_dup_lines"] * 10 > m["n_lines"] * 3),
        Rule("repeats", m["n_repeat_words"] * 20 <= words, m["n_repeat_words"] * 5 > words),
        Rule(
            "word_length",
            m["word_chars"].between(3 * words, 9 * words),
            (m["word_chars"] < 2 * words) | (m["word_chars"] > 15 * words),
        ),
        Rule("upper", m["n_upper"] * 10 <= letters * 2, m["n_upper"] * 2 > letters),
        Rule("stop_words", m["n_stop_words"] * 20 >= words, m["n_stop_words"] * 50 < words),
    ]


def base_failed() -> Column:
    m = {k: F.col(f"{OWN}.{k}") for k in MEASURES}
    return (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])


@dataclass(frozen=True)
class Model:
    """share: of good texts. good, bad: by rule, how likely a good and a bad text gets each vote.

    A rule's accuracies are good[k][1], how often it recognises a good text, and bad[k][-1], how
    often it recognises a bad one. Both kinds are kept apart, because most rules look for one
    defect: finding it says much, not finding it says little.
    """

    share: float
    good: tuple[dict[int, float], ...]
    bad: tuple[dict[int, float], ...]

    def score(self, votes: tuple[int, ...]) -> float:
        evidence = zip(votes, self.good, self.bad, strict=True)
        return log(self.share / (1 - self.share)) + sum(log(g[v] / b[v]) for v, g, b in evidence)

    def posterior(self, votes: list[Column]) -> Column:
        score = F.lit(log(self.share / (1 - self.share)))
        for vote, g, b in zip(votes, self.good, self.bad, strict=True):
            weight = {v: log(g[v] / b[v]) for v in (1, 0, -1)}
            score += F.when(vote == 1, weight[1]).when(vote == -1, weight[-1]).otherwise(weight[0])
        return 1 / (1 + F.exp(-score))


#: What is believed of every rule before any text is seen, and how many texts that is worth.
PRIOR_GOOD = {1: 0.80, 0: 0.18, -1: 0.02}
PRIOR_BAD = {1: 0.40, 0: 0.25, -1: 0.35}
PRIOR_TEXTS = 2.0


def fit(patterns: list[tuple[tuple[int, ...], int]], n_rules: int, rounds: int = 500) -> Model:
    """EM over (votes, number of texts)."""
    model = Model(0.9, (PRIOR_GOOD,) * n_rules, (PRIOR_BAD,) * n_rules)
    total = sum(n for _, n in patterns)
    for _ in range(rounds if total else 0):
        sums = [[{v: PRIOR_TEXTS * p[v] for v in p} for _ in range(n_rules)] for p in (PRIOR_GOOD, PRIOR_BAD)]
        good = 0.0
        for votes, n in patterns:
            p = 1 / (1 + exp(-model.score(votes)))
            good += n * p
            for k, v in enumerate(votes):
                sums[0][k][v] += n * p
                sums[1][k][v] += n * (1 - p)
        scaled = [tuple({v: x / sum(d.values()) for v, x in d.items()} for d in s) for s in sums]
        share = min(max((good + 0.9 * PRIOR_TEXTS) / (total + PRIOR_TEXTS), 0.05), 0.99)
        before, model = model, Model(share, *scaled)
        if abs(model.share - before.share) < 1e-10:
            break
    return model


def measured(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with their measures in one more column."""
    at = rows.columns.index(text_col)
    own = StructType([StructField(m, LongType()) for m in MEASURES])
    schema = StructType([*rows.schema.fields, StructField(OWN, own)])

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [measures(t) for t in utf8(batch.column(at))]
        columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
        struct = pa.StructArray.from_arrays(columns, names=list(MEASURES))
        return pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, OWN])

    return each_batch(rows, make, schema)


def fitted(measured_rows: DataFrame) -> Model:
    """The model of the votes of all rows; one row per pattern of votes reaches the driver."""
    votes = [r.vote() for r in rules()]
    counted = measured_rows.groupBy(*votes).count().collect()
    patterns = sorted((tuple(r[:-1]), r[-1]) for r in counted)
    return fit(patterns, len(votes))


def judged(measured_rows: DataFrame, model: Model) -> DataFrame:
    """The rows with posterior, base_failed and kept beside the measures in the same column."""
    posterior = model.posterior([r.vote() for r in rules()])
    return measured_rows.withColumn(
        OWN,
        F.col(OWN)
        .withField("posterior", posterior)
        .withField("base_failed", base_failed())
        .withField("kept", ~base_failed() & (posterior >= 0.5)),
    )


def scored(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, measures, base_failed, posterior, kept."""
    source = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = stored(measured(source).drop("text"), "quality")
    found = judged(found, fitted(found))
    return found.select(F.col("id").alias(id_col), f"{OWN}.*")


def filtered(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that are kept, with all their columns.

    Those that go are taken out by their ids. Where ids repeat, texts are measured once for the model
    and once more to be judged with their rows, whose columns go by their places then.
    """
    if rows.groupBy(f"`{id_col}`").count().where("count > 1").isEmpty():
        return without(rows, id_col, scored(rows, id_col, text_col).where("NOT kept").select(id_col))
    plain = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    text = f"c{rows.columns.index(text_col)}"
    model = fitted(measured(plain.select(text), text))
    return judged(measured(plain, text), model).where(F.col(f"{OWN}.kept")).drop(OWN).toDF(*rows.columns)
