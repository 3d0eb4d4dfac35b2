"""Quality classifier: a sparse rule ensemble compiled into column expressions.

1. Statistics of whole texts (symbols, capitals, repeated words and lines,
   ...) are built-in functions, computed where the documents are read.
2. Spark ML grows shallow trees on the labelled rows' statistics.  Every path
   from a root to a node becomes a conjunctive rule.
3. A logistic regression with an L1 penalty gives the rules weights; most are
   zero.
4. The remaining rules become one Spark column expression over the statistics.

Only statistics and rules' truth values enter training; id, language, source
and labels are never inputs of a score.

Defined results: null text counts as empty; every document gets a score; words
are runs of anything but ASCII white space, and a text without words has all
statistics 0 but for its lines, of which every text has one at least; labels without document, null labels and labels
of null ids are ignored, a document labelled repeatedly has its smallest
label; without labelled rows of both classes every score is the smoothed share
of label 1, (n1 + 1) / (n + 2); repeated rows each give a row; an empty table
gives an empty table.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import materialise, sized, text_of

N_TREES = 24
MAX_DEPTH = 3
MIN_ROWS = 4
L1 = 0.002
SEED = 11
THRESHOLD = 0.5

#: Statistics in the order of the feature vector.
STATISTICS = (
    "words", "chars_per_word", "symbols_per_word", "digits_per_word", "shouts_per_word", "exclaims_per_word",
    "stops_per_word", "distinct_words", "distinct_lines", "words_per_line",
)


def with_statistics(rows: DataFrame, *carried: str) -> DataFrame:
    """Columns ``carried`` of ``rows`` and the statistics of its column ``text``.

    The statistics leave a generator of one row, through which the optimizer
    pushes no filter: a filter on a score would otherwise repeat every scan of
    the text for every rule that uses its result.
    """
    def sizes(pieces: Column, empty: bool) -> Column:
        # bound by a lambda, so that the text is split once; white space at the ends leaves empty pieces
        pieces = pieces if empty else F.array_remove(pieces, "")
        found = F.transform(F.array(pieces), lambda p: F.struct(F.size(p).alias("n"), F.size(F.array_distinct(p)).alias("kinds")))
        return F.element_at(found, 1)

    def count(pattern: str) -> Column:
        return F.regexp_count("text", F.lit(pattern))

    counts = {
        "words": sizes(F.split("text", r"[\x20\x09-\x0D]+"), empty=False),
        "lines": sizes(F.split("text", "\n"), empty=True),
        "chars": F.length("text"),
        "symbols": count(r"[#*$%&|<>]"),
        "digits": count(r"[0-9]"),
        "shouts": count(r"\p{Lu}{2,}"),
        "exclaims": count(r"[!?]"),
        "stops": count(r"[.,;:]"),
    }
    counted = rows.select(*carried, F.inline(F.array(F.struct(F.struct(*[e.alias(k) for k, e in counts.items()]).alias("s")))))
    words, n_lines = F.col("s.words.n"), F.col("s.lines.n")
    n = F.greatest(words, F.lit(1))
    values = (
        words,
        F.when(words > 0, F.col("s.chars") / n).otherwise(0),
        F.col("s.symbols") / n,
        F.col("s.digits") / n,
        F.col("s.shouts") / n,
        F.col("s.exclaims") / n,
        F.col("s.stops") / n,
        F.col("s.words.kinds") / n,
        F.col("s.lines.kinds") / n_lines,
        words / n_lines,
    )
    return counted.select(*carried, *[e.cast("double").alias(name) for name, e in zip(STATISTICS, values, strict=True)])


@dataclass(frozen=True)
class Rule:
    """A conjunction: per statistic at most one lower (``>``) and one upper (``<=``) bound."""

    bounds: tuple[tuple[str, str, float], ...]

    def expression(self) -> Column:
        out = F.lit(True)
        for name, side, value in self.bounds:
            out = out & (F.col(name) <= value if side == "<=" else F.col(name) > value)
        return out


@dataclass
class RuleModel:
    """``score = sigmoid(intercept + sum of the weights of the rules that hold)``."""

    intercept: float = 0.0
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def score(self) -> Column:
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            total = total + F.when(rule.expression(), F.lit(float(weight))).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


_CONDITION = re.compile(r"\s*(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)")


def tree_rules(description: str) -> list[Rule]:
    """The paths of a printed tree or forest, from each root to each node below it."""
    found: dict[Rule, None] = {}
    path: list[tuple[int, str, str, float]] = []
    for line in description.splitlines():
        m = _CONDITION.match(line)
        if not m:
            continue
        depth = len(line) - len(line.lstrip())
        path = [p for p in path if p[0] < depth] + [(depth, STATISTICS[int(m[1])], m[2], float(m[3]))]
        tightest: dict[tuple[str, str], float] = {}
        for _, name, side, value in path:
            pick = min if side == "<=" else max
            tightest[name, side] = pick(value, tightest.get((name, side), value))
        found[Rule(tuple(sorted((n, s, v) for (n, s), v in tightest.items())))] = None
    return list(found)


def labelled(rows: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """``rows`` (column ``id``) that have a label, with it as ``label`` (0 or 1)."""
    own = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
    own = own.groupBy(F.col(id_col).alias("id")).agg(F.min(label).cast("int").alias("label"))
    return rows.join(sized(materialise(own, "labels"), 16), "id")


def remainder(id_column: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids give null."""
    return F.crc32(id_column.cast("string")) % parts


def fit(train: DataFrame) -> RuleModel:
    """``train``: statistics and ``label``, materialised."""
    classes = {r.label: r["count"] for r in train.groupBy("label").count().collect()}
    if not (classes.get(0) and classes.get(1)):
        n1, n0 = classes.get(1, 0), classes.get(0, 0)
        return RuleModel(math.log((n1 + 1) / (n0 + 1)))
    vectors = train.select("label", array_to_vector(F.array(*STATISTICS)).alias("features"))
    forest = RandomForestClassifier(
        labelCol="label", numTrees=N_TREES, maxDepth=MAX_DEPTH, minInstancesPerNode=MIN_ROWS, bootstrap=False,
        featureSubsetStrategy="0.4", seed=SEED,
    ).fit(vectors)
    rules = tree_rules(forest.toDebugString)
    if not rules:
        return RuleModel(math.log((classes[1] + 1) / (classes[0] + 1)))
    truth = F.array(*[F.when(r.expression(), 1.0).otherwise(0.0) for r in rules])
    lasso = LogisticRegression(
        labelCol="label", elasticNetParam=1.0, regParam=L1, maxIter=60, standardization=True
    ).fit(train.select("label", array_to_vector(truth).alias("features")))
    weights = lasso.coefficients.toArray()
    return RuleModel(float(lasso.intercept), [(r, float(w)) for r, w in zip(rules, weights) if w != 0.0])


def _train(docs: DataFrame, labels: DataFrame, parts: int, held_out: int, id_col: str, text_col: str, label: str) -> RuleModel:
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.where(remainder(F.col("id"), parts) != held_out)
    train = with_statistics(labelled(rows, labels, label, id_col), "id", "label")
    # sorted so that reruns see the rows in the same order
    return fit(materialise(train.repartition("id").sortWithinPartitions("id", *STATISTICS), "quality-train"))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    parts: int = 3,
    held_out: int = 1,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "quality",
) -> DataFrame:
    """One row per document: id, held_out, score, predicted.  Rows held out never train."""
    model = _train(docs, labels, parts, held_out, id_col, text_col, label)
    rows = with_statistics(docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")), "id")
    out = F.coalesce(remainder(F.col("id"), parts) == held_out, F.lit(False))
    rows = rows.select("id", out.alias("held_out"), model.score().alias("score"))
    return rows.select(
        F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    parts: int = 3,
    held_out: int = 1,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "quality",
) -> DataFrame:
    """``docs`` that the classifier accepts, with all their columns."""
    model = _train(docs, labels, parts, held_out, id_col, text_col, label)
    rows = with_statistics(docs.select(F.struct("*").alias("row"), text_of(text_col).alias("text")), "row")
    return rows.where(model.score() >= threshold).select("row.*")
