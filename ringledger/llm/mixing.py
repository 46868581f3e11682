"""Mixing sources to target weights by iterative proportional fitting; built-ins only.

Documents are counted into cells of source, language and topic. The token weights of the cells
are raked to the target share of every source, language and topic in turn until all marginals
fit. A document's probability is its cell's weight per token over the largest one, so a sample
has the target shares in expectation; whether it is drawn is decided by a hash of its id, so a
repeated run draws the same documents.

Only cells are iterated over, each round written to the shared folder; the driver reads one
number per round. The documents are counted once and joined once with their cell, a table that
grows with the number of sources only.

Defined results: null marks are the empty value of their dimension; documents without words
weigh nothing and are drawn by the probability of their cell, or never in a cell without words.
A null id is hashed as the empty text. Repeated rows are drawn together. Targets that no
weights can meet end after ``max_rounds`` at the closest marginals reached then.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.llm.frames import packed, words_of
from ringledger.operators.staging import staged

DIMENSIONS = ("source", "language", "topic")
# Target share of a value: its natural share to this power, scaled to 1. Below 1 lifts rare ones.
POWERS = {"source": 0.7, "language": 0.7, "topic": 0.9}
TOLERANCE = 1e-9
MAX_ROUNDS = 50
HASH_DIGITS = 13


def layout_topic(text: Column) -> Column:
    """What kind of text it is, by its layout: the topic of a corpus that marks none."""
    n = F.char_length(text)
    return (
        F.when(F.coalesce(n, F.lit(0)) == 0, F.lit("empty"))
        .when(F.contains(text, F.lit(" | ")), F.lit("table"))
        .when(n < 1000, F.lit("note"))
        .when(n < 5000, F.lit("article"))
        .otherwise(F.lit("long read"))
    )


def _uniform(key: Column) -> Column:
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, HASH_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / float(16**HASH_DIGITS)


def counted(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """``row``, the three dimensions, ``key`` and ``n_tokens`` of every document."""
    return packed(
        docs,
        source=F.coalesce(F.col("source").cast("string"), F.lit("")),
        language=F.coalesce(F.col("lang").cast("string"), F.lit("")),
        topic=F.coalesce(layout_topic(F.col("text")) if topic is None else topic, F.lit("")),
        key=F.col("doc_id"),
        n_tokens=F.size(words_of(F.col("text"))).cast("long"),
    )


def _with_targets(cells: DataFrame, powers: Mapping[str, float],
                  targets: Mapping[str, DataFrame]) -> DataFrame:
    for name in DIMENSIONS:
        if name in targets:
            wanted = targets[name].select(name, F.col("target").alias("mass"))
        else:
            wanted = cells.groupBy(name).agg(F.pow(F.sum("tokens"), powers[name]).alias("mass"))
        every = wanted.agg(F.sum("mass")).scalar()
        cells = cells.join(wanted, name).withColumn(f"{name}_target", F.col("mass") / every)
        cells = cells.drop("mass")
    return cells


def raked(cells: DataFrame, powers: Mapping[str, float] = POWERS,
          targets: Mapping[str, DataFrame] | None = None, tolerance: float = TOLERANCE,
          max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``cells`` (the dimensions and ``tokens``) with ``weight``, the raked token share.

    ``targets`` may give a table ``value, target`` per dimension, named by the dimension;
    the others follow ``powers``. Cells of values that a given table lacks drop out.
    """
    full = _with_targets(cells.where("tokens > 0"), powers, targets or {})
    total = full.agg(F.sum("tokens")).scalar()
    now = staged(full.withColumn("weight", F.col("tokens") / total), "cells")
    for _ in range(max_rounds):
        turned = now.withColumn("gap", F.lit(0.0))
        for name in DIMENSIONS:
            sums = turned.groupBy(name).agg(F.sum("weight").alias("reached"))
            factor = F.col(f"{name}_target") / F.col("reached")
            turned = turned.join(sums, name).select(
                *[F.col(c) for c in now.columns if c != "weight"],
                (F.col("weight") * factor).alias("weight"),
                F.greatest("gap", F.abs(factor - 1)).alias("gap"),
            )
        done = staged(turned, "cells")
        now = done.drop("gap")
        if (done.agg(F.max("gap")).first()[0] or 0.0) < tolerance:
            break
    return now


def mixed(docs: DataFrame, topic: Column | None = None, powers: Mapping[str, float] = POWERS,
          targets: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Sampled documents: ``row``, the dimensions, ``n_tokens`` and ``probability``."""
    marked = counted(docs, topic)
    cells = staged(
        marked.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "cells"
    )
    weighed = raked(cells, powers, targets).withColumn("ratio", F.col("weight") / F.col("tokens"))
    largest = weighed.agg(F.max("ratio")).scalar()
    drawn = weighed.select(*DIMENSIONS, (F.col("ratio") / largest).alias("probability"))
    return marked.join(drawn, list(DIMENSIONS)).where(_uniform(F.col("key")) < F.col("probability"))


def oracle(rounds: int = MAX_ROUNDS) -> str:
    """The sample of ``documents`` in SQL, with all rounds written out."""
    steps = []
    for k in range(rounds * len(DIMENSIONS)):
        name = DIMENSIONS[k % len(DIMENSIONS)]
        steps.append(
            f"w{k + 1} AS MATERIALIZED (SELECT w{k}.* REPLACE (weight * t.share"
            f" / sum(weight) OVER (PARTITION BY w{k}.{name}) AS weight)"
            f" FROM w{k} JOIN t_{name} t USING ({name}))"
        )
    shares = ", ".join(
        f"t_{name} AS MATERIALIZED (SELECT {name}, pow(sum(tokens), {POWERS[name]})"
        f" / sum(pow(sum(tokens), {POWERS[name]})) OVER () AS share FROM cells GROUP BY {name})"
        for name in DIMENSIONS
    )
    blank = r"'[^\x20\x09-\x0D]+'"
    return f"""
WITH marked AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS language,
         CASE WHEN coalesce(length(text), 0) = 0 THEN 'empty'
              WHEN contains(text, ' | ') THEN 'table' WHEN length(text) < 1000 THEN 'note'
              WHEN length(text) < 5000 THEN 'article' ELSE 'long read' END AS topic,
         CAST(len(regexp_extract_all(coalesce(text, ''), {blank})) AS BIGINT) AS n_tokens,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {HASH_DIGITS})
              AS BIGINT) / {16**HASH_DIGITS}.0::DOUBLE AS u
  FROM documents
), cells AS MATERIALIZED (
  SELECT source, language, topic, sum(n_tokens)::DOUBLE AS tokens FROM marked
  GROUP BY ALL HAVING sum(n_tokens) > 0
), {shares},
w0 AS MATERIALIZED (SELECT *, tokens / sum(tokens) OVER () AS weight FROM cells),
{", ".join(steps)},
drawn AS (
  SELECT source, language, topic, weight / tokens / max(weight / tokens) OVER () AS probability
  FROM w{len(steps)}
)
SELECT doc_id, source, language, topic, n_tokens, round(probability, 6) AS probability
FROM marked JOIN drawn USING (source, language, topic) WHERE u < drawn.probability
"""
