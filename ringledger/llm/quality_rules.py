"""Quality rules: text statistics and a hashed n-gram likelihood ratio, built-ins only.

The likelihood ratio compares two multinomials over hashed n-gram buckets: one counted over
a trusted target corpus, one over the whole raw corpus. A document's score is the mean log
ratio over its n-grams, so length does not matter; a fixed threshold decides.

n-grams are the single words and the pairs of neighbouring words, whole. Their hashes share
``buckets`` cells, up to ``MOST_BUCKETS``: with few, pairs of good and of bad texts fall together
and scores draw near 0.

Defined results: a null, empty or blank text has no words, all statistics are 0, the score is
0, and it fails the base rules. A score equal to the threshold is kept. With no trusted documents
every score is 0. Repeated rows are judged one by one, and an empty table gives none. Very long
texts are read whole. Other columns pass through, whatever their names.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.llm.frames import let, packed, words_of
from ringledger.operators.staging import staged

BUCKETS = 1 << 18
# The ratios go to every task: 8 bytes a bucket.
MOST_BUCKETS = 1 << 20
# Up to this many ids of trusted documents go to every task, about 100 MB.
BROADCAST_IDS = 1 << 21
# Texts whose mean log ratio is below this are rejected.
MIN_RATIO = -0.25
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"


def _word_bucket(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets))


def _pair_bucket(word: Column, following: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("pair"), word, following), F.lit(buckets))


def ngram_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n_raw, n_target`` over columns ``text`` and ``trusted`` (boolean)."""
    words = texts.select("trusted", words_of(F.col("text")).alias("words"))
    placed = words.select("trusted", "words", F.posexplode("words").alias("at", "word"))
    following = F.get("words", F.col("at") + 1)
    pair = F.when(following.isNotNull(), _pair_bucket(F.col("word"), following, buckets))
    ngrams = placed.select(
        "trusted", F.explode(F.array(_word_bucket(F.col("word"), buckets), pair)).alias("bucket")
    )
    return ngrams.where(F.col("bucket").isNotNull()).groupBy("bucket").agg(
        F.count("*").alias("n_raw"), F.count_if("trusted").alias("n_target")
    )


def log_ratios(counts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row with an array ``ratios``: log of target share over raw share, per bucket.

    The target is smoothed towards the raw shares by as many n-grams as there are buckets. The
    row is written and has ``buckets`` numbers, whatever the corpus.
    """
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets must lie between 1 and {MOST_BUCKETS}")
    every = counts.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    # One row per bucket by then, so the window holds a bounded number of rows.
    listed = every.join(counts, "bucket", "left").agg(F.sort_array(F.collect_list(F.struct(
        "bucket",
        (F.coalesce("n_raw", F.lit(0)) + 1).cast("double").alias("raw"),
        F.coalesce("n_target", F.lit(0)).cast("double").alias("target"),
    ))).alias("cells"))

    def total(name: str) -> Column:
        return F.aggregate(F.col("cells")[name], F.lit(0.0), lambda acc, x: acc + x)

    summed = listed.select("cells", total("raw").alias("raw"), total("target").alias("target"))

    def ratio(cell: Column) -> Column:
        share = cell["raw"] / F.col("raw")
        smoothed = (cell["target"] + buckets * share) / (F.col("target") + buckets)
        return F.when(F.col("target") > 0, F.log(smoothed / share)).otherwise(0.0)

    return staged(summed.select(F.transform("cells", ratio).alias("ratios")), "ratios")


def trusted_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, trusted`` of every document; trusted where a label says quality 1.

    The trusted ids are counted first. Up to ``BROADCAST_IDS`` they are broadcast and no text is
    shuffled; beyond it both sides are shuffled once.
    """
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    good = good.withColumn("good", F.lit(True))
    few = good.count() <= BROADCAST_IDS
    good = F.broadcast(good) if few else good.hint("shuffle_hash")
    texts = docs.select("doc_id", "text").join(good, "doc_id", "left")
    return texts.select("text", F.coalesce("good", F.lit(False)).alias("trusted"))


def _repeated_words(words: Column) -> Column:
    """Words inside windows that occur twice or more."""
    starts = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW)).otherwise(
        F.array().cast("array<int>")
    )
    hashes = F.transform(
        starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    )

    def covered(windows: Column) -> Column:
        # Equal windows are neighbours once sorted.
        placed = F.sort_array(F.transform(
            windows, lambda value, at: F.struct(value.alias("hash"), at.alias("at"))
        ))

        def twice(ordered: Column) -> Column:
            def mates(x: Column, k: Column) -> Column:
                before, after = F.get(ordered, k - 1)["hash"], F.get(ordered, k + 1)["hash"]
                return (F.coalesce(before == x["hash"], F.lit(False))
                        | F.coalesce(after == x["hash"], F.lit(False)))

            return F.sort_array(F.transform(F.filter(ordered, mates), lambda x: x["at"]))

        return F.aggregate(
            let(placed, twice),
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda acc, at: F.struct(
                at.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), at - acc["last"])).alias("n")
            ),
            lambda acc: acc["n"],
        )

    # Most texts repeat no window and need no sorting.
    return let(hashes, lambda windows: F.when(
        F.size(F.array_distinct(windows)) < F.size(windows), covered(windows)
    ).otherwise(F.lit(0).cast("long")))


def _score(words: Column, ratios: Column, buckets: int) -> Column:
    """Mean log ratio over the n-grams of one text."""

    def total(table: Column) -> Column:
        def summed(acc: Column, i: Column) -> Column:
            word, following = F.get(words, i), F.get(words, i + 1)
            pair = F.when(following.isNotNull(), F.get(table, _pair_bucket(word, following, buckets)))
            return acc + F.get(table, _word_bucket(word, buckets)) + F.coalesce(pair, F.lit(0.0))

        return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), summed)

    n = F.size(words)
    return F.when(n > 0, let(ratios, total) / (2 * n - 1)).otherwise(0.0)


def judgement(text: Column, ratios: Column, buckets: int = BUCKETS,
              min_ratio: float = MIN_RATIO) -> Column:
    """Struct of the statistics, ``score``, ``base_failed`` and ``kept`` of one text.

    One expression whose parts are bound as lambda arguments: whatever Spark moves it into, a
    filter included, no part is worked out once per word. ``ratios`` stands in it once, so that
    Spark puts the subquery that reads them there and no row carries them.
    """
    given = F.coalesce(text, F.lit(""))
    n_symbols = sum(
        (F.octet_length(given) - F.octet_length(F.replace(given, F.lit(c))) for c in SYMBOLS),
        F.lit(0),
    )
    lines = F.filter(F.split(given, "\n"), lambda line: F.btrim(line, F.lit(" \t\x0b\x0c\r")) != "")
    measured = let(words_of(text), lambda words: F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        n_symbols.cast("long").alias("n_symbols"),
        let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found)))
        .cast("long").alias("n_dup_lines"),
        _repeated_words(words).alias("n_repeat_words"),
        _score(words, ratios, buckets).alias("score"),
    ))

    def decided(found: Column) -> Column:
        failed = (found["n_words"] < MIN_WORDS) | (
            100 * found["n_repeat_words"] > MAX_REPEAT_PERCENT * found["n_words"]
        )
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score")
        return F.struct(
            *[found[name].alias(name) for name in names], failed.alias("base_failed"),
            (~failed & (found["score"] >= min_ratio)).alias("kept"),
        )

    return let(measured, decided)


def judged(docs: DataFrame, ratios: DataFrame, buckets: int = BUCKETS,
           min_ratio: float = MIN_RATIO) -> DataFrame:
    """``row`` (all columns of ``docs``), the statistics, ``score``, ``base_failed``, ``kept``.

    ``ratios`` is what ``log_ratios`` gives; a scalar subquery reads it, so the plan and its
    descriptions in the driver do not hold the numbers.
    """
    given = packed(docs, text=F.col("text"), ratios=ratios.scalar())
    told = given.select(
        "row", judgement(F.col("text"), F.col("ratios"), buckets, min_ratio).alias("told")
    )
    return told.select("row", "told.*")


def quality_rules(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS,
                  min_ratio: float = MIN_RATIO) -> DataFrame:
    """``judged`` against the texts that ``labels`` marks as good."""
    counts = ngram_counts(trusted_texts(docs, labels), buckets)
    return judged(docs, log_ratios(counts, buckets), buckets, min_ratio)
